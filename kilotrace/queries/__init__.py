"""The registered queries, one for each operator, and their SQL counterparts."""

from kilotrace.queries import cleaning, evaluation, files, gold, grid, quality, rules, silver  # noqa: F401
from kilotrace.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
