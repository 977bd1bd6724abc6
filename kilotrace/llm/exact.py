"""Exact duplicates by a distributed most-significant-digit radix partitioning.

Texts are split by successive bytes, a digit of several bytes a round and a wider one each time, until a group holds
one row or its texts have ended. Rows that stay together to the end are equal byte by byte; no digest takes part.

Null texts count as empty, and all blank texts are equal. Rows repeated whole are members of their group, of which
exactly one row stays. Other columns of the input are left aside. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import SPACE, Scratch, documents

KEYS = ["grp", "digit", "ended"]


def _cut(rows: DataFrame, width: int) -> DataFrame:
    """Takes the next digit off the rest of each text."""
    return rows.withColumns({
        "digit": F.substring("rest", 1, width),
        "ended": F.octet_length("rest") <= width,
        "rest": F.substring("rest", width + 1, 2**31 - 1),
    })


def exact_groups(docs: DataFrame, first: int = 64, growth: int = 16) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    A round shuffles only what is still undecided: single rows leave at once, and the rest carry the bytes that have
    not been read. Only groups of two rows or more are joined back, as a written table, so that Spark may split a hot
    group over tasks; counts are combined before the shuffle. ``first`` is the first digit's width in bytes and
    ``growth`` how many times as wide each next one is: a text of n bytes takes about log(n) rounds.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, "")
    # numbered once, and written, so that every later plan reads the same numbers
    active = scratch.keep(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.length("text"), F.lit(0)).alias("chars"),
        F.sha2(plain.cast("binary"), 256).alias("text_sha256"),
        F.lit(-1).cast("long").alias("grp"),
        plain.cast("binary").alias("rest"),
    ))
    done, width = [], first
    while True:
        cut = _cut(active, width)
        best = F.max(F.struct("chars", (-F.col("doc_id")).alias("d"), (-F.col("row")).alias("r")))
        groups = cut.groupBy(*KEYS).agg(F.count("*").alias("n"), best.alias("best")).filter("n > 1")
        shared = scratch.keep(groups.select(*KEYS, "n", (-F.col("best.d")).alias("keep_id"), (-F.col("best.r")).alias("keep_row")))
        # sort-merge at every size: the plan, and so the shuffle, stays in proportion to the input
        split = cut.join(shared.hint("merge"), KEYS, "left").select(
            "doc_id", "row", "chars", "text_sha256",
            F.coalesce("keep_row", "row").alias("grp"),
            F.when(F.col("n").isNotNull() & ~F.col("ended"), F.col("rest")).alias("rest"),
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        )
        now = scratch.keep(split)
        scratch.drop(shared)
        done.append(now.filter("rest is null").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("grp")).alias("kept"), "text_sha256"))
        active = now.filter("rest is not null").select("doc_id", "row", "chars", "text_sha256", "grp", "rest")
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)
        width *= growth


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY plain) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(plain) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY plain ORDER BY chars DESC, doc_id)
"""
