"""Every registered query of the reference's own operators against its SQL, where the tables are there."""

import os

import duckdb
import pytest

from kilotrace.queries import QUERIES, SQL

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def cell(v):
    if v is None or type(v).__name__ in ("NaTType", "NAType") or v != v:
        return "null"
    kind = type(v).__name__
    if "bool" in kind:
        return str(bool(v))
    if "float" in kind or "int" in kind:
        return repr(round(float(v), 5) + 0.0)
    if "date" in kind.lower() or "Timestamp" in kind:
        return str(v)[:10]
    return str(v)


def plain(df, columns):
    return sorted(tuple(cell(v) for v in row) for row in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DIR).toPandas()
    if name in SQL:
        want = con.sql(SQL[name]).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        assert plain(got, columns) == plain(want, columns)
    else:
        assert len(got.columns)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
def test_lineage_numbers_each_sheet(spark):
    """Every sale is numbered within its sheet, from 1 on, in the order of its document and line."""
    sheets = {}
    for x in QUERIES["lineage_columns"](spark, DIR).collect():
        sheets.setdefault(x.hoja, []).append((x.fila, x.documento, x.linea))
    assert len(sheets) > 1
    for rows in sheets.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
