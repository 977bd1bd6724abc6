"""Exact quantiles, running sums and nearest neighbours against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_exact_quantiles(spark, monkeypatch):
    from kilotrace.operators import quantiles as Q

    r = np.random.default_rng(1)
    n = 5000
    table = {
        "even": r.normal(size=n), "hot": np.where(r.random(n) < 0.6, 3.0, r.normal(size=n)), "wide": np.exp(r.normal(size=n) * 60), "signed": r.normal(size=n) * 10.0 ** r.integers(-200, 200, n),
        "one": np.full(n, 7.5), "whole": r.integers(0, 4, n).astype(float), "tiny": r.integers(0, 3, n) * 5e-324, "far": r.normal(size=n) * 10.0 ** r.integers(0, 308, n),
    }
    rows = [tuple(float(v[i]) for v in table.values()) for i in range(n)]
    rows += [(None,) * 8, (float("nan"),) * 8, (float("inf"),) * 8, (float("-inf"),) * 8]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in table)).withColumn("none", F.lit(None).cast("double")).cache()
    shares = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    for few in (2000, 3):
        monkeypatch.setattr(Q, "FEW", few)
        got = Q.exact_quantiles(df, [*table, "none"], shares)
        for c, v in table.items():
            low, high = np.quantile(v, shares, method="lower"), np.quantile(v, shares, method="higher")
            at = np.array(shares) * (n - 1)
            assert np.allclose(got[c], np.where(low == high, low, (np.ceil(at) - at) * low + (at - np.floor(at)) * high), rtol=1e-12, atol=0), c
        assert got["none"] == [None] * 6
    spark_own = df.filter("even = even and abs(even) < 1e308").agg(F.percentile("even", F.array(*map(F.lit, shares)))).first()[0]
    assert spark_own == got["even"]
    assert Q.exact_quantiles(df.limit(0), ["even"], [0.5]) == {"even": [None]}


@pytest.mark.parametrize("parts", [1, 7])
def test_running_sum(spark, parts):
    from kilotrace.operators.ordering import running_sum
    from kilotrace.operators.score import average_percentile

    r = np.random.default_rng(2)
    rows = [(int(i), "a" if r.random() < 0.8 else "b", int(r.integers(1, 9))) for i in r.permutation(400)]
    df = spark.createDataFrame(rows, "k int, g string, v long")
    got = {x.k: x.s for x in running_sum(df, [F.col("g").desc(), F.col("k")], F.col("v"), "s", parts).collect()}
    total = 0
    for k, _, v in sorted(rows, key=lambda x: (-ord(x[1]), x[0])):
        total += v
        assert got[k] == total
    ranked = average_percentile(df, "v", "g").collect()
    for x in ranked:
        same = [v for _, g, v in rows if g == x.g]
        want = (sum(v < x.v for v in same) + (sum(v == x.v for v in same) + 1) / 2) / len(same)
        assert abs(x.percentil - want) < 1e-12
    assert len(ranked) == 400 and running_sum(df.limit(0), [F.col("k")], F.col("v"), "s").count() == 0


def test_no_task_holds_a_hot_group(spark):
    """The ranges of a running sum are even though one group has nearly all rows."""
    from kilotrace.operators.ordering import running_sum

    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 50 = 0 THEN 'b' ELSE 'a' END AS g")
    plan = running_sum(df, [F.col("g"), F.col("id")], F.lit(1), "s", 8)
    assert "hashpartitioning(_part" in plan._jdf.queryExecution().toString()
    sizes = df.repartitionByRange(8, "g", "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(x["count"] for x in sizes) <= 2 * 20_000 / 8
    assert plan.agg(F.max("s")).first()[0] == 20_000


def plain_nearest(x, ids, y, near, k, itself):
    out = {}
    for i, v in zip(ids, x, strict=True):
        d = np.zeros(len(y))
        for c in range(y.shape[1]):
            d += (v[c] - y[:, c]) ** 2
        d = np.sqrt(d)
        out[i] = sorted((a, b) for a, b in zip(d.tolist(), near, strict=True) if itself or b != i)[:k]
    return out


@pytest.mark.parametrize("itself", [False, True])
def test_nearest_over_nine_features(spark, itself):
    from kilotrace.operators.neighbours import nearest

    r = np.random.default_rng(5)
    y = np.round(r.normal(size=(900, 9)), 1)
    y[:300] = y[0]  # a third of all points are equal: no cut parts them
    y[:, 5:7] = 0.0
    points = [(f"p{i:03d}", v.tolist()) for i, v in enumerate(y)]
    asked = [*points[::5], ("far", [50.0] * 9), ("far2", [-3.0] * 9)]
    kinds = "id string, v array<double>"
    got = {}
    found = nearest(spark.createDataFrame(asked, kinds), spark.createDataFrame(points, kinds), 6, leaf=40, itself=itself)
    for x in found.collect():
        got.setdefault(x.id, []).append((x.rank, x.d, x.near))
    want = plain_nearest(np.array([v for _, v in asked]), [i for i, _ in asked], y, [i for i, _ in points], 6, itself)
    assert {i: [(d, b) for _, d, b in sorted(v)] for i, v in got.items()} == want
    few = nearest(spark.createDataFrame(asked[:3], kinds), spark.createDataFrame(points[:3], kinds), 6, leaf=40, itself=itself).collect()
    assert len(few) == sum(min(6, 3 - (not itself) * (i in {"p000", "p001", "p002"})) for i, _ in asked[:3])
    assert nearest(spark.createDataFrame(asked, kinds), spark.createDataFrame([], kinds), 6).count() == 0
    assert nearest(spark.createDataFrame([], kinds), spark.createDataFrame(points, kinds), 6).count() == 0


def test_pairs_compared_grow_slower_than_points(spark):
    from kilotrace.operators.neighbours import nearest

    r, kinds, each = np.random.default_rng(7), "id string, v array<double>", []
    for n in (4_000, 16_000):
        y = r.normal(size=(n, 9)) * [1, 1, 1, 1, 0, 0, 0, 0, 0.5]
        df = spark.createDataFrame([(f"p{i}", v.tolist()) for i, v in enumerate(y)], kinds)
        tally = spark.sparkContext.accumulator(0)
        asked = df.limit(500)
        assert nearest(asked, df, 10, leaf=1000, tally=tally).count() == 5000
        each.append(tally.value / 500)
    assert each[0] < 0.5 * 4_000 and each[1] < 2 * each[0]  # four times the points


def test_hot_leaf_is_dealt_to_several_tasks(spark, monkeypatch):
    from kilotrace.operators import neighbours as N

    monkeypatch.setattr(N, "QUERIES", 50)
    kinds = "id string, v array<double>"
    rows = [(f"p{i:03d}", [1.0, 2.0]) for i in range(300)] + [(f"q{i:03d}", [float(i), 0.0]) for i in range(100)]
    df = spark.createDataFrame(rows, kinds)
    got = {}
    for x in N.nearest(df, df, 3, leaf=30).collect():
        got.setdefault(x.id, []).append((x.d, x.near))
    want = plain_nearest(np.array([v for _, v in rows]), [i for i, _ in rows], np.array([v for _, v in rows]), [i for i, _ in rows], 3, False)
    assert {i: sorted(v) for i, v in got.items()} == want
