"""Density models against plain ones, and the grid over the given tables."""

import os

import numpy as np
import pytest

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = "id string, v array<double>"


def plain_lof(train, queries, k, itself):
    """Local outlier factors by numpy; both are dicts of id and vector."""

    def near(of, skip):
        out = {}
        for i, v in of.items():
            d = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for j, w in train.items() if not (skip and i == j))
            out[i] = d[:k]
        return out

    own, asked = near(train, True), near(queries, not itself)
    kd = {i: d[-1][0] for i, d in own.items()}
    density = lambda n: 1 / (np.mean([max(d, kd[j]) for d, j in n]) + 1e-10)
    lrd = {i: density(n) for i, n in own.items()}
    return {i: np.mean([lrd[j] for _, j in n]) / density(n) for i, n in asked.items()}


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(6)
    x = {f"p{i:03d}": r.normal(size=9).round(1).tolist() for i in range(150)}
    x["odd"] = [9.0, -9.0] + [0.0] * 7
    return x


def test_lof_against_a_plain_one(spark, points):
    from kilotrace.operators.models import lof, lof_scores
    from kilotrace.operators.neighbours import nearest

    train = {i: v for i, v in points.items() if i != "odd" and int(i[1:]) % 2}
    a, b = (spark.createDataFrame(list(x.items()), KINDS) for x in (train, points))
    for itself in (False, True):
        got = {x.id: x.puntaje for x in lof(a, b, 5, itself).collect()}
        want = plain_lof(train, points, 5, itself)
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 * want[i] for i in got)
        assert max(got, key=got.get) == "odd"
    many = lof_scores(nearest(a, a, 9), nearest(b, a, 9), (3, 9)).collect()  # both numbers of neighbours in one go
    for k in (3, 9):
        want = plain_lof(train, points, k, False)
        assert all(abs(x[f"lof_{k}"] - want[x.id]) < 1e-9 * want[x.id] for x in many) and len(many) == len(points)


def plain_forest(spark, points, trees, sample, seed):
    """Scores of trees walked a row at a time."""
    from kilotrace.operators.models import _grow, mean_path, tree_hashes

    ids = sorted(points)
    h = {r.id: r.h for r in spark.createDataFrame([(i,) for i in ids], "id string").selectExpr("id", "xxhash64(id) AS h").collect()}
    total = dict.fromkeys(ids, 0.0)
    for t in range(trees):
        place = tree_hashes(np.array([h[i] for i in ids]), t, seed)
        order = [i for _, i in sorted(zip((place >> np.uint64(1)).tolist(), ids))][:sample]
        tree = _grow(np.array([points[i] for i in order]), np.random.default_rng([seed, t, sample]))
        for i, v in points.items():
            at = 0
            while tree["column"][at] >= 0:
                at = tree["left"][at] if v[tree["column"][at]] <= tree["cut"][at] else tree["right"][at]
            total[i] += tree["depth"][at] / mean_path(len(order))
    return {i: 2 ** -(x / trees) for i, x in total.items()}


def test_forests_against_plain_ones(spark, points):
    from kilotrace.operators.models import forest_scores, iforest

    df = spark.createDataFrame(list(points.items()), KINDS).repartition(3)
    forests = [(5, 16), (5, 64), (12, 16), (12, 256)]
    rows = forest_scores(df, df, forests, 1).collect()
    for t, s in forests:
        want = plain_forest(spark, points, t, s, 1)
        assert {x.id: round(x[f"iforest_{t}_{s}"], 12) for x in rows} == {i: round(v, 12) for i, v in want.items()}
    alone = {x.id: round(x.puntaje, 12) for x in iforest(df, df, 12, 256, 1).collect()}
    assert alone == {x.id: round(x.iforest_12_256, 12) for x in rows}


def test_draw_shuffles_little(spark):
    """The rows that leave the tasks: a sample a tree and task, or MARGIN samples a tree where rows are many."""
    from kilotrace.operators.models import MARGIN, draw

    df = spark.range(20_000).selectExpr("CAST(id AS string) AS id", "array(CAST(id AS double)) AS v")
    drawn = draw(df.repartition(4), 10, 32, 3)
    assert drawn.count() <= 10 * 32 * 4
    assert draw(df.repartition(40), 10, 32, 3).count() <= 1.5 * MARGIN * 10 * 32
    one = {(x.tree, x.id) for x in _least(drawn, 32)}
    assert one == {(x.tree, x.id) for x in _least(draw(df.repartition(7), 10, 32, 3), 32)} and len(one) == 320


def _least(drawn, sample):
    rows = {}
    for x in drawn.collect():
        rows.setdefault(x.tree, []).append((x.place, x.id, x))
    return [x for r in rows.values() for *_, x in sorted(r)[:sample]]


def test_grid_and_final_model(spark, points):
    from kilotrace.operators.models import final_scores, model_grid

    r = np.random.default_rng(9)
    train = {i: v for i, v in points.items() if i != "odd" and int(i[1:]) < 60}
    months = {i: v for i, v in points.items() if i not in train}
    labels = [(i, 1998 if n % 2 else 1999, int(r.integers(0, 2))) for n, i in enumerate(months)]
    a, b = (spark.createDataFrame(list(x.items()), KINDS) for x in (train, months))
    grid = model_grid(a, b, spark.createDataFrame(labels, "id string, anio int, etiqueta int"), 10, 1, 1998).collect()
    assert len(grid) == 14 and {x.orden for x in grid} == set(range(14)) and sum(x.mejor for x in grid) == 1
    for x in grid:
        scores = plain_lof(train, months, x.n_neighbors, False) if x.modelo == "lof" else None
        if scores is None:
            want = [y for y in grid if (y.n_estimators, y.max_samples) == (x.n_estimators, x.max_samples)]
            assert {(y.precision_piloto, y.precision_estabilidad) for y in want} == {(x.precision_piloto, x.precision_estabilidad)}
            continue
        for year, got in ((1998, x.precision_piloto), (1999, x.precision_estabilidad)):
            part = sorted((-scores[i], i, y) for i, anio, y in labels if anio == year)[:10]
            assert abs(got - np.mean([y for *_, y in part])) < 1e-12
    best = max(grid, key=lambda x: (x.precision_piloto, -x.orden))
    assert best.mejor
    every = spark.createDataFrame(list(points.items()), KINDS)
    got = {x.id: x.puntaje_modelo for x in final_scores(a, every, {"modelo": "lof", "n_neighbors": 10}, 1).collect()}
    want = plain_lof(train, points, 10, True)
    assert all(abs(got[i] - want[i]) < 1e-9 * want[i] for i in points)
    forest = final_scores(a, every, {"modelo": "isolation_forest", "n_estimators": 100, "max_samples": 64}, 1).collect()
    assert len(forest) == len(points)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
def test_models_take_every_year(spark):
    from kilotrace.queries.evaluation import _sets, model_grid, model_scores

    train, scored, every = ({r.id.split("|")[1] for r in part.select("id").collect()} for part in _sets(spark, DIR))
    assert {"1995", "1996", "1997"} <= train and {"1998", "1999", "2000"} <= scored and not train & scored and every == train | scored
    grid = model_grid(spark, DIR).collect()
    assert len(grid) == 14 and all(0 <= r.precision_piloto <= 1 and 0 <= r.precision_estabilidad <= 1 for r in grid)
    final = model_scores(spark, DIR)
    assert final.count() == _sets(spark, DIR)[2].count() and final.filter("puntaje_modelo is null").count() == 0
