"""Density models over unit-months: local outlier factor and isolation forest."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilotrace.operators.neighbours import nearest
from kilotrace.sources.lake import once

#: The grid that models are chosen from.
TREES, SAMPLES, NEIGHBOURS, CONTAMINATIONS = (100, 300), (64, 256), (10, 20, 35), (0.02, 0.05)
#: How many times a tree's sample rows of least hash are looked at. Fewer rows than the sample below it would take a
#: deviation of over twenty standard ones.
MARGIN = 8


def lof_scores(near: DataFrame, asked: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """(id, lof_k for each k): local outlier factors of the rows of ``asked`` against those of ``near``.

    Both are (id, near, d, rank), the nearest of the training rows and of the queries among them, as many as the
    largest k. Reachability, density and their ratio are averages over the first k, taken for all k in one go: a join
    with the neighbours' own distances for each side, and one with their densities.
    """
    at = [F.max(F.when(F.col("rank") == k, F.col("d"))).alias(f"kd_{k}") for k in ks]
    reach = once(near.groupBy(F.col("id").alias("near")).agg(*at), "alcances")
    mean = lambda x, k: F.avg(F.when(F.col("rank") <= k, x))

    def density(n: DataFrame) -> DataFrame:
        return n.join(reach, "near").groupBy("id").agg(*[(1 / (mean(F.greatest("d", f"kd_{k}"), k) + 1e-10)).alias(f"lrd_{k}") for k in ks])

    own = once(density(near), "densidades")
    theirs = own.select(F.col("id").alias("near"), *[F.col(f"lrd_{k}").alias(f"near_{k}") for k in ks])
    around = asked.join(theirs, "near").groupBy("id").agg(*[mean(F.col(f"near_{k}"), k).alias(f"near_{k}") for k in ks])
    return around.join(density(asked), "id").select("id", *[(F.col(f"near_{k}") / F.col(f"lrd_{k}")).alias(f"lof_{k}") for k in ks])


def lof(train: DataFrame, queries: DataFrame, k: int, itself: bool = False) -> DataFrame:
    """(id, puntaje): the local outlier factor of ``queries`` against ``train``, both (id, v array<double>). Higher is
    odder. ``itself``: a query that is also a training row counts among its own neighbours, as a new row would."""
    near, asked = once(nearest(train, train, k), "vecinos"), once(nearest(queries, train, k, itself=itself), "vecinos")
    return lof_scores(near, asked, (k,)).withColumnRenamed(f"lof_{k}", "puntaje")


def _grow(x: np.ndarray, random: np.random.Generator) -> dict[str, list]:
    """One isolation tree as flat arrays: column (-1: leaf), cut, left, right, and the leaf's adjusted depth."""
    tree: dict[str, list] = {"column": [], "cut": [], "left": [], "right": [], "depth": []}
    limit = int(np.ceil(np.log2(max(len(x), 2))))

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(tree["column"])
        for key, v in (("column", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("depth", depth + mean_path(len(rows)))):
            tree[key].append(v)
        wide = np.flatnonzero(x[rows].max(axis=0) > x[rows].min(axis=0)) if len(rows) > 1 and depth < limit else []
        if len(wide):
            c = int(random.choice(wide))
            cut = float(random.uniform(x[rows, c].min(), x[rows, c].max()))
            tree["column"][at], tree["cut"][at] = c, cut
            tree["left"][at], tree["right"][at] = add(rows[x[rows, c] <= cut], depth + 1), add(rows[x[rows, c] > cut], depth + 1)
        return at

    add(np.arange(len(x)), 0)
    return tree


def mean_path(n: int) -> float:
    """The average path of an unsuccessful search in a binary tree of n."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def tree_hashes(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Each row's place in a tree's draw: its hash mixed with the tree and the seed by multiplications and shifts."""
    x = ids.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(m)
    return x ^ (x >> np.uint64(31))


def draw(train: DataFrame, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, place, id, v): for each tree the ``sample`` rows of least hash, in their order.

    One pass: a task keeps the least of its own rows for every tree, and those are merged by tree. What is shuffled is
    at most ``sample`` rows a tree and task, and about MARGIN times ``sample`` rows a tree over all tasks.
    """
    share = min(1.0, MARGIN * sample / max(train.count(), 1))
    limit = np.uint64(min(2**64 - 1, int(share * 2**64)))

    def least(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for t in tables:
            hashes, parts = t["h"].to_numpy(np.int64), []
            for tree in range(trees):
                place = tree_hashes(hashes, tree, seed)
                at = np.flatnonzero(place <= limit)
                if len(at) > sample:
                    at = at[np.argpartition(place[at], sample - 1)[:sample]]
                parts.append(pd.DataFrame({"tree": np.full(len(at), tree, np.int32), "place": place[at] >> np.uint64(1), "id": t["id"].to_numpy()[at], "v": t["v"].to_numpy()[at]}))
            kept = pd.concat([*([] if kept is None else [kept]), *parts])
            kept = kept.sort_values(["tree", "place", "id"])
            kept = kept[kept.groupby("tree").cumcount() < sample]
        if kept is not None:
            yield kept.astype({"place": np.int64})

    return train.select("id", "v", F.xxhash64("id").alias("h")).mapInPandas(least, "tree int, place long, id string, v array<double>")


def forest_scores(train: DataFrame, queries: DataFrame, forests: list[tuple[int, int]], seed: int) -> DataFrame:
    """(id, iforest_T_S for each forest of T trees and samples of S): isolation-forest scores, 0 to 1, higher is odder.

    All forests come of one draw and are scored in one pass: a forest of fewer trees has the first trees of a larger
    one, a tree of a smaller sample the first rows. Their size depends on trees and samples alone.
    """
    trees, sizes = max(t for t, _ in forests), sorted({s for _, s in forests})
    need = {s: max(t for t, s2 in forests if s2 == s) for s in sizes}

    def grow(t: pd.DataFrame) -> pd.DataFrame:
        t, number = t.sort_values(["place", "id"]).iloc[: sizes[-1]], int(t["tree"].iloc[0])
        x = np.stack(t["v"].to_numpy())
        grown = [(s, _grow(x[:s], np.random.default_rng([seed, number, s]))) for s in sizes if number < need[s]]
        return pd.DataFrame({"tree": [number] * len(grown), "sample": [s for s, _ in grown], "n": [min(s, len(x)) for s, _ in grown], **{k: [g[k] for _, g in grown] for k in ("column", "cut", "left", "right", "depth")}})

    kinds = "tree int, sample int, n int, column array<int>, cut array<double>, left array<int>, right array<int>, depth array<double>"
    grown = draw(train, trees, sizes[-1], seed).groupBy("tree").applyInPandas(grow, kinds).collect()
    grown = sorted(grown, key=lambda r: (r["sample"], r["tree"]))
    held = train.sparkSession.sparkContext.broadcast([(r["sample"], r["tree"], r["n"], *[np.array(r[c]) for c in ("column", "cut", "left", "right", "depth")]) for r in grown])

    def score(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in tables:
            x = np.stack(t["v"].to_numpy()) if len(t) else np.zeros((0, 1))
            out, rows, last, total = {"id": t["id"]}, np.arange(len(x)), None, None
            for sample, tree, n, column, cut, left, right, depth in held.value:
                total = np.zeros(len(x)) if sample != last else total
                last, at = sample, np.zeros(len(x), np.int64)
                while (inner := column[at] >= 0).any():
                    go = x[rows, np.maximum(column[at], 0)] <= cut[at]
                    at = np.where(inner, np.where(go, left[at], right[at]), at)
                total = total + depth[at] / max(mean_path(n), 1e-9)
                if (tree + 1, sample) in forests:
                    out[f"iforest_{tree + 1}_{sample}"] = 2 ** -(total / (tree + 1))
            yield pd.DataFrame({"id": out["id"], **{c: out.get(c, np.full(len(x), np.nan)) for c in names}})

    names = [f"iforest_{t}_{s}" for t, s in forests]
    return queries.select("id", "v").mapInPandas(score, "id string, " + ", ".join(f"{c} double" for c in names))


def iforest(train: DataFrame, queries: DataFrame, trees: int, sample: int, seed: int) -> DataFrame:
    """(id, puntaje) of one forest."""
    return forest_scores(train, queries, [(trees, sample)], seed).withColumnRenamed(f"iforest_{trees}_{sample}", "puntaje")


def grid_points() -> list[dict]:
    """The grid in order: forests by trees, sample and contamination, then neighbours by number and contamination."""
    one = [{"modelo": "isolation_forest", "n_estimators": t, "max_samples": s, "n_neighbors": None, "contamination": c, "puntaje": f"iforest_{t}_{s}"} for t, s, c in product(TREES, SAMPLES, CONTAMINATIONS)]
    return one + [{"modelo": "lof", "n_estimators": None, "max_samples": None, "n_neighbors": k, "contamination": c, "puntaje": f"lof_{k}"} for k, c in product(NEIGHBOURS, CONTAMINATIONS)]


def model_grid(train: DataFrame, months: DataFrame, labels: DataFrame, k: int, seed: int, pilot: int) -> DataFrame:
    """A row a grid point, in order: modelo, its parameters, precision at ``k`` on the pilot year and on later ones
    (null where there are none), and whether it is the best: the highest on the pilot, the first among equals.

    ``months`` (id, v) are the pilot year's rows and all later ones, ``labels`` (id, anio, etiqueta) theirs.
    Contamination moves a model's threshold and not its order, so both of a model's points share a score.
    """
    forests = list(product(TREES, SAMPLES))
    near, asked = (once(nearest(q, train, max(NEIGHBOURS)), "vecinos") for q in (train, months))
    scores = lof_scores(near, asked, NEIGHBOURS).join(forest_scores(train, months, forests, seed), "id")
    names = [c for c in scores.columns if c != "id"]
    rows = scores.join(labels, "id").select("id", "etiqueta", F.when(F.col("anio") == pilot, "piloto").otherwise("estabilidad").alias("parte"), F.explode(F.array(*[F.struct(F.lit(c).alias("puntaje"), F.col(c).alias("x")) for c in names])).alias("s"))
    rows = rows.select("id", "etiqueta", "parte", "s.*")
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("puntaje", "parte").orderBy(F.desc("x"), "id"))).filter(F.col("r") <= k)
    part = lambda p: F.avg(F.when(F.col("parte") == p, F.col("etiqueta").cast("double"))).alias(f"precision_{p}")
    found = best.groupBy("puntaje").agg(part("piloto"), part("estabilidad"))
    kinds = "orden int, modelo string, n_estimators int, max_samples int, n_neighbors int, contamination double, puntaje string"
    points = train.sparkSession.createDataFrame([(i, *p.values()) for i, p in enumerate(grid_points())], kinds)
    grid = once(points.join(found, "puntaje", "left"), "rejilla")
    first = grid.orderBy(F.desc_nulls_last("precision_piloto"), "orden").limit(1).select("orden", F.lit(True).alias("mejor"))
    return grid.join(first, "orden", "left").withColumn("mejor", F.coalesce("mejor", F.lit(False))).drop("puntaje")


def final_scores(train: DataFrame, every: DataFrame, best: dict, seed: int) -> DataFrame:
    """(id, puntaje_modelo): what the chosen grid point, fitted on ``train``, gives each row of ``every``, training rows
    included, which it takes as it would new ones."""
    if best["modelo"] == "lof":
        return lof(train, every, best["n_neighbors"], itself=True).withColumnRenamed("puntaje", "puntaje_modelo")
    return iforest(train, every, best["n_estimators"], best["max_samples"], seed).withColumnRenamed("puntaje", "puntaje_modelo")
