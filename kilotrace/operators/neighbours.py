"""Exact nearest neighbours over all features, by a k-d tree in two storeys.

The upper storey is grown in the driver from a bounded sample and splits space into leaves of some ten thousands of
points, each a group of rows; the lower one is grown inside the task that holds a leaf. A query first meets its own
leaf, which bounds how far its neighbours can be, and then the leaves whose box lies within that bound alone; inside a
leaf it meets only cells within the bound it has by then. So the pairs that are compared grow with the logarithm of the
points, as long as they lie in few dimensions, and all neighbours found are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilotrace.sources.lake import once

#: Points of a leaf, and of a cell within it.
LEAF, CELL = 16_384, 96
#: Queries that a task takes at once against a leaf, and that meet a leaf's cells in one go.
QUERIES, TURN = 65_536, 8_192
#: Leaves of the upper storey at most (leaves beyond grow, and are dealt in blocks), and rows of the sample for each.
LEAVES, SAMPLE = 8_192, 24
#: Bounds are widened by rounding's share.
SLACK = 1 + 1e-9


class Tree:
    """The upper storey as flat arrays: a node's column (-1: leaf), cut, children, and a leaf's number."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.column, self.cut, self.left, self.right, self.leaf = ([] for _ in range(5))
        self.leaves = 0
        self._grow(sample, leaves)
        self.column, self.cut, self.left, self.right, self.leaf = map(np.array, (self.column, self.cut, self.left, self.right, self.leaf))

    def _grow(self, rows: np.ndarray, leaves: int) -> int:
        at = len(self.column)
        for held, x in ((self.column, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.leaf, -1)):
            held.append(x)
        if leaves > 1 and len(rows) > 1:
            low, high = np.quantile(rows, 0.05, axis=0), np.quantile(rows, 0.95, axis=0)
            spread = np.where(high > low, high - low, rows.max(axis=0) - rows.min(axis=0))
            c = int(spread.argmax())
            values = np.sort(rows[:, c])
            cut = float(values[(len(values) - 1) * (leaves // 2) // leaves])
            cut = cut if cut < values[-1] else float(values[np.searchsorted(values, cut) - 1]) if values[0] < cut else cut
            here = rows[:, c] <= cut
            if here.any() and not here.all():
                self.column[at], self.cut[at] = c, cut
                share = min(leaves - 1, max(1, round(leaves * here.mean())))
                self.left[at], self.right[at] = self._grow(rows[here], share), self._grow(rows[~here], leaves - share)
                return at
        self.leaf[at], self.leaves = self.leaves, self.leaves + 1
        return at

    def of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(x), int)
        while (inner := self.column[at] >= 0).any():
            go = x[np.arange(len(x)), np.maximum(self.column[at], 0)] <= self.cut[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
        return self.leaf[at]


def _matrix(v: pd.Series, size: int) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(float) if len(v) else np.zeros((0, size))


def _beyond(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of rows to boxes, (rows, boxes)."""
    out = np.zeros((len(x), len(low)))
    for c in range(x.shape[1]):
        out += np.maximum(np.maximum(low[None, :, c] - x[:, c, None], x[:, c, None] - high[None, :, c]), 0) ** 2
    return out


def _cells(y: np.ndarray) -> list[np.ndarray]:
    """Rows of ``y`` in cells of CELL at most, halved at the median of the widest column."""
    out, left = [], [np.arange(len(y))]
    while left:
        rows = left.pop()
        if len(rows) <= CELL:
            out.append(rows)
            continue
        part = y[rows]
        c, half = int(np.ptp(part, axis=0).argmax()), len(rows) // 2
        order = np.argpartition(part[:, c], half)
        left += [rows[order[half:]], rows[order[:half]]]
    return out


def search(ids: np.ndarray, x: np.ndarray, bound: np.ndarray, near: np.ndarray, y: np.ndarray, k: int, itself: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row of x, row of y, distance) of the k nearest rows of y within each row's ``bound``, ties to the smaller id of
    ``near``, and how many pairs were compared. A row's own id is left out unless ``itself``."""
    cells = _cells(y)
    low, high = (np.array([f(y[c], axis=0) for c in cells]) for f in (np.min, np.max))
    of_cell, place = np.empty(len(y), int), np.empty(len(y), int)
    for i, c in enumerate(cells):
        of_cell[c], place[c] = i, np.arange(len(c))
    own = np.full(len(ids), -1)
    if not itself:
        known = {n: i for i, n in enumerate(near)}
        own = np.array([known.get(i, -1) for i in ids])
    found, met = [], 0
    for a in range(0, len(x), TURN):
        q, mine, reach = x[a : a + TURN], own[a : a + TURN], bound[a : a + TURN].copy()
        beyond = _beyond(q, low, high)
        home = beyond.argmin(axis=1)
        best = np.full((len(q), k), np.inf)
        rows_of, cols_of, d_of = [], [], []

        def meet(rows: np.ndarray, cell: int) -> None:
            nonlocal met
            points = cells[cell]
            some, target = q[rows], y[points]
            d = np.zeros((len(rows), len(points)))
            for c in range(q.shape[1]):
                d += (some[:, c, None] - target[None, :, c]) ** 2
            d = np.sqrt(d)
            met += d.size
            here = (mine[rows] >= 0) & (of_cell[mine[rows]] == cell)
            d[np.flatnonzero(here), place[mine[rows[here]]]] = np.inf
            best[rows] = np.partition(np.concatenate([best[rows], d], axis=1), k - 1, axis=1)[:, :k]
            reach[rows] = np.minimum(reach[rows], best[rows].max(axis=1))
            at, of = np.nonzero(d <= (reach[rows] * SLACK)[:, None])
            rows_of.append(rows[at])
            cols_of.append(points[of])
            d_of.append(d[at, of])

        for cell in range(len(cells)):
            if len(rows := np.flatnonzero(home == cell)):
                meet(rows, cell)
        for cell in range(len(cells)):
            if len(rows := np.flatnonzero((beyond[:, cell] <= (reach * SLACK) ** 2) & (home != cell))):
                meet(rows, cell)
        rows, cols, d = (np.concatenate(p) if p else np.zeros(0, int) for p in (rows_of, cols_of, d_of))
        keep = (d <= reach[rows] * SLACK) & (d < np.inf)
        rows, cols, d = rows[keep], cols[keep], d[keep]
        order = np.lexsort((near[cols], d, rows))
        rows, cols, d = rows[order], cols[order], d[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        found.append((rows[first] + a, cols[first], d[first]))
    rows, cols, d = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, int) for i in range(3))
    return rows, cols, d, met


def nearest(queries: DataFrame, points: DataFrame, k: int, leaf: int = LEAF, itself: bool = False, tally: Accumulator | None = None) -> DataFrame:
    """(id, near, d, rank): the k nearest ``points`` (id string, v array<double>) of each query, exactly; ties go to the
    smaller id. A point of the query's own id is left out, unless ``itself``. ``tally`` gets the pairs compared.

    Leaves with many points (more than the tree can part, as equal ones) are dealt in blocks by hash, and a leaf asked
    by many queries meets them in several tasks, so no task holds more than a leaf's points and QUERIES queries.
    """
    spark = points.sparkSession
    rows = once(points.select("id", "v"), "puntos")
    n = rows.count()
    if not n:
        return queries.select("id", F.lit(None).cast("string").alias("near"), F.lit(None).cast("double").alias("d"), F.lit(None).cast("int").alias("rank")).limit(0)
    wanted = min(max(1, -(-n // leaf)), LEAVES)
    sample = rows.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(SAMPLE * wanted).select("v").collect() if wanted > 1 else rows.select("v").limit(1).collect()
    size = len(sample[0]["v"])
    tree = Tree(np.array([r["v"] for r in sample], float), wanted)
    held = spark.sparkContext.broadcast(tree)

    def routed(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in tables:
            yield t.assign(leaf=held.value.of(_matrix(t["v"], size)).astype(np.int32))

    put = lambda df: df.select("id", "v").mapInPandas(routed, "id string, v array<double>, leaf int")
    placed = once(put(rows), "hojas")
    edge = lambda f, name: [f(F.get("v", F.lit(c))).alias(f"{name}{c}") for c in range(size)]
    boxes = sorted(placed.groupBy("leaf").agg(F.count("*").alias("n"), *edge(F.min, "low"), *edge(F.max, "high")).collect(), key=lambda r: r["leaf"])  # at most LEAVES rows
    counts = dict((r["leaf"], max(1, -(-r["n"] // (2 * leaf)))) for r in boxes)
    blocks = F.array(*[F.lit(counts.get(i, 1)) for i in range(tree.leaves)])
    block_of = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.get(blocks, F.col("leaf"))).cast("int")
    placed = placed.withColumn("block", block_of(1))
    boxed = spark.sparkContext.broadcast((np.array([r["leaf"] for r in boxes]), *[np.array([[r[f"{name}{c}"] for c in range(size)] for r in boxes], float) for name in ("low", "high")], [counts[r["leaf"]] for r in boxes]))

    def met(asked: DataFrame) -> DataFrame:
        """(id, near, d) of ``asked`` (id, v, leaf, block, reach) in its leaves and blocks."""
        many = {(r["leaf"], r["block"]): -(-r["count"] // QUERIES) for r in asked.groupBy("leaf", "block").count().filter(F.col("count") > QUERIES).collect()}
        parts: Column = F.lit(1)
        for (a, b), parts_of in many.items():
            parts = F.when((F.col("leaf") == a) & (F.col("block") == b), parts_of).otherwise(parts)
        left = placed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))) if many else placed.withColumn("part", F.lit(0))
        right = asked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(3)), parts).cast("int"))

        def one(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            at, of, d, pairs = search(q["id"].to_numpy(), _matrix(q["v"], size), q["reach"].to_numpy(float), p["id"].to_numpy(), _matrix(p["v"], size), k, itself) if len(p) and len(q) else (np.zeros(0, int), np.zeros(0, int), np.zeros(0), 0)
            if tally is not None:
                tally.add(pairs)
            return pd.DataFrame({"id": q["id"].to_numpy()[at], "near": p["id"].to_numpy()[of], "d": d})

        key = ["leaf", "block", "part"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(one, "id string, near string, d double")

    first = once(put(queries).withColumn("block", block_of(2)).withColumn("reach", F.lit(float("inf"))), "preguntas")
    found = once(met(first), "primeros")
    reach = found.groupBy("id").agg(F.when(F.count("*") >= k, F.max("d")).otherwise(F.lit(float("inf"))).alias("reach"))
    if sum(counts.values()) > 1:
        asked = first.drop("reach").join(reach, "id", "left").fillna({"reach": float("inf")})

        def further(tables: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            leaves, low, high, blocks_of = boxed.value
            for t in tables:
                x, out = _matrix(t["v"], size), []
                for a in range(0, len(t), 4096):
                    part = t.iloc[a : a + 4096]
                    at, of = np.nonzero(_beyond(x[a : a + 4096], low, high) <= (part["reach"].to_numpy()[:, None] * SLACK) ** 2)
                    for b in range(max(blocks_of)):
                        some = np.array(blocks_of)[of] > b
                        new = part.iloc[at[some]].assign(to=leaves[of[some]], on=b)
                        out.append(new[(new["to"] != new["leaf"]) | (new["on"] != new["block"])])
                if out:
                    new = pd.concat(out)
                    yield pd.DataFrame({"id": new["id"], "v": new["v"], "leaf": new["to"].astype(np.int32), "block": new["on"].astype(np.int32), "reach": new["reach"]})

        asked = once(asked.mapInPandas(further, "id string, v array<double>, leaf int, block int, reach double"), "lejanas")
        found = found.union(met(asked))
    # a query's neighbours, k at most of each leaf it met
    best = F.slice(F.array_sort(F.collect_list(F.struct("d", "near"))), 1, k)
    return found.groupBy("id").agg(best.alias("best")).select("id", F.posexplode("best").alias("place", "b")).select("id", "b.near", "b.d", (F.col("place") + 1).alias("rank"))
