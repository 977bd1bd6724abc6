"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into parts of equal size; a small classifier learns to tell a vector's part;
every vector is indexed in its most probable part, and a query is compared with the vectors of its several most
probable parts, exactly. Nearness is the inner product in double precision. How many parts a query takes is measured
on sample vectors that the classifier has not seen, by the same rule at every size.

Vectors that are null or zero, hold null or non-finite components, or differ in length from most, take no part, nor do
null ids. Of rows with one vec_id the least vector (component by component) takes part, so repeated rows count once.
Equal vectors tie, and the smaller vec_id wins. An empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilotrace.llm.common import Scratch


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id long, v array<double>) of the vectors that take part."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    cast = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    cast = cast.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(F.coalesce(fine, F.lit(False)))
    cast = cast.groupBy("vec_id").agg(F.min("v").alias("v"))
    most = cast.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return cast.filter(F.size("v") == (most["d"] if most else 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows, by inner product, of each row."""
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = x[at : at + 512] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
        out[at : at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, depth: int, rounds: int = 60, seed: int = 7) -> np.ndarray:
    """Cuts the graph into 2**depth parts of equal size: halves at the median of a smoothed random field, again and
    again. Averaging over neighbours brings the field near the slowest vector of the walk, whose median cuts few edges."""
    part = np.zeros(len(graph), np.int64)
    random = np.random.default_rng(seed)
    for _ in range(depth):
        after = np.zeros_like(part)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            local = np.full(len(graph), -1)
            local[own] = np.arange(len(own))
            edges = local[graph[own]]
            a, b = np.nonzero(edges >= 0)
            b = edges[a, b]
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
            degree = np.bincount(a, minlength=len(own)) + 1e-9
            field = random.standard_normal(len(own))
            for _ in range(rounds):
                field -= np.average(field, weights=degree)
                field = 0.5 * field + 0.5 * np.bincount(a, field[b], len(own)) / degree
                field /= np.linalg.norm(field) + 1e-30
            order = np.argsort(field, kind="stable")
            after[own[order[len(own) // 2 :]]] = 1
        part = 2 * part + after
    return part


@dataclass
class Router:
    """A network of one hidden layer from a vector to the probability of each part."""

    w1: np.ndarray
    w2: np.ndarray
    scale: float

    @staticmethod
    def hidden(x: np.ndarray, w1: np.ndarray) -> np.ndarray:
        return np.maximum(np.c_[x, np.ones(len(x))] @ w1, 0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = self.hidden(x * self.scale, self.w1)
        return np.c_[h, np.ones(len(h))] @ self.w2

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, width: int = 128, epochs: int = 60, seed: int = 7) -> Router:
        """Adam on the cross-entropy with each row's distribution of parts over its neighbours and itself."""
        random = np.random.default_rng(seed)
        scale = 1 / (np.sqrt((x**2).sum(axis=1).mean() / x.shape[1]) + 1e-30)
        x = x * scale
        w = [random.standard_normal((x.shape[1] + 1, width)) * np.sqrt(2 / x.shape[1]), random.standard_normal((width + 1, target.shape[1])) * 0.01]
        m, v, step = [0 * a for a in w], [0 * a for a in w], 0
        for epoch in range(epochs):
            order = random.permutation(len(x))
            for at in range(0, len(x), 256):
                rows = order[at : at + 256]
                xb = np.c_[x[rows], np.ones(len(rows))]
                h = np.c_[np.maximum(xb @ w[0], 0), np.ones(len(rows))]
                z = h @ w[1]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                d = (p - target[rows]) / len(rows)
                grads = [xb.T @ ((d @ w[1][:-1].T) * (h[:, :-1] > 0)), h.T @ d]
                step += 1
                for i, g in enumerate(grads):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 0.003 * (1 - epoch / epochs) * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return cls(w[0], w[1], scale)


def train(sample: np.ndarray, depth: int, neighbours: int = 12) -> Router:
    """The router of 2**depth parts of a sample."""
    graph = neighbour_graph(sample, min(neighbours, len(sample) - 1))
    part = balanced_parts(graph, depth)
    target = np.zeros((len(sample), 2**depth))
    target[np.arange(len(sample)), part] = graph.shape[1] / 4
    np.add.at(target, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].ravel()), 1)
    return Router.fit(sample, target / target.sum(axis=1, keepdims=True))


def probes_for(router: Router, known: np.ndarray, unseen: np.ndarray, k: int, recall: float) -> int:
    """How many parts of the most probable hold ``recall`` of the k nearest ``known`` vectors of ``unseen`` ones."""
    part, order = router.logits(known).argmax(axis=1), np.argsort(-router.logits(unseen), axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # of each part in a vector's order
    near = np.argsort(-(unseen @ known.T), axis=1, kind="stable")[:, :k]
    needed = np.take_along_axis(place, part[near], axis=1)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=order.shape[1])) / needed.size
    return int(np.searchsorted(found, recall)) + 1


def _compare(k: int):
    """Each query row with the index rows of its part and block, which stand before it: a task holds one block of the
    index at a time, and queries stream past it. Rows: (part, block, query, vec_id, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors = None, [], []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            part, block, query, vec_id = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            v = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(block) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, n], strict=True):
                if key != (part[a], block[a]):
                    key, ids, vectors = (part[a], block[a]), [], []
                if not query[a]:
                    ids.append(vec_id[a:b])
                    vectors.append(v[a:b])
                    continue
                if len(ids) != 1:
                    if not ids:
                        continue
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                for at in range(a, b, 256):
                    out.append(_nearest(vec_id[at : min(b, at + 256)], v[at : min(b, at + 256)], ids[0], vectors[0], k))
            found = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return run


def _nearest(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the k nearest rows of x, themselves apart, ties to the smaller id."""
    near = q @ x.T
    near[qid[:, None] == xid] = -np.inf
    last = min(k, near.shape[1]) - 1
    kth = -np.partition(-near, last, axis=1)[:, last]
    a, b = np.nonzero((near >= kth[:, None] - 1e-9 * (1 + np.abs(kth[:, None]))) & (near > -np.inf))
    exact = (q[a] * x[b]).sum(axis=1)  # the same sum for equal vectors, wherever they stand
    order = np.lexsort((xid[b], -exact, a))
    a, b, exact = a[order], b[order], exact[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return qid[a[keep]], xid[b[keep]], exact[keep]


def search(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", parts: int | None = None, sample: int = 32768, per_part: int = 64, recall: float = 0.92, block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every vector whose id is divisible by ``every``.

    There are ``parts`` parts, by default a quarter of the root of the rows, so that their number and size grow alike;
    16 at least (fewer only where rows are under 64) and as many as ``sample`` vectors at ``per_part`` a part allow;
    always a power of two. The router is fitted on so many distinct vectors, chosen by hash;
    a fifth of them, at most 1,024, is set aside to tell how many parts hold the share ``recall`` of a query's nearest.
    All vectors are indexed. A query takes more parts where those have fewer than k other vectors.

    Parts are dealt in blocks of about ``block`` vectors, so one large part is many tasks. Queries, which are the
    smaller side, go to the blocks of their parts; the index is shuffled once. Of equal vectors the k + 1 smallest ids
    are candidates: no query can have others of them among its nearest.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    rows = scratch.keep(usable(vectors, id_col, vector_col))
    total = rows.count()
    depth = int(np.log2(max(1, min(parts or max(16, total**0.5 / 4), sample / per_part, total / 4))))
    taken = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(per_part * 2**depth).collect()
    points = np.array([r["v"] for r in taken], np.float64)
    depth = max(0, min(depth, int(np.log2(max(1, len(points) / 4)))))
    parts, unseen = 2**depth, min(1024, len(points) // 5)
    router = train(points[unseen:], depth) if depth else None
    probes = probes_for(router, points[unseen:], points[:unseen], k, recall) if depth else 1
    held = spark.sparkContext.broadcast(router)

    def route(most: int, sizes: np.ndarray | None = None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                if held.value is None:
                    at, best = np.arange(n), np.zeros(n, np.int32)
                else:
                    x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                    order = np.argsort(-held.value.logits(x), axis=1, kind="stable").astype(np.int32)
                    wanted = np.broadcast_to(np.arange(parts) < most, order.shape)
                    if sizes is not None:  # parts go on until those before hold k vectors beside the query
                        wanted = wanted | (np.cumsum(sizes[order], axis=1) - sizes[order] <= k)
                    at, place = np.nonzero(wanted)
                    best = order[at, place]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(best)], names=["vec_id", "v", "part"])

        return run

    kind = "vec_id long, v array<double>, part int"
    ranked = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    distinct = rows.withColumn("copy", ranked).filter(F.col("copy") <= k + 1).select("vec_id", "v")
    index = scratch.keep(distinct.mapInArrow(route(1), kind))
    counted = index.groupBy("part").count().collect()  # as many rows as parts
    sizes = np.zeros(parts, np.int64)
    for r in counted:
        sizes[r["part"]] = r["count"]
    blocks = F.array(*[F.lit(max(1, -(-int(n) // block))) for n in sizes])
    spread = index.select("part", F.pmod(F.xxhash64("vec_id"), F.get(blocks, F.col("part"))).cast("int").alias("block"), F.lit(False).alias("query"), "vec_id", "v")
    queries = rows.filter(F.col("vec_id") % every == 0).mapInArrow(route(probes, sizes), kind)
    asked = queries.select("part", F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("part")) - 1)).alias("block"), F.lit(True).alias("query"), "vec_id", "v")
    met = spread.union(asked).repartition("part", "block").sortWithinPartitions("part", "block", "query")
    found = met.mapInArrow(_compare(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
