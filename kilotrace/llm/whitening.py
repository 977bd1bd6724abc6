"""Whitening of vectors by an incremental eigendecomposition.

Every partition keeps the spectrum of its scatter about its own mean and takes up vectors by centred rank-one updates:
an update of a diagonal matrix, whose new eigenvalues are the roots of a secular equation between the old ones. Spectra
of partitions are combined in a tree: one's scaled eigenvectors, and the shift between the means, are further rank-one
updates of the other. The basis found so is refined by Rayleigh-Ritz: all rows are projected on it, and the covariance
of the projections, a sum over the partitions, is diagonalised.

Rows whose vector is null or holds null or non-finite entries are left out; rows with a null vec_id and repeated rows
count like any other. An empty table, or one without such vectors, gives an empty result. Vectors must have one length.
Components without variance (under 1e-12 of the trace) whiten nothing and are left out, so a table of equal rows gives
none. Other columns of the input are left aside. Sums and deviations are whole numbers; ``deviation`` is null where it
passes 64 bits, ``deviation_38`` has it there too.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import Scratch

#: What a whole number stands for: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: The share of the trace that a component must hold.
LEAST = 1e-12
EPS = np.finfo(float).eps
#: Spectra combined by one task.
FAN = 8
SPECTRUM = "node long, n long, mean binary, values binary, vectors binary"


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x) = 0 for falling, distinct ``d`` and positive ``z2``: root i lies between d[i] and
    the entry above. Given as (entry nearest, distance from it), so that differences to entries keep their digits.

    All roots at once. A step solves the equation with the poles below a root and those above each put into the one
    next to it, with the values and slopes they have; where that leaves the root's bracket, the bracket is halved.
    """
    n, i = len(d), np.arange(len(d))
    above = np.concatenate([[d[0] + z2.sum()], d[:-1]])
    half = (above - d) / 2
    upper = (i > 0) & ((1 + (z2 / (d - (d + half)[:, None])).sum(axis=1)) < 0)
    origin = i - upper
    delta = d[None, :] - d[origin][:, None]  # row i: the entries as seen from root i's origin
    low, top = np.where(upper, -half, 0.0), np.where(upper, 0.0, np.where(i > 0, half, 2 * half))
    x, below = (low + top) / 2, np.tri(n, dtype=bool).T
    for _ in range(100):
        away = delta - x[:, None]
        part = z2 / away
        slope = part / away
        value = 1 + part.sum(axis=1)
        low, top = np.where(value < 0, x, low), np.where(value < 0, top, x)
        near, far = away[i, i], np.where(i > 0, away[i, i - 1], 1.0)
        down, up = (slope * below).sum(axis=1), (slope * ~below).sum(axis=1)
        c = value - down * near - up * np.where(i > 0, far, 0.0)
        a, b = c * (near + far) + down * near**2 + up * far**2, near * far * value
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(i > 0, step, near + down * near**2 / c)
        new = x + step
        new = np.where((new > low) & (new < top), new, (low + top) / 2)
        done = (np.abs(new - x) <= 2 * EPS * np.abs(x)) | (np.abs(value) <= 4 * EPS * (1 + np.abs(part).sum(axis=1)))
        x = np.where(done, x, new)
        if done.all():
            break
    return origin, x


class Spectrum:
    """Rows met so far: how many, their mean, and the eigenvalues (falling) and eigenvectors of their scatter."""

    def __init__(self, size: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(size), np.zeros(size), np.eye(size)

    def update(self, v: np.ndarray) -> None:
        """Adds the outer product of ``v`` to the scatter."""
        z, d = v @ self.vectors, self.values
        norm = float(np.sqrt(z @ z))
        small = 8 * EPS * max(d[0], norm**2)
        live = np.flatnonzero(np.abs(z) * norm > small)  # deflation: v has no part in the others
        if not len(live):
            return
        kept = []
        for i, j in zip(live.tolist(), [*live[1:].tolist(), -1], strict=True):
            if j >= 0:
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                if abs((d[i] - d[j]) * c * s) <= small:  # deflation: nearly equal, turned so that j takes all of v's part
                    a, b = self.vectors[:, i].copy(), self.vectors[:, j].copy()
                    self.vectors[:, i], self.vectors[:, j] = c * a - s * b, s * a + c * b
                    d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
                    z[i], z[j] = 0.0, r
                    continue
            kept.append(i)
        at = np.array(kept)
        at = at[np.argsort(-d[at], kind="stable")]
        e, w = d[at], z[at]
        origin, x = secular_roots(e, w * w)
        gaps = (e[origin] - e[:, None]) + x  # root j - entry k, in row k
        others = e - e[:, None]
        np.fill_diagonal(others, 1.0)
        # the weights for which these roots are exact: with them the new eigenvectors are at right angles
        weight = np.prod(gaps / others, axis=1)
        new = (np.copysign(np.sqrt(np.maximum(weight, 0)), w))[:, None] / gaps
        new /= np.sqrt((new * new).sum(axis=0))
        self.vectors[:, at] = self.vectors[:, at] @ new
        self.values[at] = e[origin] + x
        fall = np.argsort(-self.values, kind="stable")
        self.values, self.vectors = self.values[fall], self.vectors[:, fall]

    def rows(self, x: np.ndarray) -> None:
        """Takes up rows. More rows than they have entries are first turned into as many with the same scatter."""
        n, mean = len(x), x.mean(axis=0)
        centred = x - mean
        self._joined(n, mean, np.linalg.qr(centred, mode="r") if n > x.shape[1] else centred if n > 1 else centred[:0])

    def absorb(self, other: Spectrum) -> None:
        self._joined(other.n, other.mean, (np.sqrt(np.maximum(other.values, 0)) * other.vectors).T)

    def _joined(self, n: int, mean: np.ndarray, scatter: np.ndarray) -> None:
        """Adds ``n`` rows of that mean; ``scatter`` has rows with their scatter about it."""
        shift, total = mean - self.mean, self.n + n
        for v in scatter:
            self.update(v)
        if self.n:
            self.update(np.sqrt(self.n * n / total) * shift)
        self.mean, self.n = self.mean + shift * (n / total), total

    def row(self, node: int) -> dict:
        return {"node": [node], "n": [self.n], **{k: [np.ascontiguousarray(x, np.float64).tobytes()] for k, x in (("mean", self.mean), ("values", self.values), ("vectors", self.vectors))}}

    @classmethod
    def read(cls, r) -> Spectrum:
        mean = np.frombuffer(r["mean"])
        own = cls(len(mean))
        own.n, own.mean, own.values, own.vectors = r["n"], mean, np.frombuffer(r["values"]).copy(), np.frombuffer(r["vectors"]).reshape(len(mean), -1).copy()
        return own


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The whole numbers of a batch's vectors, a row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) != len(column) * size:
        raise ValueError(f"all vectors must have {size} entries")
    return flat.reshape(len(column), size)


def _summed(rows: DataFrame, size: int, of, kind: str = "double") -> tuple[int, np.ndarray]:
    """(rows, the sum over all blocks of the matrix or vector ``of`` makes of a block): a task gives one partial sum,
    whose lines are added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                part = np.atleast_2d(of(_matrix(batch.column(0), size)))
                n, total = n + batch.num_rows, part if total is None else total + part
        if n:
            lines = pa.array(list(total), pa.list_(pa.int64() if kind == "long" else pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array([n] * len(total), pa.int64()), lines], names=["line", "n", "part"])

    parts = rows.select("x").mapInArrow(run, f"line long, n long, part array<{kind}>")
    sums = parts.groupBy("line").agg(F.sum("n").alias("n"), *[F.sum(F.get("part", F.lit(i))).alias(f"s{i}") for i in range(size)]).collect()  # as many rows as a vector has entries
    sums = sorted(sums, key=lambda r: r["line"])
    return (sums[0]["n"], np.array([[r[f"s{i}"] for i in range(size)] for r in sums])) if sums else (0, np.zeros((1, size)))


def whole_numbers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>) of the rows that take part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + OFFSET)
    return embeddings.filter(F.col(vector).isNotNull() & ~bad & (F.size(vector) > 0)).select(F.col("vec_id").cast("long"), x.alias("x"))


def spectrum(rows: DataFrame, size: int, scratch: Scratch, block: int = 4096) -> Spectrum:
    """The spectrum of all rows' scatter: those of the partitions, combined FAN at a time until one is left."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(size)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                own.rows((_matrix(batch.column(0).slice(at, block), size) - OFFSET).astype(float))
        if own.n:
            yield pa.RecordBatch.from_pydict(own.row(TaskContext.get().partitionId()))

    def combined(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("node")
        own = Spectrum.read(table.iloc[0])
        for _, r in table.iloc[1:].iterrows():
            own.absorb(Spectrum.read(r))
        return pd.DataFrame(own.row(int(table["node"].iloc[0]) // FAN))

    now = scratch.keep(rows.select("x").mapInArrow(one, SPECTRUM))
    while now.count() > 1:
        after = scratch.keep(now.groupBy((F.col("node") / FAN).cast("long").alias("parent")).applyInPandas(combined, SPECTRUM))
        scratch.drop(now)
        now = after
    found = now.first()
    scratch.drop(now)
    return Spectrum.read(found)


def whiten(embeddings: DataFrame, components: int = 32, vector: str = "embedding", block: int = 4096) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_38) of every remaining row and
    component. Five passes over the table; what meets in the driver are matrices with as many lines and columns as a
    vector has entries."""
    spark = embeddings.sparkSession
    scratch, rows = Scratch(spark, "whiten"), whole_numbers(embeddings, vector)
    size = rows.agg(F.max(F.size("x"))).first()[0] or 0
    kinds = "vec_id long, n long, deviation long, deviation_38 decimal(38,0), z array<double>"
    n, sums = _summed(rows, size, lambda x: x.sum(axis=0), "long") if size else (0, None)
    basis, explained, error = np.zeros((size, 0)), [], 0.0
    if n:
        sums = sums[0].astype(np.int64)
        centred = lambda x: (x * n - sums) / n
        found = spectrum(rows, size, scratch, block).vectors
        found, _ = np.linalg.qr(found)

        def projected(x: np.ndarray) -> np.ndarray:
            y = centred(x) @ found
            return y.T @ y

        small = _summed(rows, size, projected)[1] / n
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns, trace = values[::-1], turns[:, ::-1], float(np.trace(small))
        k = int((values[:components] > LEAST * trace).sum())
        explained = (values[:k] / trace).tolist() if k else []
        basis = (found @ turns[:, :k]) / np.sqrt(values[:k])

        def whitened(x: np.ndarray) -> np.ndarray:
            out = np.zeros((size + 1, size))
            z = centred(x) @ basis
            out[:k, :k], out[size, :k] = z.T @ z, z.sum(axis=0)
            return out

        if k:
            both = _summed(rows, size, whitened)[1] / n
            error = float(np.abs(both[:k, :k] - np.outer(both[size, :k], both[size, :k]) - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                off = _matrix(part.column(1), size) * n - sums
                fits = (off.astype(float) ** 2).sum(axis=1) < 9.2e18
                short = np.where(fits, (np.where(fits[:, None], off, 0) ** 2).sum(axis=1), 0)
                exact = [int(s) if f else sum(int(v) ** 2 for v in o) for s, f, o in zip(short.tolist(), fits.tolist(), off, strict=True)]
                columns = [part.column(0), pa.array([n] * len(off), pa.int64()), pa.array(short, mask=~fits), pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0)), pa.array(list((off / n) @ basis), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "n", "deviation", "deviation_38", "z"])

    out = rows.mapInArrow(run, kinds).select("vec_id", "n", "deviation", "deviation_38", F.posexplode("z").alias("place", "whitened"))
    share = F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("place"))
    return out.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"), "deviation_38")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
