"""What the operators share: written tables in the cluster's shared folder, and word rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.sources.lake import owned, shared_dir

#: White space of the contracts: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


SEED = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and multiplications."""
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def seeded(i: int) -> np.uint64:
    """The i-th of a row of seeds."""
    return np.uint64(SEED * (i + 1) % 2**64)


def free(name: str, *tables: DataFrame) -> str:
    """``name``, with as many underscores after it as it takes to be no column of ``tables``."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Whether Spark deletes the shuffle files of a query as it ends; else they stay until the driver collects its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Written tables of one operator run. Writing one cuts the lineage, so a lost executor costs one step.

    Tables that the operator has done with are dropped as it goes. Those its result still reads stay, until the open
    owner closes (see ``lake.Owner``), or else as long as the cluster keeps the application's other checkpoints. With
    ``tidy`` a write's shuffle files go as it ends, so disk holds one step's at a time.
    """

    def __init__(self, spark: SparkSession, label: str, tidy: bool = False):
        self.spark, self.root, self.n, self.tidy = spark, owned(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"), 0, tidy

    def keep(self, df: DataFrame) -> DataFrame:
        """Writes ``df`` and returns the table as read again."""
        self.n += 1
        path, before = f"{self.root}/{self.n}", self.spark.conf.get(TIDY, "false")
        self.spark.conf.set(TIDY, "true" if self.tidy else before)
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(TIDY, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def keep_bucketed(self, df: DataFrame, by: str) -> DataFrame:
        """Writes ``df`` in buckets by a column, as many as a shuffle has partitions, so that a join on it needs no
        shuffle of this side. The catalogue's entry goes again at once; the files are those of any written table."""
        self.n += 1
        path, name = f"{self.root}/{self.n}", f"kilotrace_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, by).saveAsTable(name)
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def gathered(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte plane by byte plane: the high bytes of small numbers cost next to nothing."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def chunks(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in stretches of rows whose texts, in ``column``, have about ``size`` bytes."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(total)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node reachable.

    Alternating large-star and small-star steps: each round points nodes at smaller neighbours, in a number of
    rounds that grows with the logarithm of the longest path. Every step groups by node with map-side minima, and
    each round is a written table, so hot nodes need no task of their own.
    """
    now = scratch.keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        low = scratch.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = scratch.keep(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low2 = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low2, "a").select("b", "m").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch.keep(small.union(low2.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        # a fixed point has each node once and the same edges
        new = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.countDistinct("a")).first())
        scratch.drop(low, large, low2, now)
        now = after
        if new == mark or new[0] == 0:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
