"""Incremental ingestion by a ledger of files, and event-time windows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kilotrace.sources.lake import delete, digests, same_path
from kilotrace.sources.releases import Releases

#: What the ledger knows of a file: the partition its rows are in, and how many it gave.
LEDGER = "ruta string, sha256 string, bytes long, origen string, filas long"


class Ledger:
    """A table whose rows are those of the files that a source folder holds now.

    A file's rows lie in a partition of their own, ``origen``, which is never written again. Which partitions count is
    in the ledger, and a ledger becomes the current one by one rename, together with the rows of its batch: so a batch
    counts whole or not at all, once, whatever is repeated after a failure. A file with new content gets a new
    partition in place of its old one (none, if it yields no row), and a file that has gone is withdrawn.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.releases = spark, root.rstrip("/"), Releases(spark, f"{root.rstrip('/')}/_ledger")

    def files(self) -> DataFrame:
        """The files whose rows count."""
        now = self.releases.current()
        return self.spark.read.schema(LEDGER).parquet(now["path"]) if now else self.spark.createDataFrame([], LEDGER)

    def rows(self, schema: StructType) -> DataFrame:
        """Their rows; ``origen`` tells them apart by file. The partitions that count are joined with the rows'."""
        return self._data(schema).join(self.files().select("origen"), "origen", "left_semi")

    def _data(self, schema: StructType) -> DataFrame:
        kinds = StructType([*schema.fields]).add("origen", "string")
        return self.spark.read.schema(kinds).parquet(f"{self.root}/data") if self._any() else self.spark.createDataFrame([], kinds)

    def _any(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def sync(self, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], file_format: str = "parquet", **options) -> dict:
        """Takes up what has changed in ``source`` and returns how many files were new, changed, withdrawn and kept.

        Only new and changed files are read. ``transform`` works row by row and keeps the column ``origen``.
        """
        before, now = self.files(), digests(self.spark, source)
        known = before.select(F.col("ruta").alias("_ruta"), F.col("sha256").alias("_sha"), "origen", "filas")
        state = now.join(known, same_path("ruta", "_ruta"), "full_outer")
        same = F.col("sha256") == F.col("_sha")
        batch = uuid.uuid4().hex[:12]
        mark = F.when(same, F.col("origen")).otherwise(F.concat(F.lit(f"{batch}-"), F.sha2("ruta", 256).substr(1, 24)))
        kind = F.when(F.col("ruta").isNull(), "retirados").when(F.col("_ruta").isNull(), "nuevos").when(same, "iguales").otherwise("cambiados")
        path = self.releases.stage()
        state = state.select("ruta", "sha256", "bytes", mark.alias("origen"), F.when(same, F.col("filas")).alias("filas"), kind.alias("clase"))
        state.write.parquet(f"{path}-estado")
        state = self.spark.read.schema(state.schema).parquet(f"{path}-estado")
        counts = {r["clase"]: r["count"] for r in state.groupBy("clase").count().collect()}
        out = {k: counts.get(k, 0) for k in ("nuevos", "cambiados", "retirados", "iguales")}
        if out["nuevos"] + out["cambiados"] + out["retirados"] == 0:
            delete(self.spark, f"{path}-estado")
            return out
        fresh = state.filter("clase IN ('nuevos', 'cambiados')")
        names = [r["ruta"] for r in fresh.select("ruta").collect()]  # as many as files have changed
        if names:
            read = self.spark.read.schema(schema).format(file_format).options(**options).load(names)
            read = read.withColumn("_archivo", F.col("_metadata.file_path")).join(F.broadcast(fresh.select("ruta", "origen")), same_path("_archivo", "ruta")).drop("_archivo", "ruta")
            transform(read).write.mode("append").partitionBy("origen").parquet(f"{self.root}/data")
        given = self._data(schema).filter(F.col("origen").startswith(batch)).groupBy("origen").agg(F.count("*").alias("n"))
        ledger = state.filter("ruta IS NOT NULL").join(given, "origen", "left").select("ruta", "sha256", "bytes", "origen", F.coalesce("filas", "n", F.lit(0)).cast("long").alias("filas"))
        ledger.write.parquet(path)
        written = self.spark.read.schema(LEDGER).parquet(path)
        expected = out["nuevos"] + out["cambiados"] + out["iguales"]
        self.releases.publish(path, [("every file once", lambda: written.agg((F.count("*") == expected) & (F.count_distinct("origen") == expected)).first()[0])], **out)
        delete(self.spark, f"{path}-estado")
        return out

    def vacuum(self) -> None:
        """Deletes partitions that no longer count, and former ledgers. Not while a batch is being taken up."""
        stay = {r["origen"] for r in self.files().select("origen").collect()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(root) if fs.exists(root) else []:
            name = s.getPath().getName()
            if name.startswith("origen=") and name.removeprefix("origen=") not in stay:
                fs.delete(s.getPath(), True)
        self.releases.prune()


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, state: str, transform: Callable[[DataFrame], DataFrame], file_format: str = "parquet") -> None:
    """Waits for arrivals with a stream and takes them up by the ledger in ``target``, then stops when there is nothing new.

    The stream only says that files have come; what they change is the ledger's to find. So a state that is lost, or a
    batch that is repeated, changes nothing.
    """
    ledger = Ledger(spark, target)
    stream = spark.readStream.schema(schema).format(file_format).option("header", True).load(source)
    take = lambda batch, number: ledger.sync(source, schema, transform, file_format, header=True)
    stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(take).start().awaitTermination()


def windowed_sums(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Sums by event-time window and kind, for streams and tables: on a stream, rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("suma")).select(F.col("window.start").alias("desde"), "event_type", "n", "suma")


def stream_windows(spark: SparkSession, source: str, schema: StructType, target: str, state: str, length: str = "1 hour", late: str = "10 minutes", files: int | None = None) -> None:
    """Runs ``windowed_sums`` over the files that have arrived and have not been taken up, ``files`` to a batch, and
    keeps the present sums in ``target``: the windows that a batch has changed are written for that batch, with its
    number, so a batch that is repeated writes them over. State is bounded by the watermark."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("lote", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("lote").parquet(target)

    reader = spark.readStream.schema(schema).format("parquet")
    stream = (reader if files is None else reader.option("maxFilesPerTrigger", files)).load(source)
    sums = windowed_sums(stream, length, late)
    sums.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def present_windows(spark: SparkSession, target: str) -> DataFrame:
    """Each window's sums as the last batch that changed it has them."""
    rows = spark.read.schema("desde timestamp, event_type string, n long, suma double, lote long").parquet(target)
    return rows.groupBy("desde", "event_type").agg(F.max(F.struct("lote", "n", "suma")).alias("s")).select("desde", "event_type", "s.n", "s.suma")
