"""The lake: scans with declared schemas, partitioned sinks, manifests and deliveries."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kilotrace.functions import clean as C

#: Spanish month abbreviations of the rate service, in calendar order. Fixed values.
RATE_MONTHS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Set", "Oct", "Nov", "Dic")
RATES = "periods array<struct<name:string,values:array<string>>>"


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with every cell as text; only empty cells are null."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("nullValue", "").option("enforceSchema", False).csv(path)


def read_rates(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(fecha, tc_oficial, anio, mes) of a rate service's JSON; days without a rate are left out."""
    periods = spark.read.schema(RATES).option("multiLine", multi_line).json(path).select(F.explode("periods").alias("p"))
    number = F.create_map(*[F.lit(x) for i, m in enumerate(RATE_MONTHS, 1) for x in (m, i)])
    part = lambda i: F.regexp_extract("p.name", r"^(\d{1,2})\.(\w{3})\.(\d{2})$", i)
    year = part(3).try_cast("int")
    date = F.try_make_timestamp(F.when(year < 69, year + 2000).otherwise(year + 1900), F.try_element_at(number, part(2)), part(1).try_cast("int"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    out = periods.select(date.alias("fecha"), F.get("p.values", F.lit(0)).try_cast("double").alias("tc_oficial")).dropna()
    return out.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})


def read_table(spark: SparkSession, path: str, schema: StructType, where: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table under its declared schema; a missing path is an empty table. Filters and columns reach the scan."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    df = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
    df = df if where is None else df.filter(where)
    return df.select(*columns) if columns else df


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("anio", "mes"), rows_per_file: int = 5_000_000) -> None:
    """Replaces only the partitions that ``df`` has. Rows are gathered by partition, which adaptive execution splits
    over tasks where one is large; files have bounded numbers of rows."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def fingerprint(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.count("*").alias("filas"), F.round(F.coalesce(F.sum(value), F.lit(0.0)), 3).alias("suma"))


def regenerate(spark: SparkSession, path: str, source: DataFrame, year: int, month: int, value: str) -> bool:
    """Rebuilds one partition from its source; whether its fingerprint is what it was."""
    part = (F.col("anio") == year) & (F.col("mes") == month)
    before = fingerprint(spark.read.parquet(path).filter(part), value).first()
    write_partitioned(source.filter(part), path)
    return before == fingerprint(spark.read.parquet(path).filter(part), value).first()


def latest_delivery(files: DataFrame, until: Column | None = None) -> DataFrame:
    """The newest delivery of each source's logical file. files: (ruta) such as .../fuente/fecha_carga=2020-01-31/x.csv.

    Only CSV and spreadsheets count; paths without a valid date are left out."""
    date = F.regexp_extract("ruta", r"fecha_carga=(\d{4}-\d{2}-\d{2})/", 1).try_cast("date")
    f = files.select("ruta", F.regexp_extract("ruta", r"([^/]+)/fecha_carga=", 1).alias("codigo"), F.regexp_extract("ruta", r"([^/]+)$", 1).alias("archivo"), date.alias("fecha_carga"))
    f = f.filter(F.lower("archivo").rlike(r"\.(csv|xlsx?)$") & F.col("fecha_carga").isNotNull())
    f = f if until is None else f.filter(F.col("fecha_carga") <= until)
    best = f.groupBy("codigo", "archivo").agg(F.max(F.struct("fecha_carga", "ruta")).alias("m"))
    return best.select("codigo", "archivo", "m.fecha_carga", "m.ruta")


def delivery_coverage(sources: DataFrame, latest: DataFrame) -> DataFrame:
    """Files and newest date of every declared source, ``sin_archivos`` where there are none."""
    found = latest.groupBy("codigo").agg(F.count("*").alias("archivos"), F.max("fecha_carga").alias("ultima"))
    return sources.join(found, "codigo", "left").fillna(0, ["archivos"]).withColumn("estado", F.when(F.col("archivos") > 0, "disponible").otherwise("sin_archivos"))


#: Bytes of a file that Spark reads as one value; larger ones are read in stretches of STRETCH.
WHOLE, STRETCH = 256 << 20, 8 << 20


def _stretched(batches):
    """SHA-256 of each file of (ruta, bytes), read in stretches inside the task."""
    import hashlib
    from urllib.parse import quote

    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            h, (store, at) = hashlib.sha256(), fs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", path), safe="/:@"))
            with store.open_input_stream(at, compression=None) as f:
                while part := f.read(STRETCH):
                    h.update(part)
            found.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["ruta", "bytes", "sha256"])


def digests(spark: SparkSession, path: str, whole: int = WHOLE) -> DataFrame:
    """(ruta, bytes, sha256) of all files under a path. Files of up to ``whole`` bytes are values of a scan; larger
    ones, of any size, are dealt to tasks, which read them in stretches through the store their path names. Files
    without a byte are none to a scan, and left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    size = F.col("length")
    small = files.load(path).filter(size <= whole).select(F.col("path").alias("ruta"), size.alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.load(path).filter(size > whole).select(F.col("path").alias("ruta"), size.alias("bytes"))
    if not large.limit(1).count():
        return small
    return small.union(large.repartition("ruta").mapInArrow(_stretched, "ruta string, bytes long, sha256 string"))


def file_manifest(spark: SparkSession, path: str, load_date: str, previous: DataFrame | None = None, text: bool = True) -> DataFrame:
    """(nombre, ruta, bytes, sha256, filas, fecha_carga) of files, after the previous manifest's, whose files (same
    path and digest) are not repeated. Rows are counted in text files alone."""
    now = digests(spark, path).select(F.regexp_extract("ruta", r"([^/]+)$", 1).alias("nombre"), "ruta", "bytes", "sha256")
    counts = row_counts(spark, path).withColumnRenamed("ruta", "_ruta") if text else None
    now = now.withColumn("filas", F.lit(None).cast("long")) if counts is None else now.join(counts, same_path("ruta", "_ruta"), "left").drop("_ruta")
    now = now.withColumn("fecha_carga", F.lit(load_date).cast("date"))
    return now if previous is None else previous.unionByName(now.join(previous, ["ruta", "sha256"], "left_anti"))


def positions(scan: DataFrame, first: int = 1) -> DataFrame:
    """``scan``, read from files and not changed yet, with ``archivo`` and ``fila``: each row's place in its file, from
    ``first`` on.

    The scan is written with what it knows: the file and block of a row, and its number in the task. Rows of a block
    come one after the other, so a place is the number since the block's first and the rows of the file's blocks before
    it: sums of as many rows as there are blocks, and no sort of the rows.
    """
    meta = F.col("_metadata")
    own = [c for c in scan.columns if c != "_metadata"]
    rows = once(scan.select(*own, meta["file_path"].alias("archivo"), meta["file_block_start"].alias("_block"), F.monotonically_increasing_id().alias("_n")), "filas")
    blocks = rows.groupBy("archivo", "_block").agg(F.min("_n").alias("_first"), F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("archivo").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("archivo", "_block", "_first", before.alias("_before"))
    return rows.join(starts, ["archivo", "_block"]).withColumn("fila", F.col("_n") - F.col("_first") + F.col("_before") + first).select(*own, "archivo", "fila")


def same_path(a: str, b: str) -> Column:
    """Whether two paths are one, however the slashes after their scheme are written."""
    return F.regexp_replace(a, "^([a-z]+:)/+", "$1/") == F.regexp_replace(b, "^([a-z]+:)/+", "$1/")


def dedupe_files(files: DataFrame) -> DataFrame:
    """Of files (nombre, sha256) with the same content one stays: names without a copy mark first, then by name."""
    copy = F.col("nombre").rlike(r"\(\d+\)")
    keep = files.groupBy("sha256").agg(F.min(F.struct(copy.alias("c"), "nombre")).alias("k")).select("sha256", F.col("k.nombre").alias("igual_a"))
    out = files.join(keep, "sha256")
    same = F.col("nombre") == F.col("igual_a")
    return out.select("nombre", "sha256", F.when(same, "aceptado").otherwise("duplicado_rechazado").alias("estado"), F.when(~same, F.col("igual_a")).alias("igual_a"))


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines but one (the header) of each text file."""
    lines = spark.read.text(path, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("ruta"), "value")
    return lines.groupBy("ruta").agg((F.count_if(F.trim("value") != "") - 1).alias("filas"))


def route(names: DataFrame, rules: list[tuple[str, str]], default: str, load_date: str) -> DataFrame:
    """The first rule's domain whose pattern a file name matches, and its place in the lake. Rules are configuration."""
    domain = F.lit(default)
    for pattern, name in reversed(rules):
        domain = F.when(F.col("archivo").rlike(pattern), name).otherwise(domain)
    code = C.file_slug(F.col("archivo"))
    return names.withColumns({"dominio": domain, "codigo": code}).withColumn("destino", F.concat_ws("/", F.lit("bronze/interno/estructurado"), "dominio", "codigo", F.lit(f"fecha_carga={load_date}"), "archivo"))


def source_code(path: Column) -> Column:
    """A code such as ABA-02 or aba02 in a path's parts, the deepest first, as aba_02."""
    parts = F.reverse(F.split(path, "/"))
    pattern = r"(?i)\b([a-z]{3,4})[-_ ]?(\d{2})\b"
    codes = F.filter(F.transform(parts, lambda p: F.when(p.rlike(pattern), F.lower(F.concat_ws("_", F.regexp_extract(p, pattern, 1), F.regexp_extract(p, pattern, 2))))), lambda c: c.isNotNull())
    return F.get(codes, F.lit(0))


def volume(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes by layer (first folder), source (a code in the path, else the second folder) and kind (extension)."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    rest = F.substring_index("path", path.rstrip("/").split("/")[-1] + "/", -1)
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    source = F.coalesce(source_code(rest), F.regexp_extract(rest, "^[^/]+/([^/]+)/", 1))
    return f.groupBy(F.regexp_extract(rest, "^([^/]+)/", 1).alias("capa"), source.alias("fuente"), kind.alias("tipo")).agg(F.count("*").alias("archivos"), F.sum("length").alias("bytes"))


def delimiter(lines: DataFrame, most: int = 20) -> DataFrame:
    """(archivo, delimitador) of lines (archivo, n, value): the one that most lines share a count of, then the larger
    count, among each file's first non-blank lines; a comma where there is none."""
    first = lines.filter(F.trim("value") != "").withColumn("r", F.row_number().over(Window.partitionBy("archivo").orderBy("n"))).filter(F.col("r") <= most)
    marks = F.explode(F.array(*[F.struct(F.lit(-i).alias("o"), F.lit(d).alias("d")) for i, d in enumerate((",", ";", "|", "\t"))]))
    each = first.select("archivo", "value", marks.alias("m")).select("archivo", "m.*", (F.length("value") - F.length(F.replace("value", F.col("m.d")))).alias("k")).filter("k > 0")
    shared = each.groupBy("archivo", "d", "o", "k").agg(F.count("*").alias("n"))
    best = shared.groupBy("archivo").agg(F.max_by("d", F.struct("n", "k", "o")).alias("delimitador"))
    return lines.select("archivo").distinct().join(best, "archivo", "left").fillna(",", ["delimitador"])


def create_external(spark: SparkSession, name: str, path: str, schema: StructType, by: tuple[str, ...] = ()) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(by)})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 128 << 20) -> None:
    """Writes a table's files anew, each of about ``file_bytes``: as many as their total takes, of rows dealt evenly."""
    size = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    spark.read.parquet(source).repartition(max(1, -(-size // file_bytes))).write.parquet(target)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of any of Spark's file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: The folder of sessions on a local master that name none, as in tests.
_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, ``spark.checkpoint.dir``. Only a local master may do without: driver and tasks
    are then one machine, and a temporary folder serves."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="kilotrace-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


_OWNERS: list[Owner] = []


class Owner:
    """Owns the folders that are made while it is open, and deletes them when it closes.

    ``with Owner(spark): query(spark, dir).write.parquet(out)`` leaves nothing in the shared folder. Results that are
    read later must be written before it closes. Without an owner, folders stay with the cluster's other checkpoints.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Owner:
        _OWNERS.append(self)
        return self

    def __exit__(self, *_) -> None:
        _OWNERS.remove(self)
        for path in self.paths:
            delete(self.spark, path)


def owned(path: str) -> str:
    """``path``, which the innermost open owner is to delete."""
    if _OWNERS:
        _OWNERS[-1].paths.append(path)
    return path


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share."""
    return owned(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")


def once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, for several branches of a plan that would each work it out."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
