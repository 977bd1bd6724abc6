"""Running sums in a global order, by range partitioning and prefix sums of the partitions' totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilotrace.sources.lake import once


def running_sum(df: DataFrame, order: list[Column], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` over the rows up to each in ``order``, which must tell rows apart.

    Rows are dealt to ranges of the order and written with the range's number; a window sums within a range, and the
    ranges before it add their totals: as many sums as there are ranges, so they are broadcast. No task holds more
    than a range, whatever the keys.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = once(df.repartitionByRange(n, *order).withColumns({"_part": F.spark_partition_id(), "_value": value}), "tramos")
    totals = cut.groupBy("_part").agg(F.sum("_value").alias("_total"))
    before = F.coalesce(F.sum("_total").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("_part", before.alias("_before"))  # one row a range
    own = F.sum("_value").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn(name, F.col("_own") + F.col("_before")).drop("_part", "_value", "_own", "_before")
