"""Bounded incremental batches: an increment cut into ranges of its field.

The field's values are counted, with partial aggregation, and only these counts
are range-partitioned and summed up; rows are neither sorted nor moved.  All
rows of one value are in one batch, so that a watermark can stand between any
two.  A value with more than half of the bound is a batch of its own; the others
fill windows of half the bound by what comes before them, so that a window's
rows, with the value that reaches beyond it, never pass the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

from sluice.operators.sizing import broadcast_if_small
from sluice.session import work_path


def bound_value(text: str, kind: DataType) -> Column:
    return F.timestamp_micros(F.lit(int(text))) if kind == TimestampType() else F.lit(text).cast(kind)


def batch_bounds(df: DataFrame, field: str, batch_size: int) -> DataFrame:
    """(batch, low, high, rows): consecutive ranges, numbered from 0, with ``low <= field <= high``.

    ``rows`` is at most ``batch_size``, but for a single value that has more.  Rows whose field is NULL are the first
    batch, with NULL bounds.  ``low`` and ``high`` are text, which ``bound_value`` reads back exactly.
    """
    spark = df.sparkSession
    values = df.groupBy(F.col(field).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    heavy = (F.col("n") * 2 > batch_size) | F.col("v").isNull()
    laid = values.repartitionByRange("v").select("v", "n", heavy.alias("heavy"), F.spark_partition_id().alias("part"))
    path = work_path(spark, "batch-values")
    laid.write.parquet(path)
    laid = spark.read.schema(laid.schema).parquet(path)

    light = F.when(F.col("heavy"), 0).otherwise(F.col("n"))
    # A row a partition, summed up in order of the ranges.
    parts = laid.groupBy("part").agg(F.sum(light).alias("n"), F.count_if("heavy").alias("h"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("n0"), F.coalesce(F.sum("h").over(so_far), F.lit(0)).alias("h0"))
    own = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = laid.join(broadcast_if_small(parts), "part").select(
        "v", "n", "heavy", (F.col("n0") + F.coalesce(F.sum(light).over(own), F.lit(0))).alias("before"),
        (F.col("h0") + F.coalesce(F.sum(F.col("heavy").cast("int")).over(own), F.lit(0))).alias("heavies"))
    window = F.when(F.col("heavy"), -1).otherwise(F.floor(F.col("before") * 2 / batch_size))
    text = F.col("v").cast("string")
    if df.schema[field].dataType == TimestampType():  # microseconds, whatever the session's zone is
        text = F.unix_micros("v").cast("string")
    batches = placed.groupBy("heavies", "heavy", window.alias("window")).agg(
        F.min("v").alias("v"), F.min_by(text, "v").alias("low"), F.max_by(text, "v").alias("high"), F.sum("n").alias("rows"))
    # A row a batch: what follows is the list of bounds, not data.
    number = F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first())) - 1
    return batches.select(number.cast("long").alias("batch"), "low", "high", "rows")
