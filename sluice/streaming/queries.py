"""Registered streaming flows: input files are written from the driver tables
in batches, the stream runs with ``availableNow``, and the sink is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.sinks import range_bucket
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.plans import views
from sluice.plans.loads import ORDERS_BUCKETS
from sluice.session import work_path
from sluice.sources.tables import Tables
from sluice.streaming import streams


# Input of one micro-batch: every batch rewrites the buckets it touches, so batches are as large as memory allows.
BATCH_BYTES = 64 << 30


def _year(c: str):
    return F.year(F.col(c))


def stream_incremental_load(t: Tables) -> DataFrame:
    """Three batch folders, a run, an idle rerun, a fourth folder, a rerun:
    every order lands in the sink exactly once."""
    spark, root = t.spark, work_path(t.spark, "stream-load")
    orders = t.orders.select(*views.ORDER_COLS)
    y = _year("o_orderdate")
    src, sink, ckpt = f"{root}/in/*", f"{root}/sink", f"{root}/checkpoint"
    for i, cond in enumerate([(y <= 1996) | y.isNull(), (y >= 1997) & (y <= 1998), (y >= 1999) & (y <= 2000)], 1):
        orders.where(cond).write.parquet(f"{root}/in/b{i}")
    streams.incremental_load(spark, src, orders.schema, sink, ckpt)
    streams.incremental_load(spark, src, orders.schema, sink, ckpt)  # nothing new: reads nothing
    orders.where(y >= 2001).write.parquet(f"{root}/in/b4")
    streams.incremental_load(spark, src, orders.schema, sink, ckpt)
    return spark.read.parquet(sink)


def stream_upsert(t: Tables) -> DataFrame:
    spark, root = t.spark, work_path(t.spark, "stream-upsert")
    base = t.orders.select(*views.ORDER_COLS, F.lit(0).alias("seq"))
    delta = views.orders_delta(t)
    base.write.parquet(f"{root}/in/b1")
    delta.where(F.col("seq") == 1).write.parquet(f"{root}/in/b2")
    delta.where(F.col("seq") == 2).write.parquet(f"{root}/in/b3")
    target = BucketedTable(spark, f"{root}/target",
                           range_bucket(ORDERS_BUCKETS["column"], ORDERS_BUCKETS["width"]))
    streams.upsert_stream(spark, f"{root}/in/*", base.schema, target, ["o_orderkey"], "seq",
                          f"{root}/checkpoint", max_bytes=BATCH_BYTES)
    return target.read().select(*views.ORDER_COLS)


def stream_classify_lines(t: Tables) -> DataFrame:
    spark, root = t.spark, work_path(t.spark, "stream-lines")
    lines = views.log_lines(t)
    lines.write.parquet(f"{root}/in/b1")
    streams.classify_stream(spark, f"{root}/in/*", lines.schema, f"{root}/sink", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/sink")


def stream_status_counts(t: Tables) -> DataFrame:
    spark, root = t.spark, work_path(t.spark, "stream-status")
    ts = views.task_state(t)
    ts.write.parquet(f"{root}/in/b1")
    target = VersionedTable(spark, f"{root}/target")
    streams.status_count_stream(spark, f"{root}/in/*", ts.schema, target, f"{root}/checkpoint", max_bytes=BATCH_BYTES)
    return target.read()
