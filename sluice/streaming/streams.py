"""Structured Streaming versions of the incremental paths.

* ``incremental_load``  file source -> parquet sink, ``trigger(availableNow)``;
  the checkpoint is the watermark: a rerun reads only files not seen before.
* ``upsert_stream``     file source -> ``foreachBatch`` keyed upsert into a
  bucketed target: each batch rewrites only the buckets it touches.  A delta
  row replaces a stored row only when its order value is not older, so a
  replayed batch leaves the same table and the result does not depend on
  how files are split into micro-batches.
* ``classify_stream``   the log-line classifier on a stream (append mode).
* ``status_count_stream`` streaming ``groupBy(status).count()`` in complete
  mode, each batch's full result written as a new target version.

Checkpoints live under the shared checkpoint folder so a restarted driver or
lost executor resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.sinks import upsert_bucketed
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.plans.progress import classify_lines


def file_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None,
                max_bytes: int | None = None) -> DataFrame:
    """A stream of a folder's files; a micro-batch takes at most so many files, or so many bytes of them."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(path)


def run_available(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def incremental_load(spark: SparkSession, src: str, schema: StructType, sink: str, checkpoint: str) -> None:
    run_available(file_stream(spark, src, schema).writeStream.format("parquet")
                  .option("checkpointLocation", checkpoint).option("path", sink).outputMode("append"))


def upsert_stream(spark: SparkSession, src: str, schema: StructType, target: BucketedTable,
                  keys: list[str], order: str, checkpoint: str, max_files: int | None = None,
                  max_bytes: int | None = None) -> None:
    """Each micro-batch: last row per key, then an order-guarded upsert that
    rewrites only the target buckets the batch touches.  A replayed batch
    re-applies the same rows and leaves the same table."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_bucketed(target, batch, keys, order=[order], guard_order=order)
        target.vacuum()

    run_available(file_stream(spark, src, schema, max_files, max_bytes).writeStream.foreachBatch(apply)
                  .option("checkpointLocation", checkpoint))


def classify_stream(spark: SparkSession, src: str, schema: StructType, sink: str, checkpoint: str) -> None:
    run_available(classify_lines(file_stream(spark, src, schema)).writeStream.format("parquet")
                  .option("checkpointLocation", checkpoint).option("path", sink).outputMode("append"))


def status_count_stream(spark: SparkSession, src: str, schema: StructType, target: VersionedTable,
                        checkpoint: str, max_files: int | None = None, max_bytes: int | None = None) -> None:
    counts = file_stream(spark, src, schema, max_files, max_bytes).groupBy("status").agg(F.count(F.lit(1)).alias("tasks"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        target.commit(batch, version=batch_id + 1)

    run_available(counts.writeStream.outputMode("complete").foreachBatch(publish)
                  .option("checkpointLocation", checkpoint))
