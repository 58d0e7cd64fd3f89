"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Rows that are read, and go to a Python worker, at once.  A batch is held several times on its way, by the JVM on and
#: off its heap and by the worker, so Spark's 10 000 whole texts are hundreds of MB a task.
BATCH_ROWS = 512
#: Bytes of a row group of the tables written between steps: a task holds one while it writes, and a column of one
#: while it reads, on and off the heap.
ROW_GROUP = 8 << 20
#: Rows to a Python worker, and from a Parquet file, at once.
_BATCHES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back:
    cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{label}")
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_ROWS rows from now on, where the session has larger ones (or, below 1, no bound)."""
    for key in _BATCHES:
        if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
            spark.conf.set(key, BATCH_ROWS)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(values: Iterable, size: int = 1 << 19) -> Iterator[list[str]]:
    """Texts (or Arrow's scalars of them) in order, in lists of about ``size`` characters."""
    own, total = [], 0
    for value in values:
        if not (value is None or isinstance(value, str)):
            value = value.as_py()
        own.append(value or "")
        total += len(own[-1])
        if total >= size:
            yield own
            own, total = [], 0
    if own:
        yield own


def give_back() -> None:
    """What Arrow and the C library hold of freed memory goes back to the system; without glibc, Arrow's alone."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_KEPT: dict[str, Any] = {}


def kept_in_worker(owner: str, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a Python worker from task to task.  Workers outlive a stage: what another operator
    kept is let go, so that the stages of one job do not add up."""
    if owner not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]
