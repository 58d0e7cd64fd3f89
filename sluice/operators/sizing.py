"""Broadcast only behind a size check; otherwise leave the join to a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on the optimizer's size estimate (compressed file bytes) for a
# hinted broadcast side; in memory a side can be a few times larger.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
# Bounds on what a counted side may have: rows, and bytes of its rows as JSON text.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_TEXT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate (from file sizes) of the optimized plan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    size = stats.sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast when the plan's size estimate is under ``max_bytes``.

    Above it the plain DataFrame is returned and Spark shuffles (sort-merge
    join); AQE may still switch to a broadcast at runtime from real sizes.
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_TEXT_BYTES) -> bool:
    """Count the rows of a side that is already computed, and their bytes: a row a task reaches the driver."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return rows <= max_rows and (size or 0) <= max_bytes
