"""ETL state tables: load metadata, watermarks, completion rows.

Each is a small keyed table updated with ``merge_columns`` (partial-column
upsert with insert-time defaults).  Timestamps are ``timestamp_ntz`` and
``now`` is a parameter so runs are reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from sluice.functions.exprs import ntz
from sluice.operators.upsert import merge_columns

META_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("last_update_timestamp", TimestampNTZType()),
    StructField("record_count", LongType()),
    StructField("status", StringType()),
    StructField("error_message", StringType()),
    StructField("created_at", TimestampNTZType()),
    StructField("updated_at", TimestampNTZType()),
])

WATERMARK_SCHEMA = StructType([
    StructField("source_table", StringType(), False),
    StructField("target_table", StringType(), False),
    StructField("incremental_field", StringType()),
    StructField("last_processed_value", StringType()),
    StructField("last_processed_timestamp", TimestampNTZType()),
    StructField("batch_size", IntegerType()),
    StructField("is_active", BooleanType()),
    StructField("created_at", TimestampNTZType()),
    StructField("updated_at", TimestampNTZType()),
])

HISTORY_SCHEMA = StructType([
    StructField("id", LongType()),
    StructField("action", StringType()),
    StructField("pipeline_type", StringType()),
    StructField("start_time", TimestampNTZType()),
    StructField("end_time", TimestampNTZType()),
    StructField("duration_seconds", DecimalType(10, 2)),
    StructField("success", BooleanType()),
    StructField("status", StringType()),
    StructField("result", StringType()),
    StructField("created_at", TimestampNTZType()),
])

# DDL of the state tables for the schema job (column defaults included).
META_DDL = ("table_name VARCHAR(100) NOT NULL, last_update_timestamp TIMESTAMP_NTZ, record_count BIGINT DEFAULT 0, "
            "status VARCHAR(50) DEFAULT 'pending', error_message STRING, "
            "created_at TIMESTAMP_NTZ DEFAULT current_timestamp()::timestamp_ntz, "
            "updated_at TIMESTAMP_NTZ DEFAULT current_timestamp()::timestamp_ntz")
WATERMARK_DDL = ("source_table VARCHAR(100) NOT NULL, target_table VARCHAR(100) NOT NULL, "
                 "incremental_field VARCHAR(100) DEFAULT 'id', last_processed_value VARCHAR(255), "
                 "last_processed_timestamp TIMESTAMP_NTZ, batch_size INT DEFAULT 1000, is_active BOOLEAN DEFAULT true, "
                 "created_at TIMESTAMP_NTZ DEFAULT current_timestamp()::timestamp_ntz, "
                 "updated_at TIMESTAMP_NTZ DEFAULT current_timestamp()::timestamp_ntz")
HISTORY_DDL = ("id BIGINT, action VARCHAR(50) NOT NULL, pipeline_type VARCHAR(100) NOT NULL, "
               "start_time TIMESTAMP_NTZ NOT NULL, end_time TIMESTAMP_NTZ, duration_seconds DECIMAL(10,2), "
               "success BOOLEAN, status VARCHAR(20) NOT NULL DEFAULT 'completed', result STRING, "
               "created_at TIMESTAMP_NTZ DEFAULT current_timestamp()::timestamp_ntz")


def _ts(now: dt.datetime):
    return ntz(now)


def task_status_upsert(meta: DataFrame, updates: DataFrame, now: dt.datetime,
                       delta_small: bool | None = None) -> DataFrame:
    """Set status/error_message/last_update_timestamp/updated_at per task; keep record_count.

    ``updates``: (table_name, status, error_message), unique per table_name.
    """
    d = updates.select("table_name", "status", "error_message",
                       _ts(now).alias("last_update_timestamp"), _ts(now).alias("updated_at"))
    return merge_columns(meta, d, ["table_name"],
                         ["status", "error_message", "last_update_timestamp", "updated_at"],
                         defaults={"record_count": F.lit(0), "created_at": _ts(now)}, delta_small=delta_small)


def load_metadata_upsert(meta: DataFrame, counts: DataFrame, now: dt.datetime,
                         delta_small: bool | None = None) -> DataFrame:
    """Loaded-row count per target: sets record_count, status='completed', updated_at;
    leaves error_message and last_update_timestamp as they are."""
    d = counts.select("table_name", F.col("record_count").cast("bigint").alias("record_count"),
                      F.lit("completed").alias("status"), _ts(now).alias("updated_at"))
    return merge_columns(meta, d, ["table_name"], ["record_count", "status", "updated_at"],
                         defaults={"created_at": _ts(now)}, delta_small=delta_small)


def watermark_advance(wm: DataFrame, loaded: DataFrame, now: dt.datetime,
                      delta_small: bool | None = None) -> DataFrame:
    """Advance (source_table, target_table) to the max loaded value; unchanged if nothing loaded.

    ``loaded``: (source_table, target_table, incremental_field, max_value), one row per pair; rows with a NULL
    max (no rows loaded) are ignored.  The value is stored as text, whatever its type, and as a timestamp too where
    it is one (``max_timestamp``, or ``max_value`` itself).
    """
    stamp = F.lit(None).cast("timestamp_ntz")
    if "max_timestamp" in loaded.columns:
        stamp = F.col("max_timestamp")
    elif loaded.schema["max_value"].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
        stamp = F.col("max_value").cast("timestamp_ntz")
    d = (loaded.where(F.col("max_value").isNotNull())
         .select("source_table", "target_table", "incremental_field",
                 F.col("max_value").cast("string").alias("last_processed_value"),
                 stamp.alias("last_processed_timestamp"),
                 _ts(now).alias("updated_at")))
    return merge_columns(wm, d, ["source_table", "target_table"],
                         ["last_processed_value", "last_processed_timestamp", "updated_at"],
                         defaults={"batch_size": F.lit(1000), "is_active": F.lit(True), "created_at": _ts(now)},
                         delta_small=delta_small)
