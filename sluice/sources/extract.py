"""Extract: full, incremental past a watermark, or with an author-placed parameter.

The reference appends ``WHERE f > %s`` to the SQL text; here the predicate is
a DataFrame filter, so Catalyst pushes it into the parquet/JDBC scan and it
also works when the source query already has WHERE or GROUP BY.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.exprs import ntz


def watermark_literal(value) -> Column:
    """Watermark as a literal: a date is bound at day precision (midnight)."""
    if isinstance(value, (dt.date, dt.datetime)):
        return ntz(value)
    return F.lit(value)


def extract(source: DataFrame, incremental: bool = False, incremental_field: str | None = None,
            last_updated=None) -> DataFrame:
    """Rows of ``source``; strictly past ``last_updated`` only when all three are set.

    Strict ``>`` like the reference: rows exactly at the bound are excluded.
    """
    if incremental and incremental_field and last_updated is not None:
        bound = watermark_literal(last_updated)
        if isinstance(last_updated, str):  # the stored text of a value of another type
            bound = bound.cast(source.schema[incremental_field].dataType)
        return source.where(F.col(incremental_field) > bound)
    return source


def extract_parameterized(spark: SparkSession, sql: str, last_updated, **views: DataFrame) -> DataFrame:
    """Author SQL with a ``:last_updated`` marker, bound as a typed parameter.

    ``views`` are DataFrames referenced as ``{name}`` in the text.
    """
    # Bound as a typed timestamp_ntz literal (a Python datetime would bind as
    # a session-time-zone timestamp).
    bound = watermark_literal(last_updated)
    return spark.sql(sql, args={"last_updated": bound}, **views)
