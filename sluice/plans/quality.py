"""Input checks: JSON validity split, case/accent-insensitive grouping, path tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.sizing import broadcast_if_small

COLLATION = "UNICODE_CI_AI"  # the reference database's utf8mb4_unicode_ci behaviour


def json_validity(bodies: DataFrame, col: str = "body") -> DataFrame:
    """Flag each body as valid JSON (``try_parse_json`` is NULL on a parse error)."""
    return bodies.select("id", F.expr(f"try_parse_json({col})").isNotNull().alias("valid"))


def quarantine_split(bodies: DataFrame, col: str = "body") -> tuple[DataFrame, DataFrame]:
    flagged = bodies.withColumn("__valid", F.expr(f"try_parse_json({col})").isNotNull())
    return (flagged.where("__valid").drop("__valid"), flagged.where("NOT __valid").drop("__valid"))


def collated_counts(df: DataFrame, col: str) -> DataFrame:
    """Group case- and accent-insensitively; label = smallest lower-cased spelling."""
    key = F.collate(F.col(col), COLLATION)
    return (df.groupBy(key.alias("__k"))
            .agg(F.min(F.lower(F.col(col))).alias("label"), F.count(F.lit(1)).alias("n"))
            .select("label", "n"))


def path_tree(paths: DataFrame, col: str = "url", suffix: str = "") -> DataFrame:
    """Paths ending with ``suffix`` with their folder (``root`` when none) and
    the folder's file count.  Rows stay rows: no per-folder list is collected
    into one task; the per-folder counts come from a partial aggregate joined
    back (broadcast when the plan estimate is small, else a shuffle join with
    AQE splitting a hot folder)."""
    p = paths.where(F.col(col).endswith(suffix)) if suffix else paths
    folder = F.regexp_extract(F.col(col), r"^(.*)/[^/]*$", 1)
    rows = p.select(F.when(folder == "", "root").otherwise(folder).alias("folder"), F.col(col).alias("path"))
    counts = rows.groupBy("folder").agg(F.count(F.lit(1)).alias("folder_files"))
    return rows.join(broadcast_if_small(counts), "folder")
