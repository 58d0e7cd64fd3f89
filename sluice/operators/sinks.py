"""Target writes: full refresh, append, keyed upsert, insert with defaults,
truncate, DDL, clustered layout and positional binding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.layout import z_order
from sluice.operators.naming import obs_name as _obs_name, observed_values
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.operators.upsert import latest_per_key, materialize, merge_columns, merge_replace, merge_replace_ordered, \
    spelled_as_stored

_PLACE = "__place"


def positional_bind(df: DataFrame, target: StructType) -> DataFrame:
    """Bind source columns to target columns by position (arity checked), cast to target types."""
    if len(df.columns) != len(target.fields):
        raise ValueError(f"arity mismatch: source has {len(df.columns)} columns, target {len(target.fields)}")
    return df.toDF(*target.fieldNames()).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def full_refresh(table: VersionedTable, df: DataFrame, on_empty: str = "keep") -> int | None:
    """Replace the target.  An empty source keeps the old rows (``on_empty="keep"``)
    and returns None, as the reference returns before its TRUNCATE."""
    n = table.commit(df, skip_empty=on_empty == "keep")
    return None if on_empty == "keep" and n == 0 else n


def append(table: VersionedTable, df: DataFrame, run: str = "") -> int:
    """Add rows as a folder of their own; a retry of ``run`` replaces what its earlier attempt added."""
    return table.append(df, run)


def upsert(table: VersionedTable, delta: DataFrame, keys: list[str], order: list[str] | None = None,
           update_cols: list[str] | None = None, defaults: dict[str, Column] | None = None,
           version: int | None = None, base_version: int | None = None, collation: str | None = None) -> int:
    """Keyed upsert of ``delta`` into ``table`` as a new version; the last row per key by ``order`` wins (by the
    whole row where no order is given).  Columns that the target lacks are dropped after that.  With ``collation``
    keys are equal that it takes for equal, and a stored key keeps its spelling."""
    if collation:
        empty = table.current_version() == 0 and table.schema is None
        delta = spelled_as_stored(delta, keys, order or [], None if empty else table.read(base_version), collation)
    else:
        delta = latest_per_key(delta, keys, order or [])
    # The merge reads the delta more than once (size check, keys, rows): a
    # reliable checkpoint in the shared folder computes it once.
    delta = delta.checkpoint(eager=True)
    if version is None and delta.isEmpty():
        return 0  # nothing to change: the current version stays
    if table.current_version() == 0 and table.schema is None:
        return table.commit(delta.drop(*[c for c in order or [] if c.startswith("__")]), version=version)
    target = table.read(base_version)
    delta = delta.drop(*[c for c in delta.columns if c not in target.columns])
    if update_cols is None:
        merged = merge_replace(target, delta, keys)
    else:
        merged = merge_columns(target, delta, keys, update_cols, defaults)
    return table.commit(merged, version=version)


def write_clustered(table: VersionedTable, df: DataFrame, cluster_by: list[str],
                    partition_by: list[str] | None = None, files: int | None = None) -> int:
    """The reference adds secondary indexes after a summary build; on files the
    equivalent is layout: rows are range-partitioned by the index column, or by
    a space-filling curve through several of them, so each file covers a narrow
    min/max range of every one and parquet statistics prune filtered reads.  A
    hash of the row ends the range key, so a value that many rows share is split
    too.  The rows are computed once, though they are read more often.  Without
    ``files`` AQE sizes the output."""
    df = materialize(df)
    place = F.col(cluster_by[0]) if len(cluster_by) == 1 else z_order(df, cluster_by)
    laid = (df.withColumn(_PLACE, place).repartitionByRange(*[files] * bool(files), _PLACE, F.xxhash64(*df.columns))
            .sortWithinPartitions(_PLACE, *cluster_by))
    return table.commit(laid.drop(_PLACE), partition_by=partition_by)


# --- catalog tables: typed DDL with column defaults ---------------------------

def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Idempotent; with a location, its managed tables live in that (shared) folder."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db){loc}", args={"db": name})


def create_table(spark: SparkSession, name: str, columns_ddl: str, location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` (idempotent); defaults live in the DDL.
    Without a location the table is managed (TRUNCATE is allowed only there)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({columns_ddl}) USING parquet{loc}", args={"t": name})


def insert_columns(spark: SparkSession, name: str, df: DataFrame, columns: list[str] | None = None) -> int:
    """``INSERT INTO t (cols) SELECT …``; unnamed columns take their DEFAULT.  Returns rows inserted."""
    obs = Observation(_obs_name(f"insert_{name.replace('.', '_')}"))
    src = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    cols = f" ({', '.join(columns)})" if columns else ""
    spark.sql(f"INSERT INTO IDENTIFIER(:t){cols} SELECT * FROM {{src}}", args={"t": name}, src=src)
    return int(observed_values(obs).get("rows", 0))


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql("TRUNCATE TABLE IDENTIFIER(:t)", args={"t": name})


def range_bucket(column: str, width: int):
    """Bucket = key div width: neighbouring keys share a partition, so deltas of
    recent keys touch only the newest buckets."""
    return lambda df: F.floor(F.col(column) / F.lit(width)).cast("bigint")


def hash_bucket(columns: list[str], buckets: int):
    """Bucket = pmod(xxhash64(key), n): spreads keys evenly when they have no
    useful order (a delta then touches about min(n, |delta|) buckets)."""
    return lambda df: F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(buckets)).cast("bigint")


def upsert_bucketed(table: BucketedTable, delta: DataFrame, keys: list[str], order: list[str] | None = None,
                    update_cols: list[str] | None = None, defaults: dict[str, Column] | None = None,
                    guard_order: str | None = None, collation: str | None = None) -> int:
    """Keyed upsert that rewrites only the buckets the delta touches.

    With ``collation`` keys are equal that it takes for equal; as a key's bucket
    depends on its spelling, the key columns of all buckets are read then, and
    still only the touched buckets are rewritten.

    With ``guard_order`` a delta row replaces a stored row only when its
    value in that column is not older, which makes re-applying a delta (a
    replayed stream batch, a retried job) converge to the same table.  A
    missing table is created from the delta (which then carries every column).
    """
    if collation:
        stored = table.read() if table.exists() else None
        latest = spelled_as_stored(delta, keys, order or [], stored, collation)
    else:
        latest = latest_per_key(delta, keys, order or [])
    delta = table.with_bucket(latest).checkpoint(eager=True)
    if delta.isEmpty():
        return 0  # neither a version nor, the first time, a table without rows
    if not table.exists():
        return table.refresh(delta.drop(*[c for c in order or [] if c.startswith("__")]))
    touched = delta.select(table.BUCKET).distinct()
    current = table.read(touched)
    delta = delta.drop(*[c for c in delta.columns if c not in current.columns])
    bkeys = keys + [table.BUCKET]
    if guard_order:
        merged = merge_replace_ordered(current, delta, bkeys, guard_order)
    elif update_cols is None:
        merged = merge_replace(current, delta, bkeys)
    else:
        merged = merge_columns(current, delta, bkeys, update_cols, defaults)
    return table.replace(merged, touched)
