"""Versioned parquet tables on the shared filesystem.

Spark cannot overwrite a path it is reading, and a truncate followed by an
insert is not atomic.  A target is therefore a folder of numbered versions;
a write goes to ``v{n+1}`` through Spark's commit protocol (task retries and
lost executors are handled there) and only then is a marker file
``_committed_v{n+1}`` created.  Readers take the highest committed version, so
a failed or half-written version is never visible.

A version that was appended has the older folders too: its marker lists them,
each with the run that wrote it.  A run that failed after its rows were
committed, and is tried again, replaces the folder of its own earlier attempt.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.operators.naming import obs_name as _obs_name, observed_values

_MARK = re.compile(r"^_committed_v(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    def version_path(self, v: int) -> str:
        return f"{self.root}/v{v:08d}"

    def current_version(self) -> int:
        versions = [int(m.group(1)) for m in map(_MARK.match, list_names(self.spark, self.root)) if m]
        return max(versions, default=0)

    def segments(self, v: int) -> list[tuple[int, str]]:
        """(folder's number, run that wrote it) of the folders that make up a committed version."""
        if v == 0:
            return []
        lines = read_text(self.spark, f"{self.root}/_committed_v{v:08d}").splitlines()
        return [(int(n), run) for n, run in (line.split(" ", 1) for line in lines)] or [(v, "")]

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v == 0:
            if self.schema is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.parquet(*[self.version_path(n) for n, _ in self.segments(v)])
        if self.schema is None:
            self.schema = df.schema
        return df

    def vacuum(self, retain: int = 10) -> list[int]:
        """Delete all but the newest ``retain`` committed versions (and any
        uncommitted leftovers older than them); returns the versions removed."""
        names = list_names(self.spark, self.root)
        committed = sorted(int(m.group(1)) for m in map(_MARK.match, names) if m)
        if len(committed) <= retain:
            return []
        floor = committed[-retain]
        used = {n for v in committed[-retain:] for n, _ in self.segments(v)}
        gone = []
        for n in names:
            m = re.match(r"^v(\d+)$", n)
            if m and int(m.group(1)) < floor and int(m.group(1)) not in used:
                delete_path(self.spark, f"{self.root}/{n}")
                gone.append(int(m.group(1)))
        for v in committed[:-retain]:
            delete_path(self.spark, f"{self.root}/_committed_v{v:08d}")
        return sorted(gone)

    def commit(self, df: DataFrame, version: int | None = None,
               partition_by: list[str] | None = None, skip_empty: bool = False) -> int:
        """Write ``df`` as a new version and make it current; return rows written.

        The row count comes from an ``Observation`` on the same write, so the
        data is not scanned twice.  ``version`` may be fixed by the caller
        (stream batches use ``batch_id + 1``) so a replayed write lands on the
        same folder and gives the same result.  With ``skip_empty`` a write of
        no rows is not committed: the current version stays.
        """
        v = self.current_version() + 1 if version is None else version
        obs = Observation(_obs_name(f"rows_v{v}"))
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(v))
        rows = int(observed_values(obs).get("rows", 0))
        if rows or not skip_empty:
            write_text(self.spark, f"{self.root}/_committed_v{v:08d}")
            self.schema = df.schema
        return rows

    def append(self, df: DataFrame, run: str = "") -> int:
        """Add the rows of ``df`` as a new folder of the next version; return rows written, and commit nothing
        where there are none.

        ``run`` names who appends (no line breaks): what the same run appended before and did not finish is
        replaced.  Without a name rows are always added.
        """
        current = self.current_version()
        kept = [(n, r) for n, r in self.segments(current) if not run or r != run]
        rows = df.select(*self.read(current).columns) if current else df
        v = current + 1
        obs = Observation(_obs_name(f"append_v{v}"))
        rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(self.version_path(v))
        n = int(observed_values(obs).get("rows", 0))
        if n or len(kept) < len(self.segments(current)):
            write_text(self.spark, f"{self.root}/_committed_v{v:08d}", "\n".join(f"{k} {r}" for k, r in [*kept, (v, run)]))
            self.schema = self.schema or df.schema
        return n


class BucketedTable:
    """A large keyed target partitioned by a bucket derived from its key.

    ``bucket_of`` maps the key columns to a partition value (a range such as
    ``key div width`` keeps recent keys together; a hash spreads them); a key of
    NULL is in bucket -1.  Every write goes to a folder of its own, a
    generation; a small versioned manifest says which generations hold a
    bucket's rows.  An upsert reads and writes the buckets that its delta
    touches and switches to them by committing a manifest, so a write that fails
    before that changes nothing and can be repeated.  The driver handles the
    manifest, a row a bucket, as it does the file listing: choose widths for
    thousands of buckets, not millions.
    """

    BUCKET = "bucket"

    def __init__(self, spark: SparkSession, root: str, bucket_of):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_of = bucket_of  # fn(DataFrame) -> Column
        self.manifest = VersionedTable(spark, f"{self.root}/manifest", StructType(
            [StructField(self.BUCKET, LongType()), StructField("generation", LongType()), StructField("run", StringType())]))

    def exists(self) -> bool:
        return self.manifest.current_version() > 0

    def _folder(self, generation: int) -> str:
        return f"{self.root}/data/generation={generation}"

    def read(self, touched: DataFrame | None = None) -> DataFrame:
        """The table, or only the buckets that ``touched`` (bucket) names; other folders are not listed."""
        live = self.manifest.read()
        some = live if touched is None else live.join(touched, self.BUCKET, "left_semi")
        paths = [f"{self._folder(r.generation)}/{self.BUCKET}={r[self.BUCKET]}" for r in some.collect()]
        base = self.spark.read.option("basePath", f"{self.root}/data")
        if paths:
            rows = base.parquet(*paths)
        else:
            first = live.first()
            if first is None:
                raise FileNotFoundError(f"no rows under {self.root}")
            rows = base.parquet(f"{self._folder(first[1])}/{self.BUCKET}={first[0]}").where(F.lit(False))
        return rows.drop("generation").withColumn(self.BUCKET, F.col(self.BUCKET).cast("bigint"))

    def with_bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.BUCKET, F.coalesce(self.bucket_of(df).cast("bigint"), F.lit(-1)))

    def _write(self, df: DataFrame, kept: DataFrame | None, skip_empty: bool = False, run: str = "") -> int:
        generation = self.manifest.current_version() + 1
        obs = Observation(_obs_name("bucket_rows"))
        # A bucket's rows go to few files; adaptive execution splits a large bucket and joins small ones.
        laid = df.hint("rebalance", self.BUCKET).observe(obs, F.count(F.lit(1)).alias("rows"))
        laid.write.mode("overwrite").partitionBy(self.BUCKET).parquet(self._folder(generation))
        rows = int(observed_values(obs).get("rows", 0))
        if not rows and skip_empty:
            return 0
        names = [n for n in list_names(self.spark, self._folder(generation)) if n.startswith(f"{self.BUCKET}=")]
        pairs = self.spark.createDataFrame([(int(n.split("=")[1]), generation, run) for n in names], self.manifest.schema)
        self.manifest.commit(pairs if kept is None else kept.unionByName(pairs), version=generation)
        return rows

    def refresh(self, df: DataFrame, skip_empty: bool = False, run: str = "") -> int:
        """Replace the whole table; buckets that ``df`` (with its bucket column) lacks are gone."""
        return self._write(df, None, skip_empty, run)

    def append(self, df: DataFrame, run: str = "") -> int:
        """Add rows; what the same ``run`` added before and did not finish is replaced."""
        live = self.manifest.read()
        return self._write(df, live.where(F.coalesce("run", F.lit("")) != run) if run else live, skip_empty=not run, run=run)

    def replace(self, df: DataFrame, touched: DataFrame) -> int:
        """Replace the buckets that ``touched`` names by the rows of ``df``."""
        return self._write(df, self.manifest.read().join(touched, self.BUCKET, "left_anti"))

    def vacuum(self, retain: int = 2) -> list[int]:
        """Delete generations that none of the newest ``retain`` manifests names; returns them."""
        current = self.manifest.current_version()
        used: set[int] = set()
        for v in range(max(1, current - retain + 1), current + 1):
            used |= {r[0] for r in self.manifest.read(v).select("generation").distinct().collect()}
        self.manifest.vacuum(retain)
        gone = [g for n in list_names(self.spark, f"{self.root}/data")
                if (g := int(n.split("=")[1])) <= current and g not in used]
        for g in gone:
            delete_path(self.spark, self._folder(g))
        return sorted(gone)
