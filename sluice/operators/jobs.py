"""Job runner: the task types of a JSON job catalogue as Spark functions.

A job spec is a plain dict (parsed from JSON).  Types:

* ``schema``       one DDL statement (``IDENTIFIER(:database_name)`` is bound)
* ``extract_load`` author SQL -> full / incremental extract -> overwrite,
                   keyed upsert (``merge_key``) or append -> metadata, watermark
* ``load``         JSON file -> same write path
* ``procedure``    installs a named transform (SQL table function, or a
                   ``BEGIN … END`` script kept for ``flattened`` jobs)
* ``flattened``    runs a transform and overwrites its target
* ``summary``      a JSON *list* of statements run in order (the last one
                   yields the rows), then written with the index columns as
                   the file layout

Mode (``full`` / ``incremental``) and the watermark are passed to every job
of a run.  The driver only handles specs, counts and watermark values.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import threading
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from sluice.operators.naming import obs_name as _obs_name, observed_values
from sluice.operators import metadata as md
from sluice.operators.sinks import (append, hash_bucket, positional_bind, range_bucket, upsert, upsert_bucketed,
                                    write_clustered)
from sluice.operators.storage import BucketedTable, VersionedTable, path_exists, read_text, write_text
from sluice.operators.batches import batch_bounds, bound_value
from sluice.functions import exprs as X
from sluice.plans.history import apply_status_updates, log_executions
from sluice.sources.extract import extract, watermark_literal
from sluice.sources.json_files import POSITION, read_json_positional, read_json_records

RUNS_SCHEMA = StructType([
    StructField("job", StringType(), False),
    StructField("mode", StringType(), False),
    StructField("watermark", TimestampNTZType()),
    StructField("rows", LongType()),
    StructField("status", StringType()),
    # The watermark that the run reached: written with its completion, in one commit.
    StructField("source_table", StringType()),
    StructField("target_table", StringType()),
    StructField("incremental_field", StringType()),
    StructField("max_value", StringType()),
    StructField("max_timestamp", TimestampNTZType()),
    StructField("serial", LongType()),
])


MARKS_DDL = ("source_table string, target_table string, incremental_field string, max_value string, "
             "max_timestamp timestamp_ntz")


def _midnight(day: dt.date) -> dt.datetime:
    return day if isinstance(day, dt.datetime) else dt.datetime(day.year, day.month, day.day)


@dataclass
class JobResult:
    job: str
    status: str
    rows: int | None = None
    max_value: object = None
    notes: list[str] = field(default_factory=list)


class Workspace:
    """Targets and state tables of one catalogue under a shared folder."""

    def __init__(self, spark: SparkSession, root: str, now: dt.datetime,
                 sources: dict[str, DataFrame] | None = None, database: str = "analytics"):
        self.spark, self.root, self.now, self.database = spark, root.rstrip("/"), now, database
        for name, df in (sources or {}).items():
            df.createOrReplaceTempView(name)
        self.meta = VersionedTable(spark, f"{self.root}/state/etl_metadata", md.META_SCHEMA)
        self.watermarks = VersionedTable(spark, f"{self.root}/state/etl_watermarks", md.WATERMARK_SCHEMA)
        self.runs = VersionedTable(spark, f"{self.root}/state/job_runs", RUNS_SCHEMA)
        self.history = VersionedTable(spark, f"{self.root}/state/pipeline_history", md.HISTORY_SCHEMA)
        self.transforms: dict[str, str] = {}
        # State-table commits pick the next version number: serialise them
        # when jobs of one level run on several threads.
        self._state_lock = threading.RLock()
        self._pending: dict[str, list] | None = None

    @contextlib.contextmanager
    def batched_state(self):
        """Collect load counts, watermark advances and completion rows of the
        jobs run inside, and write each state table once on exit (also when a
        job fails, so finished jobs stay recorded)."""
        with self._state_lock:
            self._pending = {"loads": [], "done": []}
        try:
            yield self
        finally:
            with self._state_lock:
                pending, self._pending = self._pending, None
            self._flush(pending)

    def _flush(self, pending: dict[str, list]) -> None:
        def last_by(rows, key):
            return list({key(r): r for r in rows}.values())

        with self._state_lock:
            if pending["loads"]:
                counts = self.spark.createDataFrame(last_by(pending["loads"], lambda r: r[0]),
                                                    "table_name string, record_count bigint")
                self.meta.commit(md.load_metadata_upsert(self.meta.read(), counts, self.now, delta_small=True))
            if pending["done"]:
                self._complete(pending["done"])

    def _complete(self, done: list[tuple]) -> None:
        """Completion rows, each with the watermark that its run reached, become visible by one commit; the watermark
        table follows, and ``catch_up`` brings it up to date if that fails."""
        self.runs.append(self.spark.createDataFrame(done, RUNS_SCHEMA))
        self._advance({(d[5], d[6]): d[5:10] for d in done if d[8] is not None}, max(d[10] for d in done))

    def _advance(self, marks: dict, serial: int) -> None:
        if marks:
            loaded = self.spark.createDataFrame(list(marks.values()), MARKS_DDL)
            self.watermarks.commit(md.watermark_advance(self.watermarks.read(), loaded, self.now, delta_small=True))
        write_text(self.spark, f"{self.root}/state/marked", str(serial))

    def catch_up(self) -> None:
        """Write the watermarks of completed runs whose completion was the last thing that was written: a row a
        source and target.  Others, and what was set by hand since, stay."""
        path = f"{self.root}/state/marked"
        with self._state_lock:
            if self._pending is not None and self._pending["done"]:
                return
            marked = int(read_text(self.spark, path)) if path_exists(self.spark, path) else 0
            late = self.runs.read().where(F.col("serial") > marked)
            names = ["source_table", "target_table", "incremental_field", "max_value", "max_timestamp"]
            last = (late.where(F.col("max_value").isNotNull()).groupBy(*names[:2])
                    .agg(F.max_by(F.struct(*names), "serial").alias("m")).select("m.*").collect())
            if last:
                self._advance({(r[0], r[1]): tuple(r) for r in last}, late.agg(F.max("serial")).first()[0])

    def serial(self) -> int:
        """Number of the next completion row: what is not completed yet has this number again when it is retried."""
        with self._state_lock:
            last = self.runs.read().agg(F.max("serial")).first()[0] or 0
            return last + 1 + (len(self._pending["done"]) if self._pending is not None else 0)

    def attempt(self, job: str) -> str:
        """The identity of a run: the job and how often it was completed before.  A run that failed, at any point, has
        the same one when it is tried again."""
        with self._state_lock:
            done = self.runs.read().where(F.col("job") == job).count()
            return f"{job}#{done + sum(d[0] == job for d in (self._pending or {}).get('done', []))}"

    def target(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/targets/{name}")

    def read_target(self, spec: dict) -> DataFrame:
        if spec.get("bucket_by"):
            t = BucketedTable(self.spark, self.target(spec["target_table"]).root, _bucket_of(spec))
            return t.read().drop(t.BUCKET)
        return self.target(spec["target_table"]).read()

    # -- state-table updates (one small keyed merge each) --------------------
    def record_load(self, table: str, rows: int) -> None:
        with self._state_lock:
            if self._pending is not None:
                self._pending["loads"].append((table, rows))
                return
        counts = self.spark.createDataFrame([(table, rows)], "table_name string, record_count bigint")
        with self._state_lock:
            # A one-row local delta: its size is known, no check job needed.
            self.meta.commit(md.load_metadata_upsert(self.meta.read(), counts, self.now, delta_small=True))

    def record_status(self, table: str, status: str, error: str | None = None) -> None:
        upd = self.spark.createDataFrame([(table, status, error)],
                                         "table_name string, status string, error_message string")
        with self._state_lock:
            self.meta.commit(md.task_status_upsert(self.meta.read(), upd, self.now, delta_small=True))

    def stored_watermark(self, source: str, target: str):
        """The stored time, or the stored text of a value of another type."""
        row = (self.watermarks.read()
               .where((F.col("source_table") == source) & (F.col("target_table") == target)
                      & F.col("is_active"))
               .select("last_processed_timestamp", "last_processed_value").limit(1).collect())
        if not row:
            return None
        stamp, text = row[0]
        # A point in time is read back as such, whatever the session's zone is.
        return text if stamp is None or (text or "").endswith("Z") else stamp

    def recovered(self, jobs: list[str]) -> None:
        """Jobs that succeeded now are no longer recorded as failed."""
        meta = self.meta.read()
        failed = meta.where(F.col("table_name").isin(jobs) & (F.col("status") == "failed")).select("table_name").collect()
        for (name,) in failed:
            self.record_status(name, "completed")

    # -- run history: a row when a run begins, updated when it ends ------------
    def begin_run(self, mode: str) -> int:
        past = self.history.read()
        run = (past.agg(F.max("id")).first()[0] or 0) + 1
        action = "full_refresh" if mode == "full" else "incremental"
        row = self.spark.createDataFrame([(run, action, time.time(), None, None, None, "running")],
                                         "id long, action string, start_epoch double, end_epoch double, "
                                         "success boolean, result string, status string")
        self.history.commit(past.unionByName(log_executions(row)))
        return run

    def end_run(self, run: int, results: list[JobResult]) -> None:
        failed = sum(r.status == "failed" for r in results)
        blocked = sum(r.status == "blocked" for r in results)
        text = X.RESULT_MESSAGE.format(done=len(results) - failed - blocked, failed=failed, pending=blocked, disabled=0)
        status = "failed" if failed else "completed"
        update = self.spark.createDataFrame([(run, status, time.time(), not failed, text)],
                                            "id long, status string, end_epoch double, success boolean, result string")
        self.history.commit(apply_status_updates(self.history.read(), update, self.now))

    def mark_done(self, job: str, mode: str, watermark, rows: int | None, reached: tuple | None = None) -> None:
        """``reached``: (source, target, field, value) of the watermark that the run's rows reach, if any."""
        watermark = _midnight(watermark) if isinstance(watermark, dt.date) else None
        mark = (None,) * 5
        if reached:
            source, target, fld, value = reached
            stamp = _midnight(value) if isinstance(value, dt.date) else None
            text = str(value)
            if stamp is not None and stamp.tzinfo is not None:
                stamp = stamp.astimezone(dt.timezone.utc).replace(tzinfo=None)
                text = f"{stamp.isoformat()}Z"
            mark = (source, target, fld, text, stamp)
        with self._state_lock:
            done = (job, mode, watermark, rows, "completed", *mark, self.serial())
            if self._pending is not None:
                self._pending["done"].append(done)
            else:
                self._complete([done])


def _bucket_of(spec: dict):
    b = spec["bucket_by"]
    if b.get("buckets"):
        return hash_bucket([b["column"]], b["buckets"])
    return range_bucket(b["column"], b["width"])


def _max_of(fld: str, rows: DataFrame):
    """The largest value as text, or as microseconds where it is a point in time: neither depends on a zone."""
    c = F.col(fld)
    return F.max(F.unix_micros(c)) if rows.schema[fld].dataType == TimestampType() else F.max(c).cast("string")


def _value(text, kind) -> object:
    """What ``_max_of`` found, as a Python value: dates and times as such, other types as text."""
    if text is None:
        return None
    if kind == TimestampType():
        return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=text)
    if kind == DateType():
        return dt.date.fromisoformat(text)
    return dt.datetime.fromisoformat(text) if kind == TimestampNTZType() else text


def _write(ws: Workspace, name: str, spec: dict, rows: DataFrame, mode: str, refresh: bool = True) -> tuple[int, object]:
    """Shared write path of extract_load and load: returns (rows, max incremental value).

    The source runs once, in the write itself; a write of no rows is not
    committed and changes nothing.  A full run replaces the target where
    ``refresh`` is set; else rows with a merge key are upserted and others
    appended.  Rows may carry their place in the input (``POSITION``).
    """
    fld = spec.get("incremental_field")
    obs = Observation(_obs_name(f"load_{spec['target_table']}"))
    metrics = [F.count(F.lit(1)).alias("rows")]
    if fld:
        metrics.append(_max_of(fld, rows).alias("max_value"))
    observed = rows.observe(obs, *metrics)
    plain = observed.drop(POSITION)
    keys = spec.get("merge_key")
    order = ([fld] if fld else list(spec.get("order_by") or [])) + [POSITION] * (POSITION in rows.columns)
    partial = {"collation": spec.get("key_collation"), "update_cols": spec.get("update_columns"),
               "defaults": {c: F.expr(e) for c, e in (spec.get("defaults") or {}).items()}}
    replace = mode == "full" and refresh
    if spec.get("bucket_by"):
        # Large target: an upsert rewrites only the buckets its delta touches.
        bt = BucketedTable(ws.spark, ws.target(spec["target_table"]).root, _bucket_of(spec))
        if replace:
            bt.refresh(bt.with_bucket(plain), skip_empty=True)
        elif keys:
            upsert_bucketed(bt, observed, keys, order=order, **partial)
        elif bt.exists():
            bt.append(bt.with_bucket(plain), ws.attempt(name))
        else:
            bt.refresh(bt.with_bucket(plain), skip_empty=True, run=ws.attempt(name))
        bt.vacuum()
    else:
        target = ws.target(spec["target_table"])
        if replace:
            target.commit(plain, skip_empty=True)
        elif keys:
            upsert(target, observed, keys, order=order, **partial)
        else:
            append(target, plain, ws.attempt(name))
    got = observed_values(obs)
    return int(got.get("rows", 0)), _value(got.get("max_value"), rows.schema[fld].dataType if fld else None)


def _finish(ws: Workspace, name: str, spec: dict, mode: str, last_updated, n: int, mx) -> JobResult:
    """State of a finished write; nothing but the completion row where there was no data."""
    fld = spec.get("incremental_field")
    if n:
        ws.record_load(spec["target_table"], n)
    reached = (spec.get("source_table", name), spec["target_table"], fld, mx) if n and fld and mx is not None else None
    ws.mark_done(name, mode, last_updated, n, reached)
    return JobResult(name, "completed" if n else "no_data", n, mx)


#: Bound to ``:last_updated`` where no watermark is given or stored: before any row.
FIRST_TIME = dt.datetime(1000, 1, 1)


def run_extract_load(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    """An incremental run without a watermark goes on from the stored one
    (``use_stored_watermark: false`` reads everything again)."""
    if not spec.get("query"):
        raise ValueError(f"No query defined for {name}")
    fld = spec.get("incremental_field")
    incremental = mode == "incremental"
    bound = last_updated
    if incremental and bound is None and fld and spec.get("use_stored_watermark", True):
        ws.catch_up()
        bound = ws.stored_watermark(spec.get("source_table", name), spec["target_table"])
    args = None
    if ":last_updated" in spec["query"]:
        # An author-placed marker: the query filters by itself.
        args = {"last_updated": watermark_literal(FIRST_TIME if bound is None or not incremental else bound)}
    rows = extract(ws.spark.sql(spec["query"], args=args), incremental and args is None, fld, bound)

    def load(some: DataFrame) -> JobResult:
        if spec.get("target_schema"):
            some = positional_bind(some, StructType.fromDDL(spec["target_schema"]))
        n, mx = _write(ws, name, spec, some, mode)
        return _finish(ws, name, spec, mode, last_updated, n, mx)

    if not (incremental and fld and spec.get("batch_size")):
        return load(rows)
    # Each batch is a run of its own, with its completion and watermark: a retry goes on with the first one that is
    # not complete.  Rows without a value are never past a watermark and come with the first batch.
    total, last = 0, None
    kind = rows.schema[fld].dataType
    for b in batch_bounds(rows, fld, spec["batch_size"]).orderBy("batch").toLocalIterator():
        within = F.col(fld).isNull() if b.high is None else F.col(fld).between(bound_value(b.low, kind), bound_value(b.high, kind))
        done = load(rows.where(within))
        total, last = total + done.rows, done
    return JobResult(name, "completed", total, last.max_value) if total else load(rows.where("false"))


def run_load(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    """A load adds to its target in every mode: it upserts by ``merge_key`` (the last row of a key wins) or appends."""
    schema = StructType.fromDDL(spec["file_schema"])
    # Positional rows may be objects, arrays or scalars.
    read = read_json_positional if spec.get("positional") else read_json_records
    keyed = bool(spec.get("merge_key"))
    rows = read(ws.spark, spec["source_file"], schema, lines=bool(spec.get("lines")), position=keyed)
    if rows is None:
        ws.mark_done(name, mode, last_updated, 0)
        return JobResult(name, "no_data", 0)
    if spec.get("target_schema"):
        bound = positional_bind(rows.drop(POSITION), StructType.fromDDL(spec["target_schema"]))
        if keyed:
            names = bound.columns
            rows = rows.toDF(*names, POSITION).select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in bound.schema.fields], POSITION)
        else:
            rows = bound
    n, _ = _write(ws, name, spec, rows, mode, refresh=False)
    return _finish(ws, name, {**spec, "incremental_field": None}, mode, last_updated, n, None)


def sql_text(ws: Workspace, spec: dict, field: str = "sql"):
    """SQL from the spec, or from the file named by ``sql_file`` (a separate
    field: SQL text containing '/' is never mistaken for a path)."""
    if spec.get("sql_file"):
        return ws.spark.read.option("wholetext", True).text(spec["sql_file"]).first()[0].strip()
    return spec[field]


def run_schema(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    ws.record_status(name, "running")
    stmt = sql_text(ws, spec)
    args = {"database_name": ws.database} if ":database_name" in stmt else None
    ws.spark.sql(stmt, args=args)
    ws.record_status(name, "completed")
    ws.mark_done(name, mode, last_updated, None)
    return JobResult(name, "completed")


def run_procedure(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    """Install a named transform.  ``CREATE … FUNCTION`` statements run now;
    a ``BEGIN … END`` script is kept and runs when a flattened job calls it."""
    body = sql_text(ws, spec).strip()
    if body.upper().startswith("BEGIN"):
        ws.transforms[name] = body
    else:
        ws.spark.sql(body)
    return JobResult(name, "completed")


def call_transform(ws: Workspace, call: str) -> DataFrame:
    return ws.spark.sql(ws.transforms.get(call, call))


def run_flattened(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    rows = call_transform(ws, spec["procedure_call"])
    n = ws.target(spec["target_table"]).commit(rows)
    ws.mark_done(name, mode, last_updated, n)
    return JobResult(name, "completed", n)


def run_summary(ws: Workspace, name: str, spec: dict, mode: str, last_updated=None) -> JobResult:
    stmts = sql_text(ws, spec)
    if isinstance(stmts, str) and stmts.lstrip().startswith("["):
        import json
        stmts = json.loads(stmts)  # a JSON list read through a string-typed catalogue field
    if isinstance(stmts, str):
        raise ValueError("summary statements must be a JSON list (';' splitting breaks literals)")
    out = None
    for s in stmts:
        out = ws.spark.sql(s)
    target = ws.target(spec["target_table"])
    idx = spec.get("indexes") or []
    n = write_clustered(target, out, idx) if idx else target.commit(out)
    ws.mark_done(name, mode, last_updated, n)
    return JobResult(name, "completed", n)


JOB_TYPES = {
    "schema": run_schema,
    "extract_load": run_extract_load,
    "load": run_load,
    "procedure": run_procedure,
    "flattened": run_flattened,
    "summary": run_summary,
}


def run_job(ws: Workspace, name: str, spec: dict, mode: str = "full", last_updated=None) -> JobResult:
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    try:
        fn = JOB_TYPES[spec["type"]]
    except KeyError:
        raise ValueError(f"unknown job type {spec.get('type')!r} for {name}") from None
    try:
        return fn(ws, name, spec, mode, last_updated)
    except Exception as e:
        ws.record_status(name, "failed", str(e))
        raise


# --- mode selection and catalogue runs ---------------------------------------

def resolve_mode(full_refresh: bool = False, incremental: bool = False, scheduled: bool = False,
                 last_updated=None, as_of: dt.date | None = None) -> tuple[str, object]:
    """(mode, watermark) from the run flags: at most one flag, default incremental.

    ``scheduled`` is an incremental run from the day before ``as_of``; a full
    refresh ignores any watermark.
    """
    if sum(map(bool, (full_refresh, incremental, scheduled))) > 1:
        raise ValueError("choose one of full refresh, incremental or scheduled")
    if full_refresh:
        return "full", None
    if scheduled:
        if as_of is None:
            raise ValueError("a scheduled run needs as_of")
        return "incremental", as_of - dt.timedelta(days=1)
    return "incremental", last_updated


def completed_jobs(ws: Workspace, mode: str, watermark) -> DataFrame:
    """Completion rows for this (mode, watermark).  An incremental run without a watermark goes on from wherever
    its sources stand, so it is never complete beforehand."""
    runs = ws.runs.read().where((F.col("mode") == mode) & (F.col("status") == "completed"))
    if watermark is None:
        return runs.where(F.col("watermark").isNull() & F.lit(mode == "full")).select("job")
    return runs.where(F.col("watermark") == watermark_literal(watermark)).select("job")


def run_catalogue(ws: Workspace, catalogue: DataFrame, mode: str = "incremental", watermark=None,
                  workers: int = 1, skip_completed: bool = True, retain_versions: int = 2) -> list[JobResult]:
    """Run every job of a merged catalogue (``task``, ``spec`` rows) in dependency order.

    Levels come from the dependency edges (unknown names ignored) computed in
    Spark; jobs of one level are independent and may run on ``workers``
    threads (Spark runs their jobs concurrently).  Jobs already completed for
    this mode and watermark are skipped.  A job that fails is recorded so, with
    its error, and blocks only the jobs that depend on it; the run itself has a
    row in the history.  Only the specs (configuration, not
    data) are collected to the driver.
    """
    from concurrent.futures import ThreadPoolExecutor

    from sluice.plans.lineage import dependency_closure, dependency_cycles, dependency_levels, resolve_edges

    jobs = catalogue.select(F.col("task").alias("job"))
    edges = resolve_edges(catalogue.select(F.col("task").alias("job"),
                                           F.explode_outer("spec.dependencies").alias("dep"))
                          .where(F.col("dep").isNotNull()), jobs)
    unknown = (catalogue.select(F.col("task").alias("job"), F.explode("spec.dependencies").alias("dep"))
               .join(jobs.select(F.col("job").alias("dep")), "dep", "left_anti").collect())
    if unknown:
        # Names that define no job are ignored (as the reference does), but reported.
        import warnings
        warnings.warn("unknown dependencies ignored: " +
                      ", ".join(sorted(f"{r.job}->{r.dep}" for r in unknown)), stacklevel=2)
    levels = dependency_levels(jobs, edges)
    todo = levels
    if skip_completed:
        todo = levels.join(completed_jobs(ws, mode, watermark), "job", "left_anti")
    plan = (todo.join(catalogue.withColumnRenamed("task", "job"), "job")
            .select("job", "level", F.to_json("spec").alias("spec")).orderBy("level", "job").collect())
    blocked = [r.job for r in plan if r.level is None]
    if blocked:
        members: dict[str, list[str]] = {}
        for r in dependency_cycles(dependency_closure(edges)).orderBy("job").collect():  # configuration, not data
            members.setdefault(r.cycle, []).append(r.job)
        raise ValueError("dependency cycle: " + "; ".join(", ".join(m) for m in members.values()))
    import json
    specs = {r.job: {k: v for k, v in json.loads(r.spec).items() if v is not None} for r in plan}
    needs: dict[str, set[str]] = {}
    for r in edges.collect():  # configuration, not data
        needs.setdefault(r.job, set()).add(r.dep)
    results: list[JobResult] = []
    broken: set[str] = set()
    run = ws.begin_run(mode)

    def attempt(job: str) -> JobResult:
        if needs.get(job, set()) & broken:
            return JobResult(job, "blocked", notes=sorted(needs[job] & broken))
        try:
            return run_job(ws, job, specs[job], mode, watermark)
        except Exception as e:  # recorded; jobs that do not need this one go on
            return JobResult(job, "failed", notes=[str(e)])

    for lvl in sorted({r.level for r in plan}):
        batch = [r.job for r in plan if r.level == lvl]
        # Jobs of one level are independent: their state rows are written
        # together when the level ends (the next level reads them).
        with ws.batched_state(), ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            done = list(pool.map(attempt, batch))
        broken |= {r.job for r in done if r.status in ("failed", "blocked")}
        results.extend(done)
    ws.recovered([r.job for r in results if r.status in ("completed", "no_data")])
    ws.end_run(run, results)
    # Each state update wrote a small new version; keep the recent ones only.
    for t in (ws.meta, ws.watermarks, ws.history):
        t.vacuum(retain=10)
    # Versioned targets keep the current and previous copies (a reader may
    # still be on the previous one); bucketed targets drop unused folders themselves.
    for spec in specs.values():
        if spec.get("target_table") and not spec.get("bucket_by"):
            ws.target(spec["target_table"]).vacuum(retain=max(1, retain_versions))
    return results
