"""Registered extract/load/upsert/job flows over the driver tables.

Each call works in a fresh folder under the shared checkpoint folder, runs
the jobs (writes happen here) and returns the written target read back.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.exprs import ntz
from sluice.operators import metadata as md
from sluice.operators.batches import batch_bounds
from sluice.operators.jobs import Workspace, run_catalogue, run_job
from sluice.operators.maintained import MaintainedTables
from sluice.operators.sinks import create_database, create_table, insert_columns, positional_bind, range_bucket, \
    truncate, upsert_bucketed, write_clustered
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.operators.upsert import latest_per_key, merge_columns
from sluice.plans import views
from sluice.plans.quality import COLLATION
from sluice.plans.summary import patient_summary
from sluice.session import work_path
from sluice.sources.extract import extract, extract_parameterized
from sluice.sources.json_files import (read_catalogue, read_json_positional, write_json_arrays,
                                       write_json_records, write_json_scalars)
from sluice.sources.tables import TABLE_NAMES, Tables

NOW = dt.datetime(2001, 8, 2)
WATERMARK = dt.date(2000, 1, 1)
ORDERS_SELECT = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def workspace(t: Tables, label: str) -> Workspace:
    return Workspace(t.spark, work_path(t.spark, label), NOW,
                     sources={n: t.get(n) for n in TABLE_NAMES})


def orders(t: Tables) -> DataFrame:
    return t.orders.select(*views.ORDER_COLS)


# --- 2.1 sources --------------------------------------------------------------

def extract_full(t: Tables) -> DataFrame:
    return extract(orders(t))


def extract_incremental(t: Tables) -> DataFrame:
    """Strictly after the day-precision watermark (rows at midnight excluded)."""
    return extract(orders(t), incremental=True, incremental_field="o_orderdate", last_updated=WATERMARK)


def extract_parameterized_q(t: Tables) -> DataFrame:
    sql = ("SELECT o_orderkey, o_orderdate, o_totalprice FROM {src} "
           "WHERE o_orderdate > :last_updated AND o_orderstatus <> 'P'")
    return extract_parameterized(t.spark, sql, WATERMARK, src=t.orders)


def empty_source_keeps_target(t: Tables) -> DataFrame:
    ws = workspace(t, "empty-source")
    run_job(ws, "LoadOrders", {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "orders_t"})
    res = run_job(ws, "LoadOrdersEmpty", {"type": "extract_load", "query": ORDERS_SELECT + " WHERE false",
                                          "target_table": "orders_t"})
    assert res.status == "no_data"
    return ws.target("orders_t").read()


def load_json_records(t: Tables) -> DataFrame:
    ws = workspace(t, "json-records")
    path = f"{ws.root}/files/customers"
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    write_json_records(cust, path, F.floor(F.col("c_custkey") / 50000))
    run_job(ws, "LoadCustomers", {"type": "load", "source_file": path, "target_table": "patients",
                                  "file_schema": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"})
    return ws.target("patients").read()


def load_json_arrays(t: Tables) -> DataFrame:
    ws = workspace(t, "json-arrays")
    apath, spath = f"{ws.root}/files/pairs", f"{ws.root}/files/names"
    write_json_arrays(t.customer.select("c_custkey", "c_name"), apath, F.floor(F.col("c_custkey") / 50000))
    write_json_scalars(t.part.select("p_partkey", "p_name"), "p_name", spath, F.floor(F.col("p_partkey") / 50000))
    pairs = read_json_positional(ws.spark, apath, StructType.fromDDL("k bigint, v string"))
    names = read_json_positional(ws.spark, spath, StructType.fromDDL("v string"))
    return (pairs.select(F.lit("array").alias("kind"), "k", "v")
            .unionByName(names.select(F.lit("scalar").alias("kind"), F.lit(None).cast("bigint").alias("k"), "v")))


def config_merge_last_wins(t: Tables) -> DataFrame:
    """Catalogue files of 250 tasks each; the last 10 of every file are
    redefined in the next file (which must win); one file has no ``tasks``."""
    ws = workspace(t, "catalogue")
    path = f"{ws.root}/catalogue"
    p = F.col("p_partkey")
    name = F.concat(F.lit("Task"), p.cast("string"))
    base = t.part.select(name.alias("task"), F.floor(p / 250).alias("file"),
                         F.struct(F.lit("extract_load").alias("type"),
                                  F.array().cast("array<string>").alias("dependencies")).alias("spec"))
    redefined = (t.part.where(p % 250 >= 240)
                 .select(name.alias("task"), (F.floor(p / 250) + 1).alias("file"),
                         F.struct(F.lit("summary").alias("type"),
                                  F.array(F.concat(F.lit("Task"), (p - 1).cast("string"))).alias("dependencies"))
                         .alias("spec")))
    entries = base.unionByName(redefined)
    docs = (entries.groupBy("file")
            .agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("task", "spec"))).alias("tasks")))
                 .alias("doc"))
            .select(F.lpad(F.col("file").cast("string"), 19, "0").alias("chunk"), "doc"))
    ignored = t.part.where(p == 0).select(F.lit("zzzzzzzz").alias("chunk"),
                                          F.to_json(F.struct(F.lit(1).alias("version"))).alias("doc"))
    docs.unionByName(ignored).write.mode("overwrite").partitionBy("chunk").text(path)
    merged = read_catalogue(ws.spark, path)
    return merged.select("task", F.col("spec.type").alias("type"),
                         F.array_join("spec.dependencies", ",").alias("deps"))


# --- 2.3 sinks ------------------------------------------------------------------

def full_refresh_overwrite(t: Tables) -> DataFrame:
    ws = workspace(t, "full-refresh")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "orders_t"}
    run_job(ws, "LoadOrders", spec)
    run_job(ws, "LoadOrders", spec)  # full twice = same
    return ws.target("orders_t").read()


def append_load(t: Tables) -> DataFrame:
    ws = workspace(t, "append")
    run_job(ws, "LoadOrders", {"type": "extract_load", "target_table": "orders_t",
                               "query": ORDERS_SELECT + " WHERE o_orderdate <= TIMESTAMP_NTZ'2000-01-01 00:00:00' OR o_orderdate IS NULL"})
    run_job(ws, "LoadOrders", {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "orders_t",
                               "incremental_field": "o_orderdate"}, mode="incremental", last_updated=WATERMARK)
    return ws.target("orders_t").read()


# Range buckets of order keys for large keyed targets (a parameter: about a
# million keys per partition keeps partitions near a hundred MB at scale).
ORDERS_BUCKETS = {"column": "o_orderkey", "width": 1_000_000}


def upsert_orders(t: Tables) -> DataFrame:
    """Keyed upsert into a bucketed target: only touched buckets are rewritten."""
    target = BucketedTable(t.spark, work_path(t.spark, "upsert-orders"),
                           range_bucket(ORDERS_BUCKETS["column"], ORDERS_BUCKETS["width"]))
    target.refresh(target.with_bucket(orders(t)))
    upsert_bucketed(target, views.orders_delta(t), ["o_orderkey"], order=["seq"])
    return target.read().select(*views.ORDER_COLS)


def _maintained(t: Tables, label: str) -> MaintainedTables:
    """Derived tables built from the orders and patients as they are, then given the changed orders (some of which
    pass to another patient) and patients (some of which move to another location) alone."""
    tables = MaintainedTables(t.spark, work_path(t.spark, label), {"nation": t.nation, "region": t.region}, buckets=16, index_width=ORDERS_BUCKETS["width"])
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    tables.build(people, orders(t))
    tables.apply(views.reassigned_delta(t), views.relocated_patients(t), order=["seq"])
    return tables


def maintained_flattened(t: Tables) -> DataFrame:
    return _maintained(t, "maintained-flat").read("flattened")


def maintained_patient_summary(t: Tables) -> DataFrame:
    return _maintained(t, "maintained-patients").read("patient_summary")


def maintained_location_summary(t: Tables) -> DataFrame:
    return _maintained(t, "maintained-locations").read("location_summary")


def dedupe_last_wins(t: Tables) -> DataFrame:
    return latest_per_key(views.orders_delta(t), ["o_orderkey"], ["seq"])


PARTIAL_DEFAULT_PRIORITY = "0-UNKNOWN"


def upsert_partial_columns(t: Tables) -> DataFrame:
    delta = latest_per_key(views.orders_delta(t), ["o_orderkey"], ["seq"]) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").checkpoint(eager=True)
    return merge_columns(orders(t), delta, ["o_orderkey"], ["o_orderstatus", "o_totalprice"],
                         defaults={"o_orderpriority": F.lit(PARTIAL_DEFAULT_PRIORITY)})


def _catalog_table(t: Tables, label: str, ddl: str) -> str:
    """A managed table in a per-call database located in the shared folder."""
    loc = work_path(t.spark, label)
    db = "sluice_" + loc.rsplit("-", 1)[-1]
    create_database(t.spark, db, loc)
    name = f"{db}.etl_metadata"
    create_table(t.spark, name, ddl)
    return name


def _meta_rows(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("table_name"),
                           F.col("o_custkey").cast("int").alias("record_count"))


def insert_with_defaults(t: Tables) -> DataFrame:
    name = _catalog_table(t, "insert-defaults", md.META_DDL)
    n = insert_columns(t.spark, name, _meta_rows(t), ["table_name", "record_count"])
    assert n > 0
    return t.spark.table(name).select("table_name", "record_count", "status", "error_message")


def truncate_table(t: Tables) -> DataFrame:
    name = _catalog_table(t, "truncate", md.META_DDL)
    before = insert_columns(t.spark, name, _meta_rows(t), ["table_name", "record_count"])
    truncate(t.spark, name)
    return (t.spark.table(name).agg(F.count(F.lit(1)).alias("rows_after"))
            .select(F.lit(before).cast("bigint").alias("rows_before"), "rows_after"))


def ddl_metadata_tables(t: Tables) -> DataFrame:
    """Schema jobs: database + the three state tables, then a history load
    that leaves ``status`` to its column DEFAULT."""
    ws = workspace(t, "ddl")
    db = "sluice_" + ws.root.rsplit("-", 1)[-1]
    ws.database = db
    create_database(t.spark, db, f"{ws.root}/catalog")
    for nm, ddl in (("etl_metadata", md.META_DDL), ("etl_watermarks", md.WATERMARK_DDL),
                    ("pipeline_history", md.HISTORY_DDL)):
        run_job(ws, f"Tables{nm}", {"type": "schema", "sql": f"CREATE TABLE IF NOT EXISTS "
                                    f"IDENTIFIER(:database_name || '.{nm}') ({ddl}) USING parquet"})
    hist = views.run_history(t).select("id", "action", "pipeline_type", "start_time", "end_time",
                                       "duration_seconds", "success", "result")
    insert_columns(t.spark, f"{db}.pipeline_history", hist,
                   ["id", "action", "pipeline_type", "start_time", "end_time", "duration_seconds", "success",
                    "result"])
    return t.spark.table(f"{db}.pipeline_history").select("id", "action", "pipeline_type", "start_time", "status")


def write_clustered_layout(t: Tables) -> DataFrame:
    target = VersionedTable(t.spark, work_path(t.spark, "clustered"))
    write_clustered(target, patient_summary(t), ["last_seen"])
    return target.read()


def clustered_second_column(t: Tables) -> DataFrame:
    """Orders laid out for two index columns, read by a filter on the second."""
    target = VersionedTable(t.spark, work_path(t.spark, "clustered-second"))
    write_clustered(target, orders(t), ["o_orderdate", "o_totalprice"])
    return target.read().where((F.col("o_totalprice") >= 100000) & (F.col("o_totalprice") < 110000))


def upsert_collated(t: Tables) -> DataFrame:
    """Names that differ by case and accents are one key, in a catalogue job: stored rows keep their spelling, a new
    key has its first one and its last values."""
    ws = workspace(t, "upsert-collated")
    people = views.accented_customers(t)
    people.createOrReplaceTempView("accented_customers")
    views.respelled_customers(t).createOrReplaceTempView("respelled_customers")
    spec = {"type": "extract_load", "query": "SELECT name, acctbal FROM accented_customers", "target_table": "people",
            "bucket_by": {"column": "name", "buckets": 8}}
    run_job(ws, "LoadPeople", spec)
    cat = _catalogue(ws, {"UpdatePeople": {**spec, "query": "SELECT * FROM respelled_customers", "merge_key": ["name"],
                                           "order_by": ["seq"], "key_collation": COLLATION}})
    run_catalogue(ws, cat, "incremental")
    return ws.read_target(spec).select("name", "acctbal")


ENCOUNTER_TARGET = "encounter_id bigint, patient_id bigint, encounter_date timestamp_ntz, total decimal(12,2)"


def positional_bind_q(t: Tables) -> DataFrame:
    src = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return positional_bind(src, StructType.fromDDL(ENCOUNTER_TARGET))


# --- 2.4 jobs ---------------------------------------------------------------

def job_extract_load_full(t: Tables) -> DataFrame:
    ws = workspace(t, "job-full")
    run_job(ws, "ExtractLoadOrders", {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "encounters"})
    return ws.target("encounters").read()


def job_extract_load_incremental(t: Tables) -> DataFrame:
    """Full load of the older part, then an incremental keyed upsert past the
    watermark, then a second incremental run from the stored watermark that
    finds nothing new."""
    ws = workspace(t, "job-incr")
    run_job(ws, "ExtractLoadOrders", {"type": "extract_load", "target_table": "encounters",
                                      "bucket_by": ORDERS_BUCKETS,
                                      "query": ORDERS_SELECT + " WHERE o_orderdate <= "
                                                               "TIMESTAMP_NTZ'2000-01-01 00:00:00' OR o_orderdate IS NULL"})
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "encounters",
            "source_table": "orders", "incremental_field": "o_orderdate", "merge_key": ["o_orderkey"],
            "use_stored_watermark": True, "bucket_by": ORDERS_BUCKETS}
    run_job(ws, "ExtractLoadOrders", spec, mode="incremental", last_updated=WATERMARK)
    again = run_job(ws, "ExtractLoadOrders", spec, mode="incremental")
    assert again.status == "no_data", again
    return ws.read_target(spec)


def _catalogue(ws: Workspace, tasks: dict[str, dict]) -> DataFrame:
    """A job catalogue written as a JSON file and read back."""
    path = f"{ws.root}/catalogue"
    ws.spark.createDataFrame([(json.dumps({"tasks": tasks}),)], "doc string").coalesce(1).write.text(path)
    return read_catalogue(ws.spark, path)


def job_incremental_reruns(t: Tables) -> DataFrame:
    """Full run, incremental run, then rows arrive and another incremental run takes them: no watermark is given,
    each run goes on from the stored one, and rows are appended once."""
    ws = workspace(t, "reruns")
    early = (F.col("o_orderdate") <= ntz(WATERMARK)) | F.col("o_orderdate").isNull()
    t.orders.where(early).createOrReplaceTempView("orders_feed")
    cat = _catalogue(ws, {"ExtractOrders": {
        "type": "extract_load", "query": ORDERS_SELECT.replace("FROM orders", "FROM orders_feed"),
        "target_table": "encounters", "incremental_field": "o_orderdate", "source_table": "orders_feed"}})
    run_catalogue(ws, cat, "full")
    run_catalogue(ws, cat, "incremental")
    t.orders.createOrReplaceTempView("orders_feed")
    run_catalogue(ws, cat, "incremental")
    run_catalogue(ws, cat, "incremental")
    return ws.target("encounters").read()


def job_timestamp_watermark(t: Tables) -> DataFrame:
    """Incremental runs by a field that is a point in time (TIMESTAMP): rows are appended once, whatever the zones of
    the host and the session are."""
    ws = workspace(t, "timestamp-mark")
    feed = orders(t).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    spec = {"type": "extract_load", "query": ORDERS_SELECT.replace("FROM orders", "FROM timed_feed"), "target_table": "encounters",
            "incremental_field": "o_orderdate", "source_table": "timed_feed"}
    feed.where((F.col("o_orderdate") <= F.lit("1998-01-01 13:00:00").cast("timestamp")) | F.col("o_orderdate").isNull()).createOrReplaceTempView("timed_feed")
    run_job(ws, "ExtractOrders", spec, "full")
    feed.createOrReplaceTempView("timed_feed")
    for _ in range(2):
        run_job(ws, "ExtractOrders", spec, "incremental")
    return ws.target("encounters").read().withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


class Interrupted(Exception):
    pass


def interrupted(ws: Workspace, step: str, *job, **more) -> None:
    """Run a job that ends just before ``step`` of its workspace, as a lost driver would end it."""
    def stop(*_, **__):
        raise Interrupted(step)

    setattr(ws, step, stop)
    try:
        run_job(ws, *job, **more)
    except Interrupted:
        pass
    finally:
        delattr(ws, step)


def job_retry_append(t: Tables) -> DataFrame:
    """Appends that are interrupted after the rows were written, and after the completion was, and tried again."""
    ws = workspace(t, "retry-append")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "encounters", "incremental_field": "o_orderdate",
            "source_table": "orders"}
    half = {**spec, "query": ORDERS_SELECT + " WHERE o_orderdate <= TIMESTAMP_NTZ'1998-01-01 00:00:00' OR o_orderdate IS NULL"}
    interrupted(ws, "mark_done", "ExtractOrders", half, mode="incremental")
    run_job(ws, "ExtractOrders", half, mode="incremental")
    interrupted(ws, "_advance", "ExtractOrders", spec, mode="incremental")
    run_job(ws, "ExtractOrders", spec, mode="incremental")
    return ws.target("encounters").read()


def job_empty_first_upsert(t: Tables) -> DataFrame:
    """A bucketed keyed target whose first run finds no rows; then rows, then none again."""
    ws = workspace(t, "empty-first")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "encounters", "merge_key": ["o_orderkey"], "bucket_by": ORDERS_BUCKETS}
    none = {**spec, "query": ORDERS_SELECT + " WHERE false"}
    for one in (none, spec, none):
        run_job(ws, "ExtractOrders", one, mode="incremental")
    return ws.read_target(spec).select(*views.ORDER_COLS)


def load_json_scalars(t: Tables) -> DataFrame:
    """Scalars whose text looks like JSON stay as they are."""
    ws = workspace(t, "json-scalars")
    path = f"{ws.root}/files/names"
    p = F.col("p_partkey")
    odd = F.when(p % 3 == 0, F.concat(F.lit("["), "p_name", F.lit("]"))).when(p % 3 == 1, F.concat(F.lit("{"), "p_name")).otherwise(F.col("p_name"))
    write_json_scalars(t.part.select("p_partkey", odd.alias("v")), "v", path, F.floor(p / 50000))
    run_job(ws, "LoadNames", {"type": "load", "source_file": path, "target_table": "names", "file_schema": "v string", "positional": True})
    return ws.target("names").read()


BATCH_ROWS = 1000


def extract_batches(t: Tables) -> DataFrame:
    """The ranges of an increment in batches of bounded size."""
    rows = extract(orders(t), incremental=True, incremental_field="o_orderdate", last_updated=WATERMARK)
    found = batch_bounds(rows, "o_orderdate", BATCH_ROWS)
    return found.select("batch", F.col("low").cast("timestamp_ntz").alias("low"), F.col("high").cast("timestamp_ntz").alias("high"), "rows")


def job_bounded_batches(t: Tables) -> DataFrame:
    """Incremental runs in batches of a fifth of the table's rows, about; a second run finds nothing."""
    ws = workspace(t, "batches")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "encounters", "incremental_field": "o_orderdate",
            "source_table": "orders", "batch_size": t.orders.count() // 5 + 1}
    run_job(ws, "ExtractOrders", spec, mode="incremental")
    run_job(ws, "ExtractOrders", spec, mode="incremental")
    return ws.target("encounters").read()


def bucketed_full_refresh(t: Tables) -> DataFrame:
    """A full refresh from a smaller source drops the buckets that it lacks."""
    ws = workspace(t, "bucket-refresh")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "orders_t",
            "bucket_by": {"column": "o_orderstatus", "buckets": 64}}
    run_job(ws, "LoadOrders", spec)
    run_job(ws, "LoadOrders", {**spec, "query": ORDERS_SELECT + " WHERE o_orderstatus = 'F'"})
    return ws.read_target(spec)


def load_upsert_duplicates(t: Tables) -> DataFrame:
    """JSON files that repeat keys, loaded by merge key without an order column: the last row of a key wins."""
    ws = workspace(t, "json-duplicates")
    path = f"{ws.root}/files/orders"
    delta = views.orders_delta(t)
    # Files in the order of seq, then of bounded ranges of keys.
    chunk = F.col("seq") * 10**15 + F.floor((F.col("o_orderkey") + 10**12) / 50000)
    write_json_records(delta.select(*views.ORDER_COLS, "seq"), path, chunk)
    run_job(ws, "LoadOrders", {"type": "load", "source_file": path, "target_table": "orders_t", "merge_key": ["o_orderkey"],
                               "file_schema": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                                              "o_orderdate timestamp_ntz, o_orderpriority string"})
    return ws.target("orders_t").read()


def job_parameterized(t: Tables) -> DataFrame:
    """A catalogue job whose query places the watermark itself."""
    ws = workspace(t, "job-parameter")
    cat = _catalogue(ws, {"RecentOrders": {
        "type": "extract_load", "target_table": "recent", "query": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders "
        "WHERE o_orderdate > :last_updated AND o_orderstatus <> 'P'"}})
    run_catalogue(ws, cat, "incremental", WATERMARK)
    return ws.target("recent").read()


def job_partial_upsert(t: Tables) -> DataFrame:
    """A catalogue job that updates some columns and fills defaults for new keys, into a bucketed target."""
    ws = workspace(t, "job-partial")
    spec = {"type": "extract_load", "query": ORDERS_SELECT, "target_table": "orders_t", "bucket_by": ORDERS_BUCKETS}
    run_job(ws, "LoadOrders", spec)
    views.orders_delta(t).drop("o_orderpriority").createOrReplaceTempView("orders_delta")
    cat = _catalogue(ws, {"UpdateOrders": {
        **spec, "query": "SELECT * FROM orders_delta", "merge_key": ["o_orderkey"], "order_by": ["seq"],
        "update_columns": ["o_orderstatus", "o_totalprice"], "defaults": {"o_orderpriority": f"'{PARTIAL_DEFAULT_PRIORITY}'"}}})
    run_catalogue(ws, cat, "incremental")
    return ws.read_target(spec).select(*views.ORDER_COLS)


def job_failure_status(t: Tables) -> DataFrame:
    """One job fails: it is recorded, the job that needs it is blocked, the others run."""
    ws = workspace(t, "job-failure")
    load = {"type": "extract_load", "query": ORDERS_SELECT}
    cat = _catalogue(ws, {"LoadOrders": {**load, "target_table": "orders_t"},
                          "Broken": {**load, "query": "SELECT * FROM no_such_table", "target_table": "broken_t"},
                          "AfterBroken": {**load, "target_table": "after_broken_t", "dependencies": ["Broken"]},
                          "AfterOrders": {**load, "target_table": "after_orders_t", "dependencies": ["LoadOrders"]}})
    run_catalogue(ws, cat, "full")
    return ws.meta.read().select("table_name", "status", "record_count")


SCRIPT_TRANSFORM = """BEGIN
  DECLARE cutoff TIMESTAMP_NTZ DEFAULT TIMESTAMP_NTZ'1998-01-01 00:00:00';
  CREATE OR REPLACE TEMPORARY VIEW script_encounters AS
    SELECT c.c_mktsegment, o.o_orderstatus, o.o_totalprice, o.o_orderdate
    FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey;
  SELECT c_mktsegment, o_orderstatus, count(*) AS encounters,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         count_if(o_orderdate > cutoff) AS recent
  FROM script_encounters GROUP BY c_mktsegment, o_orderstatus;
END"""


def sql_script_transform(t: Tables) -> DataFrame:
    ws = workspace(t, "script")
    run_job(ws, "SegmentStatusProc", {"type": "procedure", "sql": SCRIPT_TRANSFORM})
    run_job(ws, "FlattenSegmentStatus", {"type": "flattened", "procedure_call": "SegmentStatusProc",
                                         "target_table": "segment_status"})
    return ws.target("segment_status").read()


TABLE_FUNCTION = """CREATE OR REPLACE TEMPORARY FUNCTION encounters_after(d TIMESTAMP_NTZ)
RETURNS TABLE (c_custkey BIGINT, c_name STRING, o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE)
RETURN SELECT c_custkey, c_name, o_orderkey, o_orderdate, o_totalprice
       FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate > d"""


def table_function_transform(t: Tables) -> DataFrame:
    ws = workspace(t, "table-fn")
    run_job(ws, "EncountersAfterProc", {"type": "procedure", "sql": TABLE_FUNCTION})
    run_job(ws, "FlattenRecent", {"type": "flattened", "target_table": "recent_encounters",
                                  "procedure_call": "SELECT * FROM encounters_after("
                                                    "TIMESTAMP_NTZ'2000-01-01 00:00:00')"})
    return ws.target("recent_encounters").read()


SUMMARY_STATEMENTS = [
    "CREATE OR REPLACE TEMPORARY VIEW summary_enc AS SELECT o_custkey, count(*) AS encounters, "
    "sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY o_custkey",
    "CREATE OR REPLACE TEMPORARY VIEW summary_pat AS SELECT c_custkey, c_mktsegment, "
    "coalesce(encounters, 0) AS encounters, spend FROM customer LEFT JOIN summary_enc ON o_custkey = c_custkey",
    "SELECT c_mktsegment, count(*) AS patients, CAST(sum(encounters) AS BIGINT) AS encounters, "
    "CAST(sum(spend) AS DOUBLE) AS spend FROM summary_pat GROUP BY c_mktsegment",
]


def summary_multi_statement(t: Tables) -> DataFrame:
    ws = workspace(t, "summary")
    run_job(ws, "SegmentSummary", {"type": "summary", "sql": SUMMARY_STATEMENTS, "target_table": "segment_summary",
                                   "indexes": ["c_mktsegment"]})
    return ws.target("segment_summary").read()


# --- 2.10 metadata ----------------------------------------------------------

LOAD_TABLES = ("customer", "orders", "lineitem", "part", "supplier")


def load_record_counts(t: Tables) -> DataFrame:
    ws = workspace(t, "record-counts")
    for name in LOAD_TABLES:
        run_job(ws, f"Load{name.title()}", {"type": "extract_load", "query": f"SELECT * FROM {name}",
                                            "target_table": f"{name}_t"})
    return ws.meta.read().select("table_name", "record_count", "status")


def load_metadata_upsert(t: Tables) -> DataFrame:
    """Stale rows for every nation's load; fresh counts for nations (matched)
    and regions (new keys, inserted with defaults)."""
    nat = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    stale = nat.select(F.concat(F.lit("load_"), F.lower("n_name")).alias("table_name"),
                       ntz(dt.date(2000, 1, 1)).alias("last_update_timestamp"),
                       F.lit(0).alias("record_count"), F.lit("running").alias("status"),
                       F.lit("stale").alias("error_message"),
                       ntz(dt.date(2000, 1, 1)).alias("created_at"),
                       ntz(dt.date(2000, 1, 1)).alias("updated_at"))
    meta = t.spark.createDataFrame([], md.META_SCHEMA).unionByName(stale)
    cust = t.customer.select("c_nationkey").join(nat, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    by_nation = cust.groupBy(F.concat(F.lit("load_"), F.lower("n_name")).alias("table_name")) \
        .agg(F.count(F.lit(1)).alias("record_count"))
    by_region = cust.groupBy(F.concat(F.lit("load_region_"), F.lower("r_name")).alias("table_name")) \
        .agg(F.count(F.lit(1)).alias("record_count"))
    out = md.load_metadata_upsert(meta, by_nation.unionByName(by_region), NOW)
    return out.select("table_name", "last_update_timestamp", "record_count", "status", "error_message",
                      "updated_at")


def task_status_upsert(t: Tables) -> DataFrame:
    ts = views.task_state(t)
    counts = ts.groupBy(F.col("name").alias("table_name")).agg(F.count(F.lit(1)).alias("record_count"))
    meta = md.load_metadata_upsert(t.spark.createDataFrame([], md.META_SCHEMA), counts,
                                   dt.datetime(2001, 1, 1))
    latest = (ts.groupBy(F.col("name").alias("table_name"))
              .agg(F.max_by("status", F.struct(F.coalesce("start_time", ntz(dt.date(1970, 1, 1))),
                                               "task_id")).alias("s")))
    upd = latest.select("table_name", F.lower("s").alias("status"),
                        F.when(F.col("s") == "FAILED", F.lit("task failed")).alias("error_message"))
    out = md.task_status_upsert(meta, upd, NOW)
    return out.select("table_name", "record_count", "status", "error_message", "last_update_timestamp")


WATERMARK_SEEDS = [  # (source_table, target_table, incremental_field, stored watermark)
    ("orders", "encounters", "o_orderdate", dt.datetime(2000, 1, 1)),
    ("lineitem", "observations", "l_shipdate", dt.datetime(2001, 1, 1)),
    ("events", "run_events", "ts", dt.datetime(2024, 1, 15)),
    ("orders", "encounters_archive", "o_orderdate", dt.datetime(2030, 1, 1)),
]


def watermark_advance(t: Tables) -> DataFrame:
    """Read the stored watermark, extract past it, advance to the max loaded value."""
    spark = t.spark
    seeds = spark.createDataFrame(
        [(s, tg, f, None, w, 1000, True, NOW, NOW) for s, tg, f, w in WATERMARK_SEEDS], md.WATERMARK_SCHEMA)
    wm = VersionedTable(spark, work_path(spark, "watermarks"), md.WATERMARK_SCHEMA)
    wm.commit(seeds)
    stored = wm.read()
    loaded = None
    for source, target, fld, _ in WATERMARK_SEEDS:
        # One stored value per (source, target): the driver holds watermark values only.
        bound = stored.where((F.col("source_table") == source) & (F.col("target_table") == target)) \
            .select("last_processed_timestamp").first()[0]
        src = extract(t.get(source).select(fld), incremental=True, incremental_field=fld, last_updated=bound)
        agg = src.agg(F.max(fld).alias("max_value")).select(
            F.lit(source).alias("source_table"), F.lit(target).alias("target_table"),
            F.lit(fld).alias("incremental_field"), "max_value")
        loaded = agg if loaded is None else loaded.unionByName(agg)
    wm.commit(md.watermark_advance(stored, loaded, NOW))
    return wm.read().select("source_table", "target_table", "incremental_field", "last_processed_value",
                            "last_processed_timestamp", "batch_size", "is_active")
