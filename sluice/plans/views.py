"""Derived inputs built from the driver tables (FIXTURES.md §2).

The reference keeps run history, live task state, log lines and job outcomes
in a database or in process memory; here they are DataFrames derived from the
given tables so that every query's work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.exprs import humanize
from sluice.sources.tables import Tables


def run_history(t: Tables, *event_columns: str) -> DataFrame:
    """Run history, with further columns of the events where asked."""
    e = t.events
    r = F.col("event_id") % 7
    et = F.col("event_type")
    action = (F.when(et == "view", "full_refresh").when(et == "click", "incremental")
              .when(et == "signup", "scheduled_incremental").when(et == "purchase", "force_refresh")
              .otherwise("nightly_custom"))
    return e.select(
        F.col("event_id").alias("id"),
        action.alias("action"),
        F.col("ts").alias("start_time"),
        F.when(r <= 4, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("end_time"),
        F.when(r <= 4, F.col("value").cast("decimal(10,2)")).alias("duration_seconds"),
        F.when(r <= 2, F.col("value") < 60).when(r == 3, F.lit(False)).alias("success"),
        F.when(r <= 2, "completed").when(r == 3, "failed").when(r == 4, "interrupted")
         .when(r == 5, "pending").otherwise("done").alias("status"),
        F.when(r != 5, F.col("props")).alias("result"),
        F.col("ts").alias("created_at"),
        F.col("user_id").alias("run_id"),
        *event_columns,
    ).withColumn("pipeline_type", humanize(F.col("action")))


def task_state(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    name = (F.when(k % 11 == 0, "ScheduledIncrementalPipeline")
            .when(k % 11 == 1, "FullRefreshPipeline")
            .otherwise(F.concat(F.lit("Task"), (k % 50).cast("string"))))
    m = k % 23
    status = (F.when(m == 0, "RUNNING").when(m == 1, "FAILED").when(m == 2, "PENDING")
              .when(m == 3, "DISABLED").otherwise("DONE"))
    return t.orders.select(
        F.col("o_custkey").alias("run_id"),
        k.alias("task_id"),
        name.alias("name"),
        status.alias("status"),
        F.when(m != 2, F.col("o_orderdate")).alias("start_time"),
        F.when(k % 13 == 0, "False").otherwise("True").alias("incremental"),
    )


def log_lines(t: Tables) -> DataFrame:
    m = F.col("event_id") % 6
    et = F.col("event_type")
    line = (F.when(m == 0, F.lit("This progress looks :)"))
            .when(m == 1, F.concat(F.lit("Task "), et, F.lit(" failed: earlier step completed successfully")))
            .when(m == 2, F.concat(F.lit("Pipeline FAILED at "), et))
            .when(m == 3, F.concat(F.lit("  Starting task: "), et, F.lit(" ")))
            .when(m == 4, F.lit("Connecting to database"))
            .otherwise(F.concat(F.lit("row "), et)))
    return t.events.select(F.col("event_id").alias("line_no"), line.alias("line"))


def job_outcome(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    stdout = (F.when(k % 4 == 0, "Pipeline Completed Successfully").when(k % 4 == 1, "This progress looks :)")
              .when(k % 4 == 2, "rows written").otherwise("step failed"))
    stderr = F.when(k % 3 == 0, "ERROR: lock wait").when(k % 3 == 1, "Error notice").otherwise("")
    return t.orders.select(k.alias("run_id"),
                           F.when(k % 5 == 0, 2).otherwise(0).alias("returncode"),
                           stdout.alias("stdout"), stderr.alias("stderr"))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_delta(t: Tables) -> DataFrame:
    """An incremental batch with duplicate keys (``seq`` orders them) and new keys."""
    o = t.orders.select(*ORDER_COLS)
    k = F.col("o_orderkey")
    a = o.where(k % 10 == 0).select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
                                    (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderdate",
                                    "o_orderpriority", F.lit(1).alias("seq"))
    b = o.where(k % 20 == 0).select("o_orderkey", "o_custkey", F.lit("V").alias("o_orderstatus"),
                                    (F.col("o_totalprice") + 2).alias("o_totalprice"), "o_orderdate",
                                    "o_orderpriority", F.lit(2).alias("seq"))
    # Keys of new rows are negative: outside the table's own range, however many orders there are.
    c = o.where(k % 50 == 1).select((-k).alias("o_orderkey"), "o_custkey",
                                    F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_orderdate",
                                    "o_orderpriority", F.lit(1).alias("seq"))
    return a.unionByName(b).unionByName(c)


def reassigned_delta(t: Tables) -> DataFrame:
    """The orders delta; an order of a patient whose key is even passes to the patient before."""
    even = F.col("o_custkey") % 2 == 0
    return orders_delta(t).withColumn("o_custkey", F.when(even, F.col("o_custkey") - 1).otherwise(F.col("o_custkey")))


def relocated_patients(t: Tables) -> DataFrame:
    """Patients of one market segment, each moved to the next location."""
    return (t.customer.where("c_mktsegment = 'BUILDING'")
            .select("c_custkey", "c_name", "c_mktsegment", ((F.col("c_nationkey") + 1) % 25).alias("c_nationkey"), F.lit(0).cast("bigint").alias("seq")))


def json_bodies(t: Tables) -> DataFrame:
    p = F.col("props")
    body = F.when(F.col("event_id") % 5 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(p)
    return t.events.select(F.col("event_id").alias("id"), body.alias("body"))


def job_edges(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    dep = F.when(p % 7 == 0, F.lit(-1).cast("bigint")).otherwise(F.floor(p / 2.0).cast("bigint"))
    return t.part.where(p > 0).select(p.alias("job"), dep.alias("dep"))


def accented_customers(t: Tables) -> DataFrame:
    return t.customer.select(F.concat(F.lit("\u00c9 "), F.upper("c_name"), F.col("c_custkey").cast("string")).alias("name"),
                             F.col("c_acctbal").alias("acctbal"))


def respelled_customers(t: Tables) -> DataFrame:
    """Later balances under other spellings of the names, and new names in two spellings (``seq`` orders them)."""
    k, number = F.col("c_custkey"), F.col("c_custkey").cast("string")

    def rows(some: Column, initial: str, name: Column, more: int) -> DataFrame:
        return t.customer.where(some).select(F.concat(F.lit(initial + " "), name, number).alias("name"),
                                             (F.col("c_acctbal") + more).alias("acctbal"), F.lit(more).alias("seq"))

    return (rows(k % 5 == 0, "e", F.lower("c_name"), 1).unionByName(rows(k % 10 == 0, "E", F.col("c_name"), 2))
            .unionByName(rows(k % 7 == 1, "N", F.col("c_name"), 1))
            .unionByName(rows(k % 14 == 1, "\u00f1", F.lower("c_name"), 2)))


def collation_input(t: Tables) -> DataFrame:
    seg: Column = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")) \
        .otherwise(F.replace(F.col("c_mktsegment"), F.lit("E"), F.lit("É")))
    return t.customer.select(seg.alias("seg"))
