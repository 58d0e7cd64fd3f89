"""Registered monitoring queries over the derived run-history, task-state,
log-line and job-outcome inputs, plus lineage and input-quality queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.exprs import ntz
from sluice.operators.storage import VersionedTable
from sluice.plans import history as H
from sluice.plans import lineage, progress, quality, views
from sluice.session import work_path
from sluice.sources.tables import Tables

NOW = dt.datetime(2001, 8, 2)          # fixed "now" for task-state elapsed times
HISTORY_NOW = dt.datetime(2024, 2, 1)  # fixed "now" for run-history updates
STATUS_FILTERS = ["success", "failed", "pending", "running", "interrupted", "completed", "all"]


def hist(t: Tables, *event_columns: str) -> DataFrame:
    return views.run_history(t, *event_columns)


def history_filtered(t):
    return H.filtered(hist(t), H.HistoryFilter(pipeline_type="incremental", success=False)).select(*H.HISTORY_COLS)


def history_date_range(t):
    f = H.HistoryFilter(date_from=dt.date(2024, 1, 10), date_to=dt.date(2024, 1, 20))
    return H.filtered(hist(t), f).select("id", "action", "start_time")


def history_count(t):
    f = H.HistoryFilter(pipeline_type="full_refresh", date_from=dt.date(2024, 1, 5), date_to=dt.date(2024, 1, 25))
    return H.history_count(hist(t), f)


def history_status_filter(t):
    return H.status_filter_counts(hist(t), STATUS_FILTERS)


def history_last_pending(t):
    return H.last_pending(hist(t))


def history_page(t):
    return H.history_page(hist(t), H.HistoryFilter.from_status_filter("completed"), page=3, per_page=25)


def history_page_count(t):
    return H.history_page_count(hist(t), H.HistoryFilter.from_status_filter("completed"), per_page=25)


def history_stats(t):
    return H.history_stats(hist(t))


def history_stats_empty(t):
    return H.history_stats(H.filtered(hist(t), H.HistoryFilter(pipeline_type="no_such_action")))


def history_types(t):
    return H.pipeline_types(hist(t)).select("action", "pipeline_type")


def history_iso(t):
    return H.iso_view(hist(t))


def history_display(t):
    return H.display_view(hist(t))


def run_records(t: Tables) -> DataFrame:
    """Finished-run records (epoch seconds) derived from events."""
    r = F.col("event_id") % 7
    start = H.ts_to_epoch("ts")
    return hist(t, "event_id", "ts", "value", "props").select(
        "id", "action",
        start.alias("start_epoch"),
        F.when(r <= 4, start + F.col("value")).alias("end_epoch"),
        (F.col("value") < 60).alias("success"),
        F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.repeat("props", (F.col("event_id") % 200).cast("int")))
        .alias("result"),
        "status")


def history_append(t):
    table = VersionedTable(t.spark, work_path(t.spark, "history"))
    table.commit(H.log_executions(run_records(t)))
    return table.read().select(*H.HISTORY_COLS)


def status_updates(t: Tables) -> DataFrame:
    h = hist(t)
    start = H.ts_to_epoch("start_time")
    pend = h.where(F.col("status") == "pending")
    finished = pend.where(F.col("id") % 2 == 0).select(
        "id", F.lit("completed").alias("status"), (start + 90.5).alias("end_epoch"), F.lit(True).alias("success"),
        F.lit("Tasks: 3 completed, 0 failed, 0 pending, 0 disabled.").alias("result"))
    still = pend.where(F.col("id") % 2 == 1).select(
        "id", F.lit("done").alias("status"), F.lit(None).cast("double").alias("end_epoch"),
        F.lit(None).cast("boolean").alias("success"), F.lit("still done").alias("result"))
    failed = h.where((F.col("status") == "interrupted") & (F.col("id") % 3 == 0)).select(
        "id", F.lit("failed").alias("status"), F.lit(None).cast("double").alias("end_epoch"),
        F.lit(False).alias("success"), F.lit("").alias("result"))
    return finished.unionByName(still).unionByName(failed)


def history_update(t):
    out = H.apply_status_updates(hist(t).select(*H.HISTORY_COLS), status_updates(t), HISTORY_NOW)
    return out.select("id", "status", "end_time", "duration_seconds", "success", "result")


# --- progress -----------------------------------------------------------------

def roll(t: Tables) -> DataFrame:
    return progress.rollup(views.task_state(t), NOW)


def progress_rollup(t):
    return roll(t).drop("current_task")


def progress_current_task(t):
    return roll(t).select("run_id", "current_task")


def progress_message(t):
    return progress.messages(roll(t))


def progress_heartbeat(t):
    return progress.heartbeat(roll(t))


def reconcile_runs(t):
    return progress.reconcile(roll(t), hist(t))


def classify_log_lines(t):
    return progress.classify_lines(views.log_lines(t))


def classify_outcomes(t):
    return progress.classify_outcomes(views.job_outcome(t))


# --- lineage ------------------------------------------------------------------

def defined_jobs(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("job"))


def dependency_edges(t):
    return lineage.resolve_edges(views.job_edges(t), defined_jobs(t))


def pending_jobs(t):
    # Completion rows (job, mode): a job counts as done once any of its rows shipped before 1996.
    done = (t.lineitem.where(F.col("l_shipdate") < ntz(dt.date(1996, 1, 1)))
            .select(F.col("l_partkey").alias("job"), F.lit("full").alias("mode")))
    return lineage.pending_jobs(defined_jobs(t), done.where(F.col("mode") == "full"))


def dependency_levels(t):
    jobs = defined_jobs(t)
    return lineage.dependency_levels(jobs, lineage.resolve_edges(views.job_edges(t), jobs))


def dependency_closure(t):
    return lineage.dependency_closure(lineage.resolve_edges(views.job_edges(t), defined_jobs(t)))


def dependency_cycles(t):
    """The same edges, of which some also go the other way."""
    edges = lineage.resolve_edges(views.job_edges(t), defined_jobs(t))
    back = edges.where(F.col("job") % 50 == 3).select(F.col("dep").alias("job"), F.col("job").alias("dep"))
    return lineage.dependency_cycles(lineage.dependency_closure(edges.unionByName(back)))


# --- quality ------------------------------------------------------------------

def json_quarantine(t):
    return quality.json_validity(views.json_bodies(t))


def collated_group_count(t):
    return quality.collated_counts(views.collation_input(t), "seg")


def path_tree(t):
    return quality.path_tree(t.pages.select("url"), "url")
