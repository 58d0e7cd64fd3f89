"""Task-state roll-up per run, log-line and outcome classification, and the
reconciliation of finished runs with their pending history rows.

The reference rolls up one live task map in Python; here every run is rolled
up by one ``groupBy(run_id)`` whose aggregates (conditional counts, min,
max_by, bool_or) all have partial forms, so a run holding a third of all
tasks is pre-aggregated on the map side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import exprs as X

EPOCH0 = dt.datetime(1970, 1, 1)


def rollup(task_state: DataFrame, now: dt.datetime) -> DataFrame:
    """Per run: counts by status, progress, current task, start, elapsed, type, final status."""
    s, name = F.col("status"), F.col("name")
    done_s, running_s, failed_s, pending_s, disabled_s = X.TASK_STATES
    running = s == running_s
    agg = task_state.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(s == done_s).alias("completed_tasks"),
        F.count_if(running).alias("running_tasks"),
        F.count_if(s == failed_s).alias("failed_tasks"),
        F.count_if(s == pending_s).alias("pending_tasks"),
        F.count_if(s == disabled_s).alias("disabled_tasks"),
        # Running task with the latest start (missing start = 0); ties -> lowest task id.
        F.max_by(F.when(running, name),
                 F.when(running, F.struct(F.coalesce("start_time", X.ntz(EPOCH0)), -F.col("task_id"))))
        .alias("current_task"),
        F.min("start_time").alias("pipeline_start_time"),
        F.bool_or(name.contains(X.INCREMENTAL_MARKER)).alias("has_incremental"),
        F.bool_or(name.contains(X.FULL_REFRESH_MARKER)).alias("has_full_refresh"),
        F.bool_or(F.col("incremental") == "False").alias("has_full_param"))
    done, total = F.col("completed_tasks"), F.col("total_tasks")
    failed, pending, disabled = F.col("failed_tasks"), F.col("pending_tasks"), F.col("disabled_tasks")
    is_running = F.col("running_tasks") > 0
    ok = (failed == 0) & (done > 0) & (pending == 0) & (disabled == 0)
    elapsed = F.coalesce(F.expr(f"timestampdiff(SECOND, pipeline_start_time, TIMESTAMP_NTZ'{now:%Y-%m-%d %H:%M:%S}')"),
                         F.lit(0).cast("bigint"))
    return agg.select(
        "run_id", "total_tasks", "completed_tasks", "running_tasks", "failed_tasks", "pending_tasks",
        "disabled_tasks", "current_task", "pipeline_start_time",
        X.capped_progress(done, total).alias("progress"),
        is_running.alias("running"),
        F.when(F.col("has_incremental"), "incremental").when(F.col("has_full_refresh"), "full_refresh")
         .when(F.col("has_full_param"), "full_refresh").otherwise("unknown").alias("pipeline_type"),
        elapsed.cast("bigint").alias("elapsed_time"),
        F.when(is_running, F.lit(None).cast("string")).when(ok, "completed").when(pending > 0, "pending")
         .when(failed > 0, "failed").otherwise("done").alias("final_status"),
        F.when(~is_running, ok).alias("success"),
        F.when(is_running, "running_pipeline").when(pending > 0, "pending").otherwise("ready").alias("state"))


def messages(r: DataFrame, *kept: str) -> DataFrame:
    """Status message and the history result text of a finished run, and ``kept`` columns of the roll-up."""
    done, total = F.col("completed_tasks"), F.col("total_tasks")
    failed, pending, disabled = F.col("failed_tasks"), F.col("pending_tasks"), F.col("disabled_tasks")
    running_msg = F.concat(
        X.template(X.RUNNING_MESSAGE, task=F.coalesce("current_task", F.lit(X.DEFAULT_TASK)), done=done,
                   total=total, elapsed=F.col("elapsed_time")),
        F.when(failed > 0, X.template(X.RUNNING_FAILED_SUFFIX, failed=failed)).otherwise(F.lit("")))
    outcome = F.when(failed == 0, F.lit(X.FINISHED_OK)).otherwise(X.template(X.FINISHED_WITH_FAILURES, failed=failed))
    message = (F.when(F.col("running"), running_msg)
               .when((done == total) & (total > 0), X.template(X.FINISHED_MESSAGE, outcome=outcome, done=done,
                                                               total=total))
               .when(pending > 0, X.template(X.PENDING_MESSAGE, done=done, total=total, pending=pending))
               .otherwise(F.lit(X.READY_MESSAGE)))
    result_msg = F.when(~F.col("running"), X.template(X.RESULT_MESSAGE, done=done, failed=failed, pending=pending,
                                                      disabled=disabled))
    return r.select("run_id", message.alias("message"), result_msg.alias("result_msg"), *kept)


def heartbeat(r: DataFrame) -> DataFrame:
    e = F.col("elapsed_time")
    return r.select("run_id", X.heartbeat_progress(e).alias("progress"),
                    X.template(X.HEARTBEAT_MESSAGE, elapsed=e).alias("message"))


def reconcile(r: DataFrame, history: DataFrame) -> DataFrame:
    """Finished runs matched to their latest pending/running history row.

    Equi join on ``run_id`` (both sides unique per run after their
    aggregates) with the type check ``action = type OR type = 'unknown'`` as
    a residual condition, so it stays a hash/sort-merge join.
    """
    latest = (history.where(F.col("status").isin("pending", "running"))
              .groupBy(F.col("run_id").alias("h_run_id"))
              .agg(F.max_by(F.struct("id", "action"), F.struct("created_at", "id")).alias("h")))
    fin = messages(r, "running", "pipeline_type", "final_status", "success").where(~F.col("running"))
    cond = (F.col("run_id") == F.col("h_run_id")) & \
           ((F.col("h.action") == F.col("pipeline_type")) | (F.col("pipeline_type") == "unknown"))
    return fin.join(latest, cond).select(
        F.col("h.id").alias("id"), "run_id", F.col("final_status").alias("status"), "success",
        F.col("result_msg").alias("result"))


def classify_lines(lines: DataFrame) -> DataFrame:
    outcome = X.classify_line(F.col("line"))
    return lines.select(
        "line_no", outcome.alias("outcome"),
        F.when(outcome.isin("completed", "failed"), 100).when(outcome == "starting", 5).alias("progress"),
        F.when(outcome.isNotNull(), outcome == "starting").alias("running"),
        F.when(outcome == "starting", X.strip_ws(F.col("line"))).alias("message"))


def classify_outcomes(outcomes: DataFrame) -> DataFrame:
    ok = X.outcome_success(F.col("returncode"), F.col("stdout"), F.col("stderr"))
    return outcomes.select("run_id", ok.alias("success"),
                           F.when(ok, "success").otherwise("failure").alias("outcome"))
