"""Run-history queries: filters, paging, counts, statistics, type list,
ISO/display formatting, and the append/update writes.

Filters are ANDed ``Column`` predicates (the reference's ``WHERE 1=1``
builder); the day-precision date range is rewritten as a half-open range on
the raw timestamp so it reaches the parquet scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import exprs as X
from sluice.operators.sizing import is_small
from sluice.operators.upsert import materialize

HISTORY_COLS = ["id", "action", "pipeline_type", "start_time", "end_time", "duration_seconds", "success",
                "status", "result", "created_at"]


@dataclass
class HistoryFilter:
    pipeline_type: str | None = None
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    success: bool | None = None
    status: str | None = None

    @classmethod
    def from_status_filter(cls, value: str, **kw) -> "HistoryFilter":
        """UI status filter: success / failed map to ``success``; the listed
        statuses map to ``status``; anything else filters nothing."""
        if value == "success":
            return cls(success=True, **kw)
        if value == "failed":
            return cls(success=False, **kw)
        if value in X.STATUS_FILTER_VALUES:
            return cls(status=value, **kw)
        return cls(**kw)

    def predicate(self) -> Column:
        preds: list[Column] = []
        if self.pipeline_type:
            preds.append(F.col("action") == self.pipeline_type)
        if self.date_from:
            preds.append(F.col("start_time") >= X.ntz(self.date_from))
        if self.date_to:
            preds.append(F.col("start_time") < X.ntz(self.date_to + dt.timedelta(days=1)))
        if self.success is not None:
            preds.append(F.col("success") == F.lit(self.success))
        if self.status:
            preds.append(F.col("status") == self.status)
        return reduce(lambda a, b: a & b, preds, F.lit(True))


def _midnight(d: dt.date) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day)


def filtered(history: DataFrame, f: HistoryFilter) -> DataFrame:
    return history.where(f.predicate())


def newest_first(df: DataFrame) -> DataFrame:
    # created_at ties broken by id so pages are deterministic.
    return df.orderBy(F.col("created_at").desc(), F.col("id").desc())


def history_page(history: DataFrame, f: HistoryFilter, page: int = 1, per_page: int = 25) -> DataFrame:
    """One page, newest first, with ISO-8601 text times (top-k: each task keeps
    only its first offset+limit rows before the final merge)."""
    rows = newest_first(filtered(history, f)).offset((page - 1) * per_page).limit(per_page)
    return rows.select("id", "action", "pipeline_type",
                       X.iso_format(F.col("start_time")).alias("start_time"),
                       X.iso_format(F.col("end_time")).alias("end_time"),
                       "duration_seconds", "success", "status", "result",
                       X.iso_format(F.col("created_at")).alias("timestamp"))


def history_page_after(history: DataFrame, f: HistoryFilter, after: tuple | None = None,
                       per_page: int = 25) -> DataFrame:
    """Keyset page: the ``per_page`` newest rows strictly older than the cursor
    ``after = (created_at, id)`` of the previous page's last row.  Each task
    keeps only ``per_page`` rows however deep the page, where OFFSET paging
    keeps ``offset + limit``."""
    rows = filtered(history, f)
    if after is not None:
        c, i = after
        ts = X.ntz(c)
        rows = rows.where((F.col("created_at") < ts) | ((F.col("created_at") == ts) & (F.col("id") < F.lit(i))))
    return newest_first(rows).limit(per_page)


def history_count(history: DataFrame, f: HistoryFilter) -> DataFrame:
    return filtered(history, f).agg(F.count(F.lit(1)).alias("total"))


def history_page_count(history: DataFrame, f: HistoryFilter, per_page: int = 25) -> DataFrame:
    return history_count(history, f).select(
        "total", F.lit(per_page).alias("per_page"),
        F.ceil(F.col("total") / F.lit(per_page)).cast("bigint").alias("pages"))


def status_filter_counts(history: DataFrame, values: list[str]) -> DataFrame:
    """Rows matched by each UI status-filter value, in one scan."""
    aggs = [F.count_if(HistoryFilter.from_status_filter(v).predicate()).alias(f"c{i}") for i, v in enumerate(values)]
    stack = ", ".join(f"'{v}', c{i}" for i, v in enumerate(values))
    return history.agg(*aggs).selectExpr(f"stack({len(values)}, {stack}) AS (status_filter, runs)")


def last_pending(history: DataFrame) -> DataFrame:
    return (newest_first(history.where(F.col("status").isin("pending", "running"))).limit(1)
            .select("id", "action", "pipeline_type", "start_time", "status", "result"))


def history_stats(history: DataFrame) -> DataFrame:
    """total, success rate and average duration (one decimal, half-up, exact
    integer arithmetic), last run.  Unfinished runs count in the denominator;
    empty history gives 0, 0, 0, NULL."""
    agg = history.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("success")).alias("ok"),
        F.sum((F.col("duration_seconds") * 100).cast("bigint")).alias("cents"),
        F.count("duration_seconds").alias("n_dur"),
        F.max("created_at").alias("last"))
    return agg.select(
        "total_runs",
        (F.expr("CASE WHEN total_runs = 0 THEN 0 ELSE (2000 * ok + total_runs) div (2 * total_runs) END")
         / 10.0).alias("success_rate"),
        (F.expr("CASE WHEN n_dur = 0 THEN 0 ELSE (2 * cents + 10 * n_dur) div (20 * n_dur) END")
         / 10.0).alias("avg_duration"),
        X.iso_format(F.col("last")).alias("last_run"))


def pipeline_types(history: DataFrame) -> DataFrame:
    """Predefined types (they win) followed by observed ones not predefined, one row per action.

    An action observed with several types has that of its newest run.  Partial
    aggregation keeps one row per action per task before the shuffle.
    """
    spark = history.sparkSession
    pre = spark.createDataFrame([(i, a, p) for i, (a, p) in enumerate(X.PREDEFINED_PIPELINE_TYPES)],
                                "ord int, action string, pipeline_type string")
    observed = history.groupBy("action").agg(
        F.max_by("pipeline_type", F.struct("created_at", "id")).alias("pipeline_type"))
    extra = observed.join(F.broadcast(pre.select("action")), "action", "left_anti") \
        .select(F.lit(len(X.PREDEFINED_PIPELINE_TYPES)).alias("ord"), "action", "pipeline_type")
    return pre.unionByName(extra).orderBy("ord", "action")


def iso_view(history: DataFrame) -> DataFrame:
    return history.select("id", X.iso_format(F.col("start_time")).alias("start_iso"),
                          X.iso_format(F.col("end_time")).alias("end_iso"),
                          X.iso_format(F.col("created_at")).alias("created_iso"))


def display_view(history: DataFrame) -> DataFrame:
    return history.select(
        "id",
        X.row_class(F.col("success"), F.col("status")).alias("row_class"),
        X.display_status(F.col("success"), F.col("status")).alias("status_label"),
        F.coalesce(F.date_format("start_time", "yyyy-MM-dd HH:mm:ss"), F.lit("N/A")).alias("start_display"),
        X.display_duration(F.col("duration_seconds")).alias("duration_display"),
        X.preview(F.col("result")).alias("result_preview"))


# --- writes -----------------------------------------------------------------

# Epoch seconds <-> timestamp_ntz in plain wall-clock arithmetic (UTC epoch),
# independent of the session time zone.
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_to_ts(epoch_sql: str) -> Column:
    """Epoch seconds (a SQL expression) -> timestamp_ntz, to the microsecond."""
    return F.expr(f"timestampadd(MICROSECOND, CAST(round(({epoch_sql}) * 1000000) AS BIGINT), {_EPOCH})")


def ts_to_epoch(ts_col: str) -> Column:
    """timestamp_ntz column -> epoch seconds (double)."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{ts_col}`) / 1000000")


def log_executions(runs: DataFrame) -> DataFrame:
    """History rows from finished runs.

    ``runs``: (id, action, start_epoch, end_epoch, success, result, status);
    epoch seconds as doubles, ``end_epoch`` NULL when the run has not ended.
    """
    end = F.col("end_epoch")
    start_ts = epoch_to_ts("start_epoch")
    end_ts = F.when(end.isNotNull(), epoch_to_ts("end_epoch"))
    return runs.select(
        F.col("id").cast("bigint").alias("id"),
        "action",
        X.humanize(F.col("action")).alias("pipeline_type"),
        start_ts.alias("start_time"),
        end_ts.alias("end_time"),
        F.when(end.isNotNull(), F.round(end - F.col("start_epoch"), 2)).cast("decimal(10,2)")
        .alias("duration_seconds"),
        F.when(F.col("status") == "completed", F.col("success")).alias("success"),
        "status",
        X.clip_result(F.col("result")).alias("result"),
        F.coalesce(end_ts, start_ts).alias("created_at"))


def apply_status_updates(history: DataFrame, updates: DataFrame, now: dt.datetime) -> DataFrame:
    """Update runs by id.

    ``updates``: (id, status, end_epoch, success, result), unique per id.
    Terminal statuses (completed, failed, interrupted) set end_time (``now``
    when not given), duration (only when an end is given), success and
    result; other statuses set status and result only.  When the update set
    is proven small it is broadcast and history is not shuffled.
    """
    u = materialize(updates).select(*[F.col(c).alias(f"u_{c}") for c in updates.columns])
    if is_small(u):
        u = F.broadcast(u)
    j = history.join(u, F.col("id") == F.col("u_id"), "left")
    hit = F.col("u_id").isNotNull()
    term = hit & F.col("u_status").isin(*X.TERMINAL_STATUSES)
    given_end = F.col("u_end_epoch").isNotNull()
    return j.select(
        "id", "action", "pipeline_type", "start_time",
        F.when(term, F.coalesce(F.when(given_end, epoch_to_ts("u_end_epoch")),
                                X.ntz(now))).otherwise(F.col("end_time")).alias("end_time"),
        F.when(term, F.when(given_end, F.round(F.col("u_end_epoch") - ts_to_epoch("start_time"), 2)
                            .cast("decimal(10,2)"))).otherwise(F.col("duration_seconds")).alias("duration_seconds"),
        F.when(term, F.col("u_success")).otherwise(F.col("success")).alias("success"),
        F.when(hit, F.col("u_status")).otherwise(F.col("status")).alias("status"),
        F.when(hit, X.clip_result(F.col("u_result"))).otherwise(F.col("result")).alias("result"),
        "created_at")
