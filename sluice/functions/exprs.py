"""Scalar column expressions (all JVM-side built-ins, inside whole-stage codegen).

The same expressions serve batch and streaming plans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's text for equal results.
# ---------------------------------------------------------------------------
# Log-line classification (first match wins).
LOG_SUCCESS_EXACT = "This progress looks :)"        # tested against the raw line
LOG_SUCCESS_LOWER = "completed successfully"        # tested against the lower-cased line
LOG_FAILED_WORD = "failed"
LOG_FAILED_CONTEXT = ["pipeline", "task"]
LOG_START_WORDS = ["starting", "initializing", "connecting to database"]
# Outcome classification of a finished job's output.
OUTCOME_ERROR_WORDS = ["ERROR", "FAILED", "Exception", "Traceback", "error", "failed"]
OUTCOME_SUCCESS_PHRASES = ["completed successfully", "pipeline completed", "successfully",
                           "This progress looks :)"]
# Run-history status filter of the history page.
STATUS_FILTER_VALUES = ["pending", "running", "interrupted", "completed"]
TERMINAL_STATUSES = ["completed", "failed", "interrupted"]
# Predefined pipeline types, in their listed order: (action, pipeline_type).
PREDEFINED_PIPELINE_TYPES = [
    ("full_refresh", "Full Refresh Pipeline"),
    ("incremental", "Incremental Update Pipeline"),
    ("scheduled_incremental", "Scheduled Incremental Pipeline"),
    ("scheduled_full", "Scheduled Full Refresh Pipeline"),
    ("force_refresh", "Force Full Refresh Pipeline"),
    ("extract_load", "Extract Load Pipeline"),
    ("procedure", "Procedure Pipeline"),
    ("flattened", "Flattened Pipeline"),
    ("schema", "Schema Pipeline"),
    ("summary", "Summary Pipeline"),
]
RESULT_MAX_CHARS = 1000
PREVIEW_CHARS = 100
PROGRESS_CAP = 95
HEARTBEAT_BASE, HEARTBEAT_CAP, HEARTBEAT_STEP_S = 10, 90, 10
# Task states and the name markers that decide a run's pipeline type.
TASK_STATES = ["DONE", "RUNNING", "FAILED", "PENDING", "DISABLED"]
INCREMENTAL_MARKER, FULL_REFRESH_MARKER = "Incremental", "FullRefresh"
# Progress and history messages ({name} is filled from a column).
RUNNING_MESSAGE = "Running {task}... ({done}/{total} tasks completed, {elapsed}s elapsed)"
RUNNING_FAILED_SUFFIX = ", {failed} failed"
FINISHED_MESSAGE = "Pipeline completed {outcome}! ({done}/{total} tasks completed)"
FINISHED_OK, FINISHED_WITH_FAILURES = "successfully", "with {failed} failures"
PENDING_MESSAGE = "Pipeline pending... ({done}/{total} tasks completed, {pending} pending)"
READY_MESSAGE = "Luigi daemon is running. Ready to start pipelines."
RESULT_MESSAGE = "Tasks: {done} completed, {failed} failed, {pending} pending, {disabled} disabled."
HEARTBEAT_MESSAGE = "Pipeline running... ({elapsed}s elapsed)"
DEFAULT_TASK = "pipeline"
# History page display: (label, row class) choices and empty placeholders.
LABEL_SUCCESS, LABEL_FAILED, LABEL_DONE = "Success", "Failed", "Done"
LABEL_INTERRUPTED, LABEL_PENDING, LABEL_UNKNOWN = "Interrupted", "Pending", "Unknown"
NO_DETAILS, NOT_AVAILABLE, ELLIPSIS = "No details", "N/A", "..."
# ---------------------------------------------------------------------------


def template(text: str, **cols: Column) -> Column:
    """A message from a fixed template: ``{name}`` parts are filled from columns."""
    import re
    parts: list[Column] = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", text)):
        if i % 2:
            parts.append(cols[piece].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def any_of(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def humanize(action: Column) -> Column:
    """``full_refresh`` -> ``Full Refresh`` (word starts upper, rest lower)."""
    return F.initcap(F.replace(action, F.lit("_"), F.lit(" ")))


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clip_result(c: Column) -> Column:
    """First 1000 characters; empty or NULL becomes NULL."""
    return F.left(F.nullif(c, F.lit("")), F.lit(RESULT_MAX_CHARS))


def iso_format(ts: Column) -> Column:
    """ISO-8601 text: seconds, plus ``.ffffff`` only when microseconds are non-zero."""
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")))


def preview(result: Column) -> Column:
    """First 100 characters plus ``...`` when longer; ``No details`` when empty."""
    has = result.isNotNull() & (F.length(result) > 0)
    body = F.concat(F.left(result, F.lit(PREVIEW_CHARS)),
                    F.when(F.length(result) > PREVIEW_CHARS, F.lit(ELLIPSIS)).otherwise(F.lit("")))
    return F.when(has, body).otherwise(F.lit(NO_DETAILS))


def display_status(success: Column, status: Column) -> Column:
    return (F.when(F.coalesce(success, F.lit(False)), LABEL_SUCCESS)
            .when(status.isin("failed", "unknown"), LABEL_FAILED)
            .when(status == "done", LABEL_DONE)
            .when(status == "interrupted", LABEL_INTERRUPTED)
            .when(status == "pending", LABEL_PENDING)
            .otherwise(LABEL_UNKNOWN))


def row_class(success: Column, status: Column) -> Column:
    return (F.when(F.coalesce(success, F.lit(False)), "success")
            .when(status == "failed", "failed")
            .when(status == "done", "done")
            .when(status == "interrupted", "interrupted")
            .otherwise("pending"))


def display_duration(d: Column) -> Column:
    """One decimal (half-up on the exact decimal) plus ``s``; ``N/A`` when NULL or zero."""
    return F.concat(F.when(F.coalesce(d, F.lit(0)) != 0, F.round(d, 1).cast("decimal(11,1)").cast("string"))
                    .otherwise(F.lit(NOT_AVAILABLE)), F.lit("s"))


def classify_line(line: Column) -> Column:
    """Log-line outcome: completed / failed / starting / NULL, first match wins."""
    low = F.lower(line)
    return (F.when(line.contains(LOG_SUCCESS_EXACT) | low.contains(LOG_SUCCESS_LOWER), "completed")
            .when(low.contains(LOG_FAILED_WORD) & any_of([low.contains(w) for w in LOG_FAILED_CONTEXT]), "failed")
            .when(any_of([low.contains(w) for w in LOG_START_WORDS]), "starting"))


def outcome_success(returncode: Column, stdout: Column, stderr: Column) -> Column:
    """Exit code 0 and not (an error word without a success phrase); a missing text is empty."""
    stdout, stderr = F.coalesce(stdout, F.lit("")), F.coalesce(stderr, F.lit(""))
    has_err = any_of([stdout.contains(w) | stderr.contains(w) for w in OUTCOME_ERROR_WORDS])
    low = F.lower(stdout)
    has_ok = any_of([low.contains(p) for p in OUTCOME_SUCCESS_PHRASES])
    return (returncode == 0) & ~(has_err & ~has_ok)


def capped_progress(done: Column, total: Column) -> Column:
    """int(min(95, done / total * 100)) in exact integer arithmetic; 0 when total is 0."""
    # done*100/total is a quotient of small integers: the double is correctly
    # rounded and can never fall below the next integer, so floor is exact.
    return F.when(total > 0, F.least(F.lit(PROGRESS_CAP).cast("bigint"),
                                     F.floor(done * 100 / total).cast("bigint"))) \
        .otherwise(F.lit(0).cast("bigint"))


def heartbeat_progress(elapsed_s: Column) -> Column:
    """min(90, 10 + int(elapsed / 10)) on whole seconds."""
    return F.least(F.lit(HEARTBEAT_CAP).cast("bigint"),
                   F.lit(HEARTBEAT_BASE).cast("bigint") + F.floor(elapsed_s / HEARTBEAT_STEP_S).cast("bigint"))


def ntz(value) -> Column:
    """A ``timestamp_ntz`` literal from a Python date/datetime.

    ``F.lit(datetime)`` is a session-time-zone timestamp, which shifts when
    compared with wall-clock (ntz) columns in a non-UTC session; a typed SQL
    literal does not.
    """
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        return F.expr(f"TIMESTAMP_NTZ'{value:%Y-%m-%d %H:%M:%S.%f}'")
    if isinstance(value, _dt.date):
        return F.expr(f"TIMESTAMP_NTZ'{value:%Y-%m-%d} 00:00:00'")
    raise TypeError(f"not a date/datetime: {value!r}")
