
from __future__ import annotations

from sluice.catalog import query
from sluice.plans import flatten, summary

# --- 2.5 projections / 2.6 joins / 2.7 aggregations: flatten and summary ----
query("patient_summary")(summary.patient_summary)
query("observation_summary")(summary.observation_summary)
query("location_summary")(summary.location_summary)
query("flattened_patient_encounters")(flatten.flattened_patient_encounters)
query("flattened_observations")(flatten.flattened_observations)
query("core_patients")(flatten.core_patients)
query("core_encounters")(flatten.core_encounters)
query("core_observations")(flatten.core_observations)
query("core_locations")(flatten.core_locations)

# --- 2.1 sources, 2.3 sinks, 2.4 jobs, 2.10 metadata ------------------------
from sluice.plans import loads  # noqa: E402

for _name, _fn in [
    ("extract_full", loads.extract_full),
    ("extract_incremental", loads.extract_incremental),
    ("extract_parameterized", loads.extract_parameterized_q),
    ("empty_source_keeps_target", loads.empty_source_keeps_target),
    ("load_json_records", loads.load_json_records),
    ("load_json_arrays", loads.load_json_arrays),
    ("config_merge_last_wins", loads.config_merge_last_wins),
    ("full_refresh_overwrite", loads.full_refresh_overwrite),
    ("append_load", loads.append_load),
    ("upsert_orders", loads.upsert_orders),
    ("maintained_flattened", loads.maintained_flattened),
    ("maintained_patient_summary", loads.maintained_patient_summary),
    ("maintained_location_summary", loads.maintained_location_summary),
    ("dedupe_last_wins", loads.dedupe_last_wins),
    ("upsert_partial_columns", loads.upsert_partial_columns),
    ("insert_with_defaults", loads.insert_with_defaults),
    ("truncate_table", loads.truncate_table),
    ("ddl_metadata_tables", loads.ddl_metadata_tables),
    ("write_clustered_layout", loads.write_clustered_layout),
    ("clustered_second_column", loads.clustered_second_column),
    ("upsert_collated", loads.upsert_collated),
    ("positional_bind", loads.positional_bind_q),
    ("job_extract_load_full", loads.job_extract_load_full),
    ("job_extract_load_incremental", loads.job_extract_load_incremental),
    ("job_incremental_reruns", loads.job_incremental_reruns),
    ("job_timestamp_watermark", loads.job_timestamp_watermark),
    ("job_retry_append", loads.job_retry_append),
    ("job_empty_first_upsert", loads.job_empty_first_upsert),
    ("load_json_scalars", loads.load_json_scalars),
    ("extract_batches", loads.extract_batches),
    ("job_bounded_batches", loads.job_bounded_batches),
    ("bucketed_full_refresh", loads.bucketed_full_refresh),
    ("load_upsert_duplicates", loads.load_upsert_duplicates),
    ("job_parameterized", loads.job_parameterized),
    ("job_partial_upsert", loads.job_partial_upsert),
    ("job_failure_status", loads.job_failure_status),
    ("sql_script_transform", loads.sql_script_transform),
    ("table_function_transform", loads.table_function_transform),
    ("summary_multi_statement", loads.summary_multi_statement),
    ("load_record_counts", loads.load_record_counts),
    ("load_metadata_upsert", loads.load_metadata_upsert),
    ("task_status_upsert", loads.task_status_upsert),
    ("watermark_advance", loads.watermark_advance),
]:
    query(_name)(_fn)

# --- 2.5-2.10 monitoring: history, progress, lineage, quality -----------------
from sluice.plans import monitoring as mon  # noqa: E402

for _name in ["history_filtered", "history_date_range", "history_count", "history_status_filter",
              "history_last_pending", "history_page", "history_page_count", "history_stats",
              "history_stats_empty", "history_types", "history_iso", "history_display", "history_append",
              "history_update", "progress_rollup", "progress_current_task", "progress_message",
              "progress_heartbeat", "reconcile_runs", "classify_log_lines", "classify_outcomes",
              "dependency_edges", "pending_jobs", "dependency_levels", "dependency_closure", "dependency_cycles", "json_quarantine",
              "collated_group_count", "path_tree"]:
    query(_name)(getattr(mon, _name))

# --- 2.11 streaming -------------------------------------------------------------
from sluice.streaming import queries as sq  # noqa: E402

for _name in ["stream_incremental_load", "stream_upsert", "stream_classify_lines", "stream_status_counts"]:
    query(_name)(getattr(sq, _name))
