"""Expected values of the monitoring queries at sf0.01 (FIXTURES.md §2) and
lineage / quality / streaming behaviour."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.plans import history as H
from sluice.plans import lineage, monitoring, progress, quality, views
from sluice.session import work_path
from sluice.streaming import streams


def test_run_history_stats(tables_mid):
    h = views.run_history(tables_mid)
    counts = {(r.status, r.success): r["count"] for r in h.groupBy("status", "success").count().collect()}
    assert counts[("completed", True)] == 2990 and counts[("completed", False)] == 1297
    assert counts[("failed", False)] == 1429
    assert counts[("pending", None)] == counts[("done", None)] == counts[("interrupted", None)] == 1428
    s = H.history_stats(h).first()
    assert (s.total_runs, s.success_rate, s.avg_duration) == (10000, 29.9, 50.1)
    e = H.history_stats(h.where(F.lit(False))).first()
    assert (e.total_runs, e.success_rate, e.avg_duration, e.last_run) == (0, 0.0, 0.0, None)


def test_status_filter_mapping():
    f = H.HistoryFilter.from_status_filter
    assert f("success").success is True and f("failed").success is False
    assert f("pending").status == "pending" and f("bogus").status is None and f("bogus").success is None


def test_date_range_is_pushed_down(tables_mid):
    f = H.HistoryFilter(date_from=dt.date(2024, 1, 10), date_to=dt.date(2024, 1, 20))
    plan = H.filtered(views.run_history(tables_mid), f)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_log_line_and_outcome_classification(tables_mid):
    c = {r.outcome: r["count"] for r in progress.classify_lines(views.log_lines(tables_mid))
         .groupBy("outcome").count().collect()}
    assert c == {"completed": 3334, "failed": 1667, "starting": 3333, None: 1666}
    o = {r.success: r["count"] for r in progress.classify_outcomes(views.job_outcome(tables_mid))
         .groupBy("success").count().collect()}
    assert o == {True: 7000, False: 8000}


def test_progress_rollup_shape(tables_mid):
    r = progress.rollup(views.task_state(tables_mid), dt.datetime(2001, 8, 2))
    rows = r.collect()
    assert len(rows) == 1500
    assert sum(1 for x in rows if x.running) == 534
    assert {x.final_status for x in rows if not x.running} == {"completed", "pending", "failed", "done"}
    assert all(0 <= x.progress <= 95 for x in rows)


def test_upsert_expected_status_counts(spark, tables_mid):
    df = monitoring_query(spark, "upsert_orders", "/root/testdata/sf0.01")
    got = {r.o_orderstatus: r["count"] for r in df.groupBy("o_orderstatus").count().collect()}
    assert got == {"F": 4451, "O": 4483, "P": 4566, "U": 750, "V": 750, "N": 300}


def monitoring_query(spark, name, sf):
    from sluice.catalog import all_queries
    return all_queries()[name](spark, sf)


def test_json_quarantine_counts(tables_mid):
    v = {r.valid: r["count"] for r in quality.json_validity(views.json_bodies(tables_mid)).groupBy("valid")
         .count().collect()}
    assert v == {True: 8000, False: 2000}


def test_dependency_levels_and_cycles(spark, tables_mid):
    lv = monitoring.dependency_levels(tables_mid)
    levels = {r.level: r["count"] for r in lv.groupBy("level").count().collect()}
    assert min(levels) == 0 and max(levels) == 11 and levels[0] == 286
    assert monitoring.dependency_edges(tables_mid).count() == 1714
    jobs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "job long")
    edges = spark.createDataFrame([(2, 1), (3, 4), (4, 3)], "job long, dep long")
    out = {r.job: r.level for r in lineage.dependency_levels(jobs, edges).collect()}
    assert out == {1: 0, 2: 1, 3: None, 4: None}


def test_path_tree_and_collation(tables_mid):
    pt = quality.path_tree(tables_mid.pages.select("url"))
    assert pt.select("folder").distinct().count() == 178 and pt.count() == 250
    html = quality.path_tree(tables_mid.pages.select("url"), suffix=".html")
    assert html.count() == 35
    assert quality.collated_counts(views.collation_input(tables_mid), "seg").count() == 5


def test_stream_restart_reads_nothing_new(spark, tables_small):
    root = work_path(spark, "t-stream")
    o = tables_small.orders.select(*views.ORDER_COLS)
    o.write.parquet(f"{root}/in/b1")
    sink, ckpt = f"{root}/sink", f"{root}/ckpt"
    streams.incremental_load(spark, f"{root}/in/*", o.schema, sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    streams.incremental_load(spark, f"{root}/in/*", o.schema, sink, ckpt)
    assert spark.read.parquet(sink).count() == n1 == o.count()


def test_history_page_ties_broken_by_id(spark):
    rows = [(i, "incremental", "Incremental", dt.datetime(2024, 1, 1), None, None, None, "completed", None,
             dt.datetime(2024, 1, 1, 12)) for i in range(1, 8)]
    h = spark.createDataFrame(rows, "id long, action string, pipeline_type string, start_time timestamp_ntz, "
                                    "end_time timestamp_ntz, duration_seconds decimal(10,2), success boolean, "
                                    "status string, result string, created_at timestamp_ntz")
    page2 = H.history_page(h, H.HistoryFilter(), page=2, per_page=3).collect()
    assert [r.id for r in page2] == [4, 3, 2]
    assert page2[0].start_time == "2024-01-01T00:00:00" and page2[0].end_time is None
    pc = H.history_page_count(h, H.HistoryFilter(), per_page=3).first()
    assert (pc.total, pc.pages) == (7, 3)


def test_keyset_pages_match_offset_pages(tables_mid):
    h = views.run_history(tables_mid)
    f = H.HistoryFilter.from_status_filter("completed")
    cursor, seen = None, []
    for page in range(1, 4):
        keyset = H.history_page_after(h, f, cursor, per_page=25).collect()
        offset = H.history_page(h, f, page=page, per_page=25).collect()
        assert [r.id for r in keyset] == [r.id for r in offset]
        cursor = (keyset[-1].created_at, keyset[-1].id)
        seen += [r.id for r in keyset]
    assert len(set(seen)) == 75


def test_quarantine_split_partitions_rows(tables_mid):
    good, bad = quality.quarantine_split(views.json_bodies(tables_mid))
    assert good.count() == 8000 and bad.count() == 2000
    assert good.columns == bad.columns == ["id", "body"]
    assert good.join(bad, "id").count() == 0


def test_status_count_stream_restarts_from_state(spark, tables_small):
    from sluice.operators.storage import VersionedTable
    root = work_path(spark, "t-status")
    ts = views.task_state(tables_small)
    first, second = ts.where("task_id < 700"), ts.where("task_id >= 700")
    first.write.parquet(f"{root}/in/b1")
    target = VersionedTable(spark, f"{root}/target")
    streams.status_count_stream(spark, f"{root}/in/*", ts.schema, target, f"{root}/ckpt")
    assert sum(r.tasks for r in target.read().collect()) == first.count()
    second.write.parquet(f"{root}/in/b2")
    streams.status_count_stream(spark, f"{root}/in/*", ts.schema, target, f"{root}/ckpt")
    got = {r.status: r.tasks for r in target.read().collect()}
    want = {r.status: r["count"] for r in ts.groupBy("status").count().collect()}
    assert got == want
