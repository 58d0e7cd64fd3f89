"""Repeated runs, strict input, safe bucketed targets, failures and run history."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import metadata as md
from sluice.operators.jobs import Workspace, run_catalogue, run_job
from sluice.operators.sinks import range_bucket, upsert_bucketed, write_clustered
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.plans.lineage import dependency_levels
from sluice.session import work_path
from sluice.sources.json_files import read_catalogue

NOW = dt.datetime(2001, 8, 2)


def workspace(spark, label):
    return Workspace(spark, work_path(spark, label), NOW)


def catalogue(ws, tasks):
    folder = f"{ws.root}/catalogue".removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/1.json", "w") as f:
        json.dump({"tasks": tasks}, f)
    return read_catalogue(ws.spark, folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("kind,values", [("bigint", ["1", "2", "3"]), ("date", ["2001-01-01", "2001-01-02", "2001-01-03"])])
def test_incremental_runs_go_on_from_a_watermark_of_any_type(spark, kind, values):
    ws = workspace(spark, "t-marks")
    feed = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast(kind).alias("at"))
    cat = catalogue(ws, {"Load": {"type": "extract_load", "query": "SELECT * FROM feed", "target_table": "t",
                                  "incremental_field": "at"}})
    feed.where(F.col("at") < F.lit(values[1]).cast(kind)).createOrReplaceTempView("feed")
    assert [r.rows for r in run_catalogue(ws, cat, "full")] == [1]
    assert [r.status for r in run_catalogue(ws, cat, "incremental")] == ["no_data"]
    feed.createOrReplaceTempView("feed")
    assert [r.rows for r in run_catalogue(ws, cat, "incremental")] == [2]
    assert [r.status for r in run_catalogue(ws, cat, "incremental")] == ["no_data"]
    assert rows(ws.target("t").read()) == rows(feed)  # appended without a merge key, each once
    assert ws.watermarks.read().first().last_processed_value == values[2]


def test_truncated_json_and_wrong_arity_fail(spark):
    ws = workspace(spark, "t-bad")
    folder = f"{ws.root}/in".removeprefix("file:")
    spec = {"type": "load", "source_file": folder, "target_table": "t", "file_schema": "a int, b string"}
    os.makedirs(folder)
    for text in ('[{"a": 1, "b": "x"}, {"a": 2', '[[1, "x", "EXTRA"]]', "[[1]]"):
        with open(f"{folder}/f.json", "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            run_job(ws, "L", {**spec, "positional": text.startswith("[[")})
        assert ws.target("t").current_version() == 0
        assert {r.table_name: r.status for r in ws.meta.read().collect()} == {"L": "failed"}


def test_json_lines_load_appends_and_last_row_of_a_key_wins(spark):
    ws = workspace(spark, "t-lines")
    folder = f"{ws.root}/in".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/f.json", "w") as f:
        f.write('{"a": 1, "b": "old"}\n{"a": 2, "b": "x"}\n{"a": 1, "b": "new"}\n')
    spec = {"type": "load", "source_file": folder, "target_table": "t", "file_schema": "a int, b string", "lines": True}
    run_job(ws, "L", spec)
    run_job(ws, "L", spec)
    assert ws.target("t").read().count() == 6  # a load adds in full mode too
    keyed = {**spec, "target_table": "k", "merge_key": ["a"]}
    run_job(ws, "K", keyed)
    run_job(ws, "K", keyed)
    assert rows(ws.target("k").read()) == [(1, "new"), (2, "x")]


def test_bucketed_refresh_null_keys_and_failed_write(spark):
    t = BucketedTable(spark, work_path(spark, "t-safe"), range_bucket("k", 10))
    t.refresh(t.with_bucket(spark.createDataFrame([(None, "n1"), (None, "n2"), (1, "a"), (25, "b")], "k int, v string")))
    upsert_bucketed(t, spark.createDataFrame([(None, "n3"), (1, "A")], "k int, v string"), ["k"])
    got = sorted((str(r.k), r.v) for r in t.read().collect())
    assert got == [("1", "A"), ("25", "b"), ("None", "n1"), ("None", "n2"), ("None", "n3")]
    before = t.manifest.current_version()
    bad = t.with_bucket(spark.createDataFrame([(1, "x")], "k int, v string")).withColumn(
        "v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        t.replace(bad, bad.select("bucket").distinct())
    assert t.manifest.current_version() == before and sorted((str(r.k), r.v) for r in t.read().collect()) == got
    t.refresh(t.with_bucket(spark.createDataFrame([(25, "z")], "k int, v string")))
    assert [(r.k, r.v) for r in t.read().collect()] == [(25, "z")]
    assert t.vacuum(retain=1) == [1, 2]


def test_files_of_a_bucketed_write_do_not_multiply(spark):
    t = BucketedTable(spark, work_path(spark, "t-files"), range_bucket("id", 1000))
    t.refresh(t.with_bucket(spark.range(10_000).repartition(8)))
    files = [f for _, _, names in os.walk(t.root.removeprefix("file:") + "/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 10


def test_failing_job_blocks_only_its_dependants_and_is_retried(spark):
    ws = workspace(spark, "t-fail")
    load = {"type": "extract_load", "query": "SELECT 1 AS a"}
    cat = catalogue(ws, {"Bad": {**load, "query": "SELECT * FROM not_there_yet", "target_table": "bad"},
                         "Child": {**load, "target_table": "child", "dependencies": ["Bad"]},
                         "Other": {**load, "target_table": "other"}})
    assert {r.job: r.status for r in run_catalogue(ws, cat, "full")} == {"Bad": "failed", "Child": "blocked", "Other": "completed"}
    failed = ws.meta.read().where("status = 'failed'").collect()
    assert [r.table_name for r in failed] == ["Bad"] and "not_there_yet" in failed[0].error_message
    spark.range(1).createOrReplaceTempView("not_there_yet")
    assert {r.job: r.status for r in run_catalogue(ws, cat, "full")} == {"Bad": "completed", "Child": "completed"}
    assert ws.meta.read().where("status = 'failed'").count() == 0
    history = ws.history.read().orderBy("id").collect()
    assert [(r.id, r.action, r.status, r.success) for r in history] == [(1, "full_refresh", "failed", False), (2, "full_refresh", "completed", True)]


def test_levels_have_no_depth_cap_and_cycles_are_null(spark):
    jobs = spark.createDataFrame([(i,) for i in range(25)], "job int")
    chain = [(i, i - 1) for i in range(1, 20)] + [(21, 22), (22, 21), (23, 22)]
    got = {r.job: r.level for r in dependency_levels(jobs, spark.createDataFrame(chain, "job int, dep int")).collect()}
    assert got == {**{i: i for i in range(20)}, 20: 0, 24: 0, 21: None, 22: None, 23: None}


def test_counts_beyond_an_int_are_recorded(spark):
    counts = spark.createDataFrame([("t", 3_000_000_000)], "table_name string, record_count bigint")
    out = md.load_metadata_upsert(spark.createDataFrame([], md.META_SCHEMA), counts, NOW)
    assert out.first().record_count == 3_000_000_000


def test_clustered_layout_splits_a_hot_value(spark):
    t = VersionedTable(spark, work_path(spark, "t-hot"))
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(t, df, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in t.read().groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8


def test_default_root_is_the_same_for_every_run(spark):
    from sluice.run import default_root
    assert default_root(spark, "/jobs/a/") == default_root(spark, "/jobs/a") != default_root(spark, "/jobs/b")
