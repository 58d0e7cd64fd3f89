"""No row twice, none lost: retries, watermarks, idle and empty runs, bounded batches; strict JSON; closure."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from sluice.operators.batches import batch_bounds
from sluice.operators.jobs import run_catalogue, run_job
from sluice.operators.storage import VersionedTable
from sluice.plans.lineage import dependency_closure, dependency_cycles
from sluice.plans.loads import Interrupted, interrupted
from sluice.session import work_path
from sluice.sources.json_files import read_catalogue, read_json_positional

from .test_reruns import catalogue, rows, workspace

APPEND = {"type": "extract_load", "query": "SELECT * FROM feed", "target_table": "t", "incremental_field": "at", "source_table": "feed"}


def feed(spark, values, kind="bigint"):
    spark.createDataFrame([(v,) for v in values], f"at {kind}").createOrReplaceTempView("feed")


@pytest.mark.parametrize("bucketed", [False, True])
@pytest.mark.parametrize("step", ["record_load", "_complete", "_advance"])
def test_append_interrupted_at_any_step(spark, step, bucketed):
    ws = workspace(spark, "t-once")
    spec = {**APPEND, "bucket_by": {"column": "at", "width": 2}} if bucketed else APPEND
    feed(spark, [1, 2])
    interrupted(ws, step, "Load", spec, mode="incremental")
    feed(spark, [1, 2, 3])  # rows may have come since
    interrupted(ws, step, "Load", spec, mode="incremental")
    run_job(ws, "Load", spec, "incremental")
    assert rows(ws.read_target(spec).select("at")) == [(1,), (2,), (3,)]
    feed(spark, [1, 2, 3, 4])
    run_job(ws, "Load", spec, "incremental")
    assert run_job(ws, "Load", spec, "incremental").status == "no_data"
    assert rows(ws.read_target(spec).select("at")) == [(1,), (2,), (3,), (4,)]
    assert ws.watermarks.read().first().last_processed_value == "4"


def test_level_interrupted_before_its_state_is_written(spark):
    ws = workspace(spark, "t-level")
    cat = catalogue(ws, {"Load": APPEND, "Other": {**APPEND, "target_table": "u"}})
    feed(spark, [1, 2])

    def stop(done):
        raise Interrupted

    ws._complete = stop
    with pytest.raises(Interrupted):
        run_catalogue(ws, cat, "incremental", workers=2)
    del ws._complete
    run_catalogue(ws, cat, "incremental", workers=2)
    run_catalogue(ws, cat, "incremental")
    assert rows(ws.target("t").read()) == rows(ws.target("u").read()) == [(1,), (2,)]


def test_completed_loads_append_again_and_old_folders_stay_readable(spark):
    ws = workspace(spark, "t-again")
    spec = {k: v for k, v in APPEND.items() if k != "incremental_field"}
    feed(spark, [1])
    for _ in range(4):
        run_job(ws, "Load", spec, "incremental")
    target = ws.target("t")
    assert target.read().count() == 4 and len(target.segments(target.current_version())) == 4
    assert not target.vacuum(retain=1) and target.read().count() == 4
    run_job(ws, "Load", spec, "full")
    target.vacuum(retain=1)
    assert target.read().count() == 1


def test_watermark_set_back_by_hand_stays(spark):
    ws = workspace(spark, "t-hand")
    feed(spark, [1, 2])
    run_job(ws, "Load", APPEND, "incremental")
    ws.watermarks.commit(ws.watermarks.read().withColumn("last_processed_value", F.lit("1")))
    assert run_job(ws, "Load", APPEND, "incremental").rows == 1


@pytest.mark.parametrize("host", ["America/Los_Angeles"])
@pytest.mark.parametrize("session", ["UTC", "Europe/Berlin"])
def test_points_in_time_are_loaded_once_in_any_zone(spark, host, session, monkeypatch):
    monkeypatch.setenv("TZ", host)
    time.tzset()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        ws = workspace(spark, "t-zone")
        times = ["2001-01-01 05:00:00", "2001-01-01 13:00:00.123456"]
        for zone, part in ((session, times[:1]), (session, times), ("UTC", times)):
            spark.conf.set("spark.sql.session.timeZone", zone)
            spark.createDataFrame([(v,) for v in part], "s string").select(F.concat("s", F.lit("Z")).cast("timestamp").alias("at")).createOrReplaceTempView("feed")
            run_job(ws, "Load", APPEND, "incremental")
        assert rows(ws.target("t").read().select(F.unix_micros("at"))) == [(978325200000000,), (978354000123456,)]
        assert ws.watermarks.read().first().last_processed_value == "2001-01-01T13:00:00.123456Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        monkeypatch.undo()
        time.tzset()


@pytest.mark.parametrize("bucketed", [False, True])
def test_idle_and_empty_keyed_runs_change_nothing(spark, bucketed):
    ws = workspace(spark, "t-idle")
    spec = {**APPEND, "merge_key": ["at"]} | ({"bucket_by": {"column": "at", "width": 2}} if bucketed else {})
    feed(spark, [])
    assert run_job(ws, "Load", spec, "incremental").status == "no_data"
    feed(spark, [1, 2])
    run_job(ws, "Load", spec, "incremental")

    def version():
        root = ws.target("t").root + ("/manifest" if bucketed else "")
        return VersionedTable(spark, root).current_version()

    before = version()
    assert run_job(ws, "Load", spec, "incremental").status == "no_data"
    assert version() == before and rows(ws.read_target(spec).select("at")) == [(1,), (2,)]


def test_whole_error_is_kept(spark):
    ws = workspace(spark, "t-error")
    name = "x" * 5000
    with pytest.raises(Exception):
        run_job(ws, "Bad", {"type": "extract_load", "query": f"SELECT {name} FROM range(1)", "target_table": "t"})
    assert name in ws.meta.read().first().error_message


# --- bounded batches ----------------------------------------------------------

@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_batches_are_bounded_and_whole(spark, size):
    rnd = random.Random(size)
    values = [rnd.choice([None, 1, 1, 1, 7, *range(40)]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "at int").repartition(4)
    found = batch_bounds(df, "at", size).orderBy("batch").collect()
    assert [b.batch for b in found] == list(range(len(found))) and sum(b.rows for b in found) == len(values)
    last = None
    for b in found:
        if b.low is None:
            assert b.batch == 0 and b.rows == values.count(None)
            continue
        own = [v for v in values if v is not None and int(b.low) <= v <= int(b.high)]
        assert len(own) == b.rows and (b.rows <= size or b.low == b.high) and (last is None or int(b.low) > last)
        last = int(b.high)
    # No more batches than twice as many as are needed, but for values that have one of their own.
    assert len(found) <= 2 + 4 * len(values) / size + len(set(values)) * (size < 50)
    assert batch_bounds(df.where("false"), "at", size).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "date", "string", "double"])
def test_batched_job_goes_on_with_the_batch_that_failed(spark, kind):
    ws = workspace(spark, "t-batch")
    texts = [f"2001-01-{d:02d}" for d in range(1, 10)] if kind != "double" else [str(d / 7) for d in range(1, 10)]
    spark.createDataFrame([(v,) for v in texts], "s string").select(F.col("s").cast(kind).alias("at")).createOrReplaceTempView("feed")
    spec = {**APPEND, "batch_size": 2}
    real, calls = ws.mark_done, []

    def third(*a, **k):
        calls.append(a)
        if len(calls) == 3:
            raise Interrupted
        return real(*a, **k)

    ws.mark_done = third
    with pytest.raises(Interrupted):
        run_job(ws, "Load", spec, "incremental")
    del ws.mark_done
    assert run_job(ws, "Load", spec, "incremental").rows < 9
    assert run_job(ws, "Load", spec, "incremental").status == "no_data"
    assert rows(ws.target("t").read()) == rows(spark.table("feed")) and ws.runs.read().where("rows > 0").count() >= 4


# --- strict JSON --------------------------------------------------------------

def files(spark, *texts):
    folder = work_path(spark, "t-files").removeprefix("file:")
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(text)
    return folder


@pytest.mark.parametrize("text", ['{"tasks": {"C": {"type": "lo', '{"tasks": {"C": {"dependencies": "A"}}}', '{"tasks": {"C": {"positional": "yes"}}}',
                                  "[1]", '"x"', '{"tasks": ["x"]}', '{"tasks": {"C": "x"}}'])
def test_catalogue_files_that_would_lose_jobs_fail(spark, text):
    good = '{"tasks": {"A": {"type": "load", "sql": ["s1", "s2"], "note": 5}}}'
    assert [r.task for r in read_catalogue(spark, files(spark, good, '{"version": 1}')).collect()] == ["A"]
    with pytest.raises(Exception, match="job catalogue|Malformed|MALFORMED"):
        read_catalogue(spark, files(spark, good, text)).collect()


def test_elements_are_what_their_json_says(spark):
    from pyspark.sql.types import StructType
    one = StructType.fromDDL("v string")
    got = read_json_positional(spark, files(spark, '["[1]", "[note] x", "{x", 5, null, true, ["in"], {"k": "obj"}]'), one)
    assert [r.v for r in got.collect()] == ["[1]", "[note] x", "{x", "5", None, "true", "in", "obj"]
    got = read_json_positional(spark, files(spark, '"[1]"\n"{x"\n[7]\n{"a": "b"}\n'), one, lines=True)
    assert [r.v for r in got.collect()] == ["[1]", "{x", "7", "b"]


# --- closure ------------------------------------------------------------------

def test_closure_and_cycles_against_brute_force(spark):
    rnd = random.Random(3)
    for n, m in ((12, 14), (30, 25), (8, 30)):
        edges = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)}
        reach = set(edges)
        while True:
            more = reach | {(a, d) for a, b in reach for c, d in reach if b == c}
            if more == reach:
                break
            reach = more
        closure = dependency_closure(spark.createDataFrame([*edges, *list(edges)[:3], (None, 1), (1, None)], "job long, dep long"))
        assert set(map(tuple, closure.collect())) == reach and closure.count() == len(reach)
        want = {(a, min(b for b in range(n) if (a, b) in reach and (b, a) in reach)) for a in range(n) if (a, a) in reach}
        assert set(map(tuple, dependency_cycles(closure).collect())) == want
    chain = spark.range(1, 70).select(F.col("id").alias("job"), (F.col("id") - 1).alias("dep"))
    assert dependency_closure(chain).count() == 69 * 70 // 2


def test_error_names_the_cycle(spark):
    ws = workspace(spark, "t-cycle")
    job = {"type": "summary"}
    cat = catalogue(ws, {"A": {**job, "dependencies": ["B"]}, "B": {**job, "dependencies": ["A"]}, "C": {**job, "dependencies": ["A"]},
                         "D": {**job, "dependencies": ["D"]}})
    with pytest.raises(ValueError, match="dependency cycle: A, B; D$"):
        run_catalogue(ws, cat, "full")
