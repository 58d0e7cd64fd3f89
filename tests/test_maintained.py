"""Derived tables kept up to date from changed rows equal those built anew."""

import datetime as dt

import pytest

from sluice.operators.maintained import BUCKET, MaintainedTables
from sluice.operators.storage import BucketedTable
from sluice.plans import flatten, summary
from sluice.session import work_path

PEOPLE = "c_custkey long, c_name string, c_mktsegment string, c_nationkey long"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"


def day(n):
    return dt.datetime(2001, 1, 1) + dt.timedelta(days=n)


def people(n=40):
    return {i: (i, f"p{i}", "S", i % 3) for i in range(n)}


def encounters(n=200):
    # Patient 0 has a third of all.
    return {k: (k, 0 if k % 3 == 0 else k % 40, "OF"[k % 2], float(k), day(k)) for k in range(n)}


@pytest.fixture
def dimensions(spark):
    return {"region": spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string"),
            "nation": spark.createDataFrame([(i, f"n{i}", 0) for i in range(4)], "n_nationkey long, n_name string, n_regionkey long")}


def frames(spark, who, what):
    return spark.createDataFrame(list(who), PEOPLE), spark.createDataFrame(list(what), ORDERS)


def rows(df):
    return sorted(map(repr, df.collect()))


def equals_rebuilt(spark, tables, who, what):
    class Whole:
        customer, orders = frames(spark, who.values(), what.values())
        nation, region = tables.dimensions["nation"], tables.dimensions["region"]

    for name, plan in (("flattened", flatten.flattened_patient_encounters), ("patient_summary", summary.patient_summary),
                       ("location_summary", summary.location_summary)):
        assert rows(tables.read(name)) == rows(plan(Whole)), name


def built(spark, dimensions, who, what, label):
    tables = MaintainedTables(spark, work_path(spark, label), dimensions, buckets=8, index_width=50)
    tables.build(*frames(spark, who.values(), what.values()))
    return tables


def test_changes_equal_a_rebuild(spark, dimensions):
    who, what = people(), encounters()
    tables = built(spark, dimensions, who, what, "t-maintained")
    equals_rebuilt(spark, tables, who, what)
    change = {199: (199, 5, "P", 1.0, day(-9)),   # its patient's latest date goes, another's earliest comes
              3: (3, 7, "O", None, None),         # nulls overwrite
              500: (500, 39, "F", 2.5, day(1)),   # new
              501: (501, None, "F", 2.5, day(1)),  # of no patient
              502: (502, 777, "F", 9.0, day(2))}  # of a patient who comes later
    moved = {0: (0, "p0 anew", "T", 3), 100: (100, "new", "S", None)}
    new_people, _ = frames(spark, moved.values(), [])
    _, new_rows = frames(spark, [], change.values())
    assert tables.apply(new_rows, new_people) > 0
    who, what = who | moved, what | change
    equals_rebuilt(spark, tables, who, what)
    # The orphans' patient comes, and an encounter goes back.
    back = {3: (3, 0, "O", 1.0, day(3)), 501: (501, 1, "F", 1.0, day(1))}
    late = {777: (777, "late", "S", 1)}
    tables.apply(frames(spark, [], back.values())[1], frames(spark, late.values(), [])[0])
    equals_rebuilt(spark, tables, who | late, what | back)


def test_the_same_change_again_and_no_change(spark, dimensions):
    who, what = people(), encounters()
    tables = built(spark, dimensions, who, what, "t-maintained-again")
    change = {10: (10, 11, "P", 1.0, day(0)), 12: (12, 13, "P", 1.0, day(0))}
    _, delta = frames(spark, [], change.values())
    tables.apply(delta)
    tables.apply(delta)
    equals_rebuilt(spark, tables, who, what | change)
    version = tables.encounters.manifest.current_version()
    nobody, nothing = frames(spark, [], [])
    assert tables.apply(nothing, nobody) == 0 and tables.apply() == 0
    assert tables.apply(frames(spark, [], [(None, 1, "O", 1.0, day(0))])[1]) == 0
    assert tables.encounters.manifest.current_version() == version


def test_only_touched_buckets_are_written_and_read(spark, dimensions):
    tables = built(spark, dimensions, people(), encounters(), "t-maintained-touched")

    def generations(table):
        return {r[BUCKET]: r.generation for r in table.manifest.read().collect()}

    before = {name: generations(t) for name, t in (("flattened", tables.derived["flattened"][0]), ("base", tables.encounters))}
    _, delta = frames(spark, [], [(1, 2, "P", 1.0, day(0))])  # from patient 1 to 2
    n = tables.apply(delta)
    assert 1 <= n <= 2
    for name, table in (("flattened", tables.derived["flattened"][0]), ("base", tables.encounters)):
        after = generations(table)
        assert sum(after[b] != g for b, g in before[name].items()) <= n < len(after)
    touched = tables.encounters.with_bucket(delta).select(BUCKET).distinct()
    files = tables.encounters.read(touched).inputFiles()
    assert files and len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1


@pytest.mark.parametrize("fails_at", [3, 7])  # encounters are written, patients are not; all but the index
def test_a_failed_change_is_mended_by_the_next(spark, dimensions, monkeypatch, fails_at):
    who, what = people(), encounters()
    tables = built(spark, dimensions, who, what, f"t-maintained-fails-{fails_at}")
    first = {10: (10, 11, "P", 1.0, day(0)), 199: (199, 5, "P", 1.0, day(-9))}
    write, calls = BucketedTable.replace, []

    def failing(self, *args):
        calls.append(1)
        if len(calls) == fails_at:
            raise RuntimeError("lost")
        return write(self, *args)

    monkeypatch.setattr(BucketedTable, "replace", failing)
    _, delta = frames(spark, [], first.values())
    with pytest.raises(RuntimeError):
        tables.apply(delta)
    monkeypatch.undo()
    # Another change first, of one of its encounters and of another; the failed one again after it.
    second = {10: (10, 30, "F", 2.0, day(4)), 20: (20, 21, "F", 2.0, day(4))}
    tables.apply(frames(spark, [], second.values())[1])
    stored = {r[0]: tuple(r) for r in tables.encounters.read().select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").collect()}
    assert len(stored) == len(what) == tables.encounters.read().count()
    equals_rebuilt(spark, tables, who, stored)
    tables.apply(delta)
    tables.vacuum()
    equals_rebuilt(spark, tables, who, what | second | first)
