"""Layout by several index columns; keys that a collation takes for equal."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators.layout import range_number, z_order
from sluice.operators.sinks import hash_bucket, upsert, upsert_bucketed, write_clustered
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.operators.upsert import spelled_as_stored
from sluice.plans.quality import COLLATION
from sluice.session import work_path


def files_with(table, column, low, high):
    """(files that a filter on a column cannot skip, all files), by each file's least and largest value."""
    spans = (table.read().groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b"))).collect()
    return sum(r.a <= high and r.b >= low for r in spans), len(spans)


def test_filter_on_any_index_column_skips_files(spark):
    n = 40000
    df = spark.range(n).select("id", (F.col("id") * 7919 % n).alias("x"),
                               F.concat(F.lit("s"), F.lpad((F.col("id") * 104729 % n).cast("string"), 6, "0")).alias("y"))
    t, plain = (VersionedTable(spark, work_path(spark, f"t-layout-{k}")) for k in "ab")
    assert write_clustered(t, df, ["x", "y"], files=64) == n
    write_clustered(plain, df, ["x"], files=64)
    for column, low, high in (("x", 2000, 2400), ("y", "s002000", "s002400")):
        some, every = files_with(t, column, low, high)
        assert every > 48 and some <= every / 3, (column, some, every)
    assert files_with(plain, "y", "s002000", "s002400")[0] == files_with(plain, "y", "s002000", "s002400")[1]
    assert t.read().exceptAll(df).count() == 0 and t.read().count() == n
    assert t.read().columns == df.columns


def test_ranges_are_even_whatever_the_distribution(spark):
    n = 6000
    # A third of the rows share a value, a tenth has none, and the rest is skewed.
    x = F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 10 == 1, None).otherwise(F.pow(F.col("id").cast("double"), 3))
    df = spark.range(n).select("id", x.alias("x"))
    got = df.select("x", range_number(df, "x", n, 6).alias("r")).groupBy("r").agg(
        F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).orderBy("r").collect()
    assert got[0].r == 0 and got[0].a is None
    filled = got[1:]
    assert max(r.r for r in got) < 64
    assert [r.a for r in filled] == sorted(r.a for r in filled) and all(p.b < q.a for p, q in zip(filled, filled[1:]))
    assert all(r.n <= 2 * n / 16 + 1 for r in filled if r.a != r.b)
    assert [r.n for r in filled if r.a <= 5.0 <= r.b] == [n // 3]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_place_of_times_nulls_and_empty_tables(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(i % 4, dt.datetime(2021, 11, 7, 0, 0) + dt.timedelta(minutes=30 * i) if i % 5 else None, None) for i in range(40)]
        df = spark.createDataFrame(rows, "a int, at timestamp, gone date")
        t = VersionedTable(spark, work_path(spark, "t-layout-odd"))
        write_clustered(t, df, ["a", "at", "gone"])
        assert t.read().exceptAll(df).count() == 0 and t.read().count() == 40
        none = df.where("false")
        assert none.select(z_order(none, ["a", "at"])).collect() == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    with pytest.raises(ValueError):
        z_order(df, ["a"] * 22)


def names(df):
    return sorted((r.name or "", r.v) for r in df.collect())


@pytest.mark.parametrize("bucketed", [False, True])
def test_keys_match_without_case_and_accents(spark, bucketed):
    root = work_path(spark, "t-collated")
    if bucketed:
        t = BucketedTable(spark, root, hash_bucket(["name"], 4))
        put = lambda rows: upsert_bucketed(t, rows, ["name"], ["seq"], collation=COLLATION)
    else:
        t = VersionedTable(spark, root)
        put = lambda rows: upsert(t, rows, ["name"], ["seq"], collation=COLLATION)
    ddl = "name string, v int, seq int"
    put(spark.createDataFrame([("e1", 1, 1), ("F", 2, 1), ("", 3, 1)], ddl))
    assert names(t.read()) == [("", 3), ("F", 2), ("e1", 1)]
    # É1 updates e1; a new key has its first spelling and its last values; a stored spelling stays.
    put(spark.createDataFrame([("É1", 10, 1), ("E1", 11, 2), ("ö", 20, 2), ("Ö", 19, 1), ("O", 18, 0)], ddl))
    assert names(t.read()) == [("", 3), ("F", 2), ("O", 20), ("e1", 11)]
    put(spark.createDataFrame([("f", None, 1)], ddl))
    assert sorted((r.name, r.v is None) for r in t.read().collect()) == [("", False), ("F", True), ("O", False), ("e1", False)]


def test_several_keys_and_a_hot_one(spark):
    stored = spark.createDataFrame([("Ann", 1, "x"), ("ann", 2, "y")], "name string, n int, v string")
    hot = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "ÄNN").otherwise("änn").alias("name"),
                                    F.lit(2).alias("n"), F.col("id").cast("string").alias("v"), "id")
    more = spark.createDataFrame([(None, 1, "z", 0), ("ANN", 1, "w", 0), ("bob", 1, "b", 0)], "name string, n int, v string, id long")
    got = spelled_as_stored(hot.unionByName(more), ["name", "n"], ["id"], stored, COLLATION)
    assert sorted((r.name or "", r.n, r.v) for r in got.collect()) == [("", 1, "z"), ("Ann", 1, "w"), ("ann", 2, "19999"), ("bob", 1, "b")]
