"""Every registered query agrees with its DuckDB oracle (row count, column
names, order-insensitive value hash) on the sf0.001 tables."""

import pytest

from sluice.catalog import all_oracles, all_queries
from tools.oracle_check import digest, duck

from .conftest import SF_SMALL


QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_name", "encounters", "first_seen", "last_seen", "total", "avg_total",
                          "statuses"]


TZ_SENSITIVE = ["extract_incremental", "extract_parameterized", "history_date_range", "history_update",
                "history_append", "load_metadata_upsert", "progress_rollup", "watermark_advance"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert digest(df.columns, srows) == digest(dcols, res.fetchall())
