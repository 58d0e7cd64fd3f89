"""Denormalised ("flattened") tables and the core projections.

Role mapping: patient = customer, encounter = orders, observation = lineitem,
location = nation + region.  The two location dimensions are broadcast only
behind a size check; customer/orders/lineitem/part joins are left to
sort-merge (or AQE's runtime broadcast) with AQE skew-join splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.sizing import broadcast_if_small
from sluice.session import work_path
from sluice.sources.tables import Tables

FLAT_ENCOUNTER_COLS = ["c_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
                       "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"]
FLAT_OBSERVATION_COLS = FLAT_ENCOUNTER_COLS + ["l_linenumber", "l_quantity", "l_extendedprice",
                                               "l_discount", "l_returnflag", "l_shipdate",
                                               "p_name", "p_type"]


def locations(t: Tables) -> DataFrame:
    """nation + region name (25 rows; both sides tiny)."""
    region = broadcast_if_small(t.region.select("r_regionkey", "r_name"))
    return (t.nation.select("n_nationkey", "n_name", "n_regionkey")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))


def flattened_patient_encounters(t: Tables) -> DataFrame:
    """One row per encounter with patient and location attributes."""
    cust = (t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            .join(broadcast_if_small(locations(t).select("n_nationkey", "n_name", "r_name")),
                  F.col("c_nationkey") == F.col("n_nationkey")))
    enc = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    return cust.join(enc, F.col("c_custkey") == F.col("o_custkey")).select(*FLAT_ENCOUNTER_COLS)


def left_join_splittable(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> DataFrame:
    """``left ⟕ right`` written so a hot key on the right side can be split.

    AQE can split a skewed partition only on a side whose rows a join may
    duplicate freely; for a left outer join that excludes the right side, so
    one left key matching a third of the right rows would run in one task.
    As an inner join (both sides splittable) plus the left rows without a
    match (an anti join against the right's distinct keys, which a partial
    aggregate shrinks first), skew handling applies.  ``left`` is read twice:
    give a table that is cheap to read.
    """
    matched = left.join(right, F.col(lkey) == F.col(rkey))
    keys = right.select(F.col(rkey).alias("__k")).distinct()
    unmatched = left.join(keys, F.col(lkey) == F.col("__k"), "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select(*left.columns, *nulls))


def flattened_observations(t: Tables) -> DataFrame:
    """Encounters left-joined to observations and their part.

    ``lineitem ⟕ part`` is joined first (the part predicate only ever matches a
    lineitem row, so the association is exact), then attached to encounters:
    encounters without observations keep one NULL row.
    """
    part = broadcast_if_small(t.part.select("p_partkey", "p_name", "p_type"))
    obs = (t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                             "l_discount", "l_returnflag", "l_shipdate")
           .join(part, F.col("l_partkey") == F.col("p_partkey"), "left"))
    # Encounters are built once and written: both branches of the join read that table.
    path = work_path(t.spark, "flat-encounters")
    flattened_patient_encounters(t).write.parquet(path)
    return (left_join_splittable(t.spark.read.parquet(path), obs, "o_orderkey", "l_orderkey")
            .select(*FLAT_OBSERVATION_COLS))


def core_patients(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"),
                             F.col("c_nationkey").alias("location_id"), F.col("c_mktsegment").alias("segment"))


def core_encounters(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("patient_id"),
                           F.col("o_orderdate").alias("encounter_date"), F.col("o_orderstatus").alias("status"),
                           F.col("o_totalprice").alias("total"))


def core_observations(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("encounter_id"), F.col("l_linenumber").alias("line_no"),
                             F.col("l_partkey").alias("concept_id"), F.col("l_quantity").alias("value"),
                             F.col("l_returnflag").alias("flag"), F.col("l_shipdate").alias("observed_at"))


def core_locations(t: Tables) -> DataFrame:
    return locations(t).select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("location_name"),
                               F.col("r_name").alias("region_name"))
