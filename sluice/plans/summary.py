"""Summary (aggregated) tables.

Aggregations are pushed below joins where the join key is the grouping key
(or functionally determines it): encounters are pre-aggregated per patient on
the map side before the patient join, so only one row per patient crosses the
join; a patient holding a third of all encounters is reduced by the partial
aggregate before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.sizing import broadcast_if_small
from sluice.plans.flatten import locations
from sluice.sources.tables import Tables

MONEY = "decimal(18,2)"


def money_sum(c: str):
    return F.sum(F.col(c).cast(MONEY))


def encounters_per_patient(t: Tables) -> DataFrame:
    return (t.orders.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("encounters"),
                 F.min("o_orderdate").alias("first_seen"),
                 F.max("o_orderdate").alias("last_seen"),
                 money_sum("o_totalprice").alias("total_dec"),
                 F.count_distinct("o_orderstatus").alias("statuses")))


def patient_summary(t: Tables) -> DataFrame:
    """Per patient: encounter count, first/last date, total, average, distinct statuses.
    Patients without encounters have counts of 0 and no dates or amounts."""
    agg = encounters_per_patient(t)
    return (t.customer.select("c_custkey", "c_name")
            .join(agg, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "c_name", F.coalesce("encounters", F.lit(0)).cast("bigint").alias("encounters"), "first_seen", "last_seen",
                    F.col("total_dec").cast("double").alias("total"),
                    (F.col("total_dec").cast("double") / F.col("encounters")).alias("avg_total"),
                    F.coalesce("statuses", F.lit(0)).cast("bigint").alias("statuses")))


def observation_summary(t: Tables) -> DataFrame:
    """Per part type and return flag: count, quantity sum/min/max/avg, distinct encounters."""
    part = broadcast_if_small(t.part.select("p_partkey", "p_type"))
    return (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("p_type", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("observations"),
                 money_sum("l_quantity").alias("q"),
                 F.min("l_quantity").alias("min_qty"),
                 F.max("l_quantity").alias("max_qty"),
                 F.count_distinct("l_orderkey").alias("encounters"))
            .select("p_type", "l_returnflag", "observations",
                    F.col("q").cast("double").alias("sum_qty"), "min_qty", "max_qty",
                    (F.col("q").cast("double") / F.col("observations")).alias("avg_qty"),
                    "encounters"))


def nation_partials(t: Tables, by: list[str] | None = None) -> DataFrame:
    """Per nation, and further columns of the patients: patients, encounters, spend, last encounter date.  No distinct
    count is needed, as each patient row appears once after the first aggregate."""
    by = by or []
    per_patient = encounters_per_patient(t).select("o_custkey", "encounters", "total_dec", "last_seen")
    return (t.customer.select("c_custkey", "c_nationkey", *by)
            .join(per_patient, F.col("c_custkey") == F.col("o_custkey"), "left")
            .groupBy("c_nationkey", *by)
            .agg(F.count(F.lit(1)).alias("patients"),
                 F.sum(F.coalesce("encounters", F.lit(0))).alias("encounters"),
                 F.sum("total_dec").alias("total_dec"),
                 F.max("last_seen").alias("last_seen")))


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of disjoint sets of patients as one row a nation."""
    return partials.groupBy("c_nationkey").agg(F.sum("patients").alias("patients"), F.sum("encounters").alias("encounters"),
                                               F.sum("total_dec").alias("total_dec"), F.max("last_seen").alias("last_seen"))


def by_location(t: Tables, per_nation: DataFrame) -> DataFrame:
    return (locations(t)
            .join(broadcast_if_small(per_nation), F.col("n_nationkey") == F.col("c_nationkey"), "left")
            .select("n_nationkey", "n_name", "r_name",
                    F.coalesce("patients", F.lit(0)).cast("bigint").alias("patients"),
                    F.coalesce("encounters", F.lit(0)).cast("bigint").alias("encounters"),
                    F.col("total_dec").cast("double").alias("total"),
                    "last_seen"))


def location_summary(t: Tables) -> DataFrame:
    """Per nation: patients, encounters, total spend, last encounter date.

    orders -> per-patient partial aggregate -> patient join -> per-nation
    aggregate -> 25-row location join.
    """
    return by_location(t, nation_partials(t))
