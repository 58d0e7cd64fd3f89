"""Flattened and summary tables kept up to date from changed rows alone.

Patients and encounters are stored in buckets of the patient's key, so all that a
derived row needs lies in one bucket.  A change names its buckets: that of the
patient, and for an encounter those of its patient before and after.  ``apply``
reads and rewrites these buckets only, and derives their flattened rows, patient
summaries and location partials anew from them.  Sums and counts of what was
there before need no inverse this way, and neither do minima, maxima and distinct
counts.  A location's summary adds up the partials, a row a bucket and location.

An encounter's bucket before the change comes from an index of its key (range
buckets of ``o_orderkey``), which is as wide as two keys.

An ``apply`` that fails at any step changes no row that a later one would not
mend.  The buckets that it is about to touch are noted first, and the next
``apply`` derives these too; the index has an encounter's old and new patient
until the end.  Applying the same change again gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluice.operators.sinks import hash_bucket, range_bucket
from sluice.operators.storage import BucketedTable, VersionedTable
from sluice.operators.upsert import latest_per_key, merge_replace
from sluice.plans import flatten, summary

PATIENT = "c_custkey"
ENCOUNTER = "o_orderkey"
OF_PATIENT = "o_custkey"
BUCKET = BucketedTable.BUCKET


class _Source:
    """What the plans read as tables: stored patients and encounters, and the dimensions as they are."""

    def __init__(self, spark: SparkSession, customer: DataFrame, orders: DataFrame, dimensions: dict[str, DataFrame]):
        self.spark = spark
        self.customer = customer
        self.orders = orders
        self.nation = dimensions["nation"]
        self.region = dimensions["region"]


class MaintainedTables:
    """Flattened encounters, patient and location summaries under ``root``.

    ``buckets`` divide the patients (about 10^6 of them each, thousands of buckets at
    most); ``index_width`` is the range of encounter keys in a bucket of the index.
    """

    def __init__(self, spark: SparkSession, root: str, dimensions: dict[str, DataFrame], buckets: int = 64, index_width: int = 1_000_000):
        self.spark = spark
        self.dimensions = dimensions

        def stored(name: str, column: str) -> BucketedTable:
            return BucketedTable(spark, f"{root}/{name}", hash_bucket([column], buckets))

        self.patients = stored("patients", PATIENT)
        self.encounters = stored("encounters", OF_PATIENT)
        self.index = BucketedTable(spark, f"{root}/index", range_bucket(ENCOUNTER, index_width))
        # A hash of the patient's key, of whichever name, is the same bucket in each.
        self.derived: dict[str, tuple[BucketedTable, Callable[[_Source], DataFrame]]] = {
            "flattened": (stored("flattened", PATIENT), flatten.flattened_patient_encounters),
            "patient_summary": (stored("patient_summary", PATIENT), summary.patient_summary),
        }
        self.partials = BucketedTable(spark, f"{root}/location_partials", lambda df: F.col(BUCKET))
        self.pending = VersionedTable(spark, f"{root}/pending", StructType([StructField(BUCKET, LongType())]))

    def build(self, patients: DataFrame, encounters: DataFrame) -> None:
        """Everything from whole tables; the stored columns are those given here."""
        self.patients.refresh(self.patients.with_bucket(patients))
        self.encounters.refresh(self.encounters.with_bucket(encounters))
        self.index.refresh(self.index.with_bucket(encounters.select(ENCOUNTER, OF_PATIENT)))
        self._derive(None)
        self.pending.commit(self.pending.read(0))

    def _derive(self, touched: DataFrame | None) -> None:
        """Derived rows of the touched buckets, or of all."""
        source = _Source(self.spark, self.patients.read(touched), self.encounters.read(touched).drop(BUCKET), self.dimensions)
        outputs = [(table, table.with_bucket(plan(source))) for table, plan in self.derived.values()]
        outputs.append((self.partials, summary.nation_partials(source, [BUCKET])))
        for table, rows in outputs:
            if touched is None:
                table.refresh(rows)
            else:
                table.replace(rows, touched)

    def apply(self, encounters: DataFrame | None = None, patients: DataFrame | None = None, order: list[str] | None = None) -> int:
        """Insert or update by key (the last row by ``order`` wins, by the whole row without it); returns the number
        of patient buckets that were rewritten.

        Rows without a key match nothing and are not stored.  No rows: nothing is read, written or committed,
        unless an earlier ``apply`` did not finish.
        """
        def latest(df: DataFrame | None, table: BucketedTable, key: str) -> DataFrame:
            stored = [c for c in table.read().columns if c != BUCKET]
            if df is None:
                return self.spark.createDataFrame([], table.read().select(*stored).schema)
            rows = latest_per_key(df.where(F.col(key).isNotNull()), [key], order or [])
            return rows.select(*stored).checkpoint(eager=True)  # read several times below

        changed = latest(encounters, self.encounters, ENCOUNTER)
        people = latest(patients, self.patients, PATIENT)
        moved = self.index.with_bucket(changed.select(ENCOUNTER, OF_PATIENT)).checkpoint(eager=True)
        ranges = moved.select(BUCKET).distinct()
        listed = self.index.read(ranges)
        before = listed.join(moved.select(ENCOUNTER), ENCOUNTER, "left_semi").select(OF_PATIENT)
        of_encounters = self.encounters.with_bucket(before.unionByName(moved.select(OF_PATIENT))).select(BUCKET)
        # At most a row a bucket.
        touched = (of_encounters.unionByName(self.patients.with_bucket(people.select(PATIENT)).select(BUCKET))
                   .unionByName(self.pending.read()).distinct().checkpoint(eager=True))
        n = touched.count()
        if n == 0:
            return 0
        self.pending.commit(touched)
        self.index.replace(listed.unionByName(moved).distinct(), ranges)

        stored = self.encounters.read(touched).join(changed.select(ENCOUNTER), ENCOUNTER, "left_anti")
        self.encounters.replace(stored.unionByName(self.encounters.with_bucket(changed)), touched)
        self.patients.replace(merge_replace(self.patients.read(touched), self.patients.with_bucket(people), [PATIENT, BUCKET]), touched)
        self._derive(touched)

        left = self.index.read(ranges).join(moved.select(ENCOUNTER), ENCOUNTER, "left_anti")
        self.index.replace(left.unionByName(moved), ranges)
        self.pending.commit(self.pending.read(0))
        return n

    def vacuum(self) -> None:
        """Delete folders that no current or last version names; call it after every few changes."""
        for table in (self.patients, self.encounters, self.index, self.partials, *[t for t, _ in self.derived.values()]):
            table.vacuum()
        self.pending.vacuum(2)

    def read(self, name: str) -> DataFrame:
        """``flattened``, ``patient_summary`` or ``location_summary``."""
        if name == "location_summary":
            dimensions = _Source(self.spark, self.patients.read(), self.encounters.read(), self.dimensions)
            return summary.by_location(dimensions, summary.merged_partials(self.partials.read()))
        return self.derived[name][0].read().drop(BUCKET)
