"""Driver-table access: one parquet dataset per table name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Lazy parquet readers: ``Tables(spark, dir).orders`` is a DataFrame.

    Reads are lazy, so a later ``select``/``where`` prunes columns and pushes
    filters into the parquet scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def get(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(name)
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.get(name)
        raise AttributeError(name)

    def register_views(self, names=TABLE_NAMES, prefix: str = "") -> None:
        for n in names:
            self.get(n).createOrReplaceTempView(prefix + n)
