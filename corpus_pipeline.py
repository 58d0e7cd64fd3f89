"""The corpus pipeline: four stages over ``documents``, each calling one operator of ``sluice.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of their input,
which travel inside a struct, so extra columns pass through whatever their names.  Null texts count as empty.
An empty table passes every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import exact_dedup as exact
from sluice.llm import near_dedup as near
from sluice.llm import packing, toxicity
from sluice.llm.common import documents, small_batches, written
from sluice.llm.queries import WORD_BPE, toxic_model

#: Words whose ids a worker of the packing stage keeps: fewer than packing alone does, as the stages before it have
#: left their memory behind.
WORDS = 1 << 18


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold stay; repeated rows are judged alike."""
    small_batches(spark)
    judged = docs.select(F.struct("*").alias("row"), toxicity.toxicity(F.col("text"), toxic_model(spark, sf_dir)).alias("judged"))
    return judged.where(F.col("judged.score") < toxicity.THRESHOLD).select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that of the largest doc_id."""
    small_batches(spark)
    return exact.exact_dedup(docs).where("kept").select("row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest doc_id stays; rows that repeat a doc_id are one
    document, and rows without one stay."""
    small_batches(spark)
    gone = near.near_dedup(docs.select("doc_id", "text")).where("NOT kept").select(F.col("id").alias("gone")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone.hint("merge"), F.col("row.doc_id") == F.col("gone"), "left_anti").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), cache=WORDS)


STAGES = [("toxicity", toxicity_stage), ("exact dedup", exact_stage), ("near dedup", near_stage), ("packing", packing_stage)]

#: SQL expresses neither the toxicity model nor the tokenizer; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written as Parquet and read again as the next stage's ``docs``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
