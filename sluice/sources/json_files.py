"""JSON sources: data files (lists of objects, arrays or scalars) and the keyed
job catalogue (``{"tasks": {name: spec}}`` files merged in name order).

A JSON document is not splittable: one task reads one file, so a large input is
many bounded files, or JSON Lines (``lines=True``), which Spark splits.  Input
that does not parse is an error, never a row of NULLs.

Records carry their place in the input (``POSITION``), by which the last row of
a key wins where no order column is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.operators.storage import path_exists

TASK_SPEC_DDL = ("type string, dependencies array<string>, sql string, query string, target_table string, incremental_field string, source_file string, "
                 "procedure_call string, indexes array<string>, description string, "
                 "merge_key array<string>, key_collation string, file_schema string, target_schema string, source_table string, "
                 "use_stored_watermark boolean, sql_file string, positional boolean, lines boolean, "
                 "order_by array<string>, update_columns array<string>, defaults map<string, string>, "
                 "batch_size bigint, bucket_by struct<column string, width bigint, buckets bigint>")
CATALOGUE_DDL = f"tasks map<string, struct<{TASK_SPEC_DDL}>>"
CATALOGUE_TYPE = f"struct<{CATALOGUE_DDL}>"


POSITION = "__position"


def _position() -> Column:
    """Where a row stands: its file, then its place in the file."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row")).alias(POSITION)


def read_json_records(spark: SparkSession, path: str, schema: StructType, lines: bool = False,
                      position: bool = False) -> DataFrame | None:
    """Files each holding one JSON array of objects, or (``lines``) an object a line; None when the path is
    missing.  A file that does not parse fails the read."""
    if not path_exists(spark, path):
        return None
    rows = (spark.read.schema(schema).option("multiLine", not lines).option("mode", "FAILFAST")
            .option("recursiveFileLookup", True).json(path))
    return rows.select("*", _position()) if position else rows


def read_json_positional(spark: SparkSession, path: str, target: StructType, lines: bool = False,
                         position: bool = False) -> DataFrame | None:
    """Files each holding one JSON array whose elements are objects (values in
    key order), arrays (by position) or scalars (a one-column row), or such an
    element a line, bound to ``target`` by position.  Elements parse as their
    JSON text; a file that does not parse, or an element with another number of
    values than the target has columns, is an error."""
    if not path_exists(spark, path):
        return None
    text = spark.read.option("wholetext", not lines).option("recursiveFileLookup", True).text(path).select("value", _position())
    text = text.where(F.trim("value") != "")
    # An element is what its JSON says, not what its text looks like: "[1]" in quotes is a scalar.
    strict = {"mode": "FAILFAST"}
    if lines:
        whole = F.concat(F.lit("["), F.col("value"), F.lit("]"))
        elems = text.select(F.from_json(whole, "array<string>", strict)[0].alias("e"), F.from_json(whole, "array<variant>", strict)[0].alias("kind"),
                            POSITION, F.lit(0).alias("at"))
    else:
        parsed, kinds = F.from_json("value", "array<string>"), F.from_json("value", "array<variant>")
        bad = F.raise_error(F.concat(F.lit("not a JSON array: "), F.col(f"{POSITION}.file")))
        both = F.arrays_zip(F.when(parsed.isNull(), bad.cast("array<string>")).otherwise(parsed).alias("e"), kinds.alias("kind"))
        elems = text.select(F.posexplode(both).alias("at", "both"), POSITION).select("both.e", "both.kind", POSITION, "at")
    kind = F.schema_of_variant("kind")
    vals = (F.when(kind.startswith("ARRAY"), F.from_json("e", "array<string>"))
            .when(kind.startswith("OBJECT"), F.map_values(F.from_json("e", "map<string,string>")))
            .otherwise(F.array("e")))
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(target)} values: "), F.coalesce("e", F.lit("null")))).cast("array<string>")
    rows = elems.select(vals.alias("v"), "e", POSITION, "at").select(
        F.when(F.coalesce(F.size("v") == len(target), F.lit(False)), F.col("v")).otherwise(wrong).alias("v"), POSITION, "at")
    bound = [F.col("v")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(target.fields)]
    return rows.select(*bound, *[F.struct(POSITION, "at").alias(POSITION)] * position)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Merge catalogue files in path order: a later file replaces an earlier
    definition of the same task; files without ``tasks`` are ignored.

    A file that is no JSON object, is cut off, or has a field of another type than
    ``TASK_SPEC_DDL`` says, fails the read and is named; other fields are not read."""
    text = (spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), "value"))
    # FAILFAST refuses what does not parse; NULL for a whole file is another kind of JSON.
    doc = F.from_json("value", CATALOGUE_DDL, {"mode": "FAILFAST"})
    bad = F.raise_error(F.concat(F.lit("not a job catalogue: "), F.col("file")))
    kind = F.schema_of_variant(F.try_parse_json("value"))
    files = text.select("file", F.when(F.coalesce(kind.startswith("OBJECT"), F.lit(False)), doc).otherwise(bad.cast(CATALOGUE_TYPE)).alias("doc"))
    entries = files.select("file", F.explode("doc.tasks").alias("task", "spec"))
    return (entries.groupBy("task")
            .agg(F.max_by("spec", "file").alias("spec"), F.max("file").alias("file")))


# --- writers for JSON files (bounded chunks, one file per chunk) -------------

def _write_chunks(df: DataFrame, chunk: Column, element: Column, path: str, digits: int = 19) -> None:
    """Group rows into chunks and write each chunk as one JSON array file.
    ``chunk`` must bound the rows per chunk (e.g. key div N).  Its number is
    padded to the digits of the largest bigint, which never cuts it."""
    docs = (df.select(F.lpad(chunk.cast("string"), digits, "0").alias("chunk"), element.alias("e"))
            .groupBy("chunk")
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("doc")))
    docs.write.mode("overwrite").partitionBy("chunk").text(path)


def write_json_records(df: DataFrame, path: str, chunk: Column) -> None:
    _write_chunks(df, chunk, F.to_json(F.struct(*[F.col(c) for c in df.columns])), path)


def json_value_text(c: Column) -> Column:
    """JSON text of one scalar value (strings quoted and escaped)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def write_json_arrays(df: DataFrame, path: str, chunk: Column) -> None:
    elem = F.concat(F.lit("["), F.concat_ws(",", *[json_value_text(F.col(c)) for c in df.columns]), F.lit("]"))
    _write_chunks(df, chunk, elem, path)


def write_json_scalars(df: DataFrame, value_col: str, path: str, chunk: Column) -> None:
    _write_chunks(df, chunk, json_value_text(F.col(value_col)), path)
