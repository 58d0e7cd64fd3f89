"""Exact dedup by distributed MSD radix partitioning.

Texts are split by successive digits, most significant first: the first digit
is the byte length with the first ``first_digit`` bytes, later digits are ever
wider runs of the following bytes.  A group that a digit leaves with one row is
done; so is a group whose texts have ended, and its rows are equal byte by
byte.  Only the rows of unfinished groups, with the bytes not yet seen, are
written and read by the next round.  Equality comes from the digits alone;
there is no digest.

A round counts each (group, digit) with partial aggregation, so a group of
copies that holds a third of all rows crosses the shuffle as one row per task;
joining the counts back is a plain join that adaptive execution splits when it
is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, written

#: Bytes of the first digit; each later digit ends at GROWTH times the depth of the one before, so a text of
#: n bytes takes about log(n / FIRST_DIGIT) / log(GROWTH) rounds.
FIRST_DIGIT = 64
GROWTH = 16


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None,
                first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """Every row of ``df`` once, as ``row`` (a struct of ``columns``, all by default), ``keep_id``,
    ``group_size`` and ``kept``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the row with
    the largest id stays (null ids are smallest); where rows repeat that id too, exactly one of them stays.
    The input's columns travel inside a struct, so no name can clash.  An empty table gives no rows.
    """
    columns = df.columns if columns is None else columns
    with_text = text_col in columns
    carried = [c for c in columns if c != text_col]
    state = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carried]).alias("carried"),
                      F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    body = F.encode(ascii_lower(F.coalesce("text", F.lit(""))), "UTF-8")
    state = state.withColumn("grp", F.octet_length(body).cast("long"))
    result, depth, start = None, first_digit, 0
    while True:
        first = start == 0
        keyed = state.withColumn("digit", F.substring(body, start + 1, depth - start))
        counts = [F.count(F.lit(1)).alias("n")]
        if not first:
            counts += [F.max(F.struct("id", "rid")).alias("keep"), F.max(F.col("bytes") <= depth).alias("ended")]
        # A group's number is drawn once and written, so that all rows and retries see the same one.
        groups = written(keyed.groupBy("grp", "digit").agg(*counts).where("n > 1")
                         .withColumn("next_grp", F.monotonically_increasing_id()), "radix-groups")
        # Always by a shuffle, which adaptive execution splits where it is skewed: the groups grow with the data.
        joined = keyed.join(groups.hint("merge"), ["grp", "digit"], "left")
        # Copies found by the first digit always see a second one: by then the write has fixed their row ids.
        over = F.col("n").isNull() if first else F.col("n").isNull() | F.col("ended")
        chosen = [F.col("id"), F.lit(True)] if first else [
            F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep.id")),
            F.col("n").isNull() | (F.col("keep.rid") == F.col("rid"))]
        left = Observation()
        out = written(joined.select(
            "carried", "id", (F.col("text") if with_text else F.when(~over, F.col("text"))).alias("text"),
            (F.octet_length(body).cast("long") if first else F.col("bytes")).alias("bytes"),
            (F.monotonically_increasing_id() if first else F.col("rid")).alias("rid"),
            F.coalesce("next_grp", F.lit(-1)).alias("grp"), over.alias("over"), chosen[0].alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), chosen[1].alias("kept"),
        ).observe(left, F.count(F.when(~F.col("over"), 1)).alias("n")), "radix")
        row = F.struct(*[(F.col("text") if c == text_col else F.col(f"carried.`{c}`")).alias(c) for c in columns])
        part = out.where("over").select(row.alias("row"), "keep_id", "group_size", "kept")
        result = part if result is None else result.unionByName(part)
        if not left.get["n"]:
            return result
        state = out.where("NOT over").select("carried", "id", "text", "bytes", "rid", "grp")
        start, depth = depth, depth * growth
