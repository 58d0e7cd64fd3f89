"""Line dedup over a range-partitioned, sorted table of line hashes [native].

Every line long enough to count gives a row (hash, document, position); no text
leaves the scan.  These rows are written once: the range boundaries, the range
shuffle and the join back all read them, and the lines are not split again.  The
rows are range-partitioned by hash and sorted by document, largest first, and
position, so the first row of a hash is where the line stays and a change of
document is seen from one row to the next.  A line that a third of all documents
hold would be one key: a slice number, a hash of the document, follows the hash
in the range key, so such a line spreads over ``SLICES`` runs.  Runs are streamed
one by one; only what each found (documents, largest of them) is added up by hash.

The result is a bitmap of kept lines per document, as the 64-bit words up to the
last one that drops a line; words beyond it, and missing bitmaps, keep all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, written

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
SLICES = 256
#: Stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                 least_documents: int = LEAST_DOCUMENTS, slices: int = SLICES) -> DataFrame:
    """``id``, ``text_hash``, ``n_dropped`` and ``keep`` (array of 64-bit words, bit i of word w is line 64 * w + i)
    for every document that loses a line.

    A key of at least ``least_chars`` code points found in at least ``least_documents`` documents loses all its
    lines but those of the largest id that holds it.  Rows that repeat an id count as one document, and so do rows
    of null id, which is smallest; their texts have bitmaps of their own.  Null or empty text is one empty line.  Other columns are not read.  An empty table
    gives no rows.  Keys are told apart by 128 bits of hash.
    """
    text = F.col(f"`{text_col}`")
    found = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(lines_of(text)).alias("pos", "line"))
    found = found.select("id", "text_hash", "pos", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    rows = found.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                        F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"), "id", "text_hash", "pos")
    rows = written(rows, "line-rows")
    at = ["h1", "h2", "slice"]
    order = [F.desc("id"), F.col("pos")]
    laid = rows.repartitionByRange(*at).sortWithinPartitions(*at, *order)
    run = Window.partitionBy(*at).orderBy(*order)
    # A document's lines of one key lie together: it begins where the row before is of another.
    begins = (F.row_number().over(run) == 1) | ~F.lag("id").over(run).eqNullSafe(F.col("id"))
    runs = laid.withColumn("begins", begins).groupBy(*at).agg(F.sum(F.col("begins").cast("long")).alias("n"), F.max("id").alias("keep"))
    # At most ``slices`` runs a hash.
    whole = Window.partitionBy("h1", "h2")
    common = (runs.withColumn("docs", F.sum("n").over(whole)).withColumn("keep", F.max("keep").over(whole))
              .where(F.col("docs") >= least_documents).select(*at, "keep"))
    dropped = rows.join(common.hint("merge"), at).where(~F.col("id").eqNullSafe(F.col("keep")))
    words = dropped.groupBy("id", "text_hash", F.expr("pos div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    maps = words.groupBy("id", "text_hash").agg(F.sum(F.bit_count("bits")).alias("n_dropped"), F.max("word").alias("last"),
                                                F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("words"))
    return maps.select("id", "text_hash", "n_dropped", F.expr("transform(sequence(0L, last), w -> coalesce(try_element_at(words, w), -1L))").alias("keep"))


def drop_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """Every row of ``df`` once: id, ``n_lines`` before, ``n_dropped`` and ``kept_text``, by ``line_bitmaps``."""
    bitmaps = line_bitmaps(df, id_col, text_col, **limits)
    docs = df.select(F.col(f"`{id_col}`").alias("own"), F.col(f"`{text_col}`").alias("text"))
    joined = docs.withColumn("own_hash", F.xxhash64("text")).join(
        bitmaps.hint("merge"), F.col("own").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    kept = F.expr("filter(split(coalesce(text, ''), '\\n', -1), (line, i) -> (shiftright(coalesce(get(keep, cast(i div 64 as int)), -1L), i % 64) & 1L) = 1L)")
    return joined.select(F.col("own").alias(id_col), F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                         F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
