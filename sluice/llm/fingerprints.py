"""Document fingerprints by a homomorphic multiset hash [native].

A paragraph (a line that is not blank) is hashed to a wide vector; a document's
vector is the sum of its paragraphs' vectors, each lane modulo a power of two.
Sums do not depend on order, and adding or taking away a paragraph adds or
subtracts its vector, so a fingerprint is kept up to date without the text.

``WIDE`` lanes of 32 bits, hashed from the whole paragraph, decide equality.
``SIGNS`` further lanes add +1 or -1 for every run of up to ``RUN`` words of a
paragraph, by one bit of its hash: their products estimate how many runs two
documents share, and from that their likeness (the cosine of the two counts of
runs).  Two signs are counted in one 64-bit sum, ``FIELD`` bits apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written

WIDE = 16
SIGNS = 64
FIELD = 28
_LOW = (1 << 32) - 1
#: Words of a run; a paragraph is cut into runs from its beginning.
RUN = 8
_RUNS = rf"(?:\S++\s*+){{1,{RUN}}}"
_POSITION = 33


def _lanes(paragraph: Column, run: Column, opens: Column) -> list[Column]:
    """What a run adds to the sums of its document; its paragraph's lanes come with the first run."""
    counts = opens & (F.btrim(paragraph) != "")
    a, b = F.xxhash64(paragraph), F.xxhash64(F.lit(1), paragraph)
    lanes = []
    for j in range(WIDE // 2):
        h = F.xxhash64(a, b, F.lit(j))
        lanes += [F.when(counts, x).otherwise(0) for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW)))]
    spoken = F.btrim(run) != ""
    bits = F.xxhash64(F.lit(2), F.btrim(run))
    for j in range(SIGNS // 2):
        low, high = (F.shiftrightunsigned(bits, k).bitwiseAND(F.lit(1)) for k in (j, j + SIGNS // 2))
        lanes.append(F.when(spoken, low + F.shiftleft(high, FIELD)).otherwise(0))
    return [*lanes, F.when(spoken, 1).otherwise(0)]


def fingerprint_lanes(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys``, ``wide`` (array of 32-bit lanes) and ``signs`` (array of counts of +1 less counts of -1).

    A row is read as the text of its keys: rows of equal keys are added up.  Null, empty and blank texts have
    lanes of zero.  Where the rows are already partitioned by some of the keys, nothing is shuffled.
    """
    paragraphs = df.select(*keys, F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("_paragraph"))
    runs = paragraphs.select(*keys, "_paragraph", F.posexplode_outer(F.regexp_extract_all("_paragraph", F.lit(_RUNS), 0)).alias("_at", "_run"))
    lanes = _lanes(F.col("_paragraph"), F.col("_run"), F.col("_at") == 0)
    sums = runs.groupBy(*keys).agg(*[F.sum(x).alias(f"_{j}") for j, x in enumerate(lanes)])
    n = F.col(f"_{len(lanes) - 1}")
    wide = F.array(*[F.col(f"_{j}").bitwiseAND(F.lit(_LOW)) for j in range(WIDE)])
    low = [F.col(f"_{WIDE + j}").bitwiseAND(F.lit((1 << FIELD) - 1)) for j in range(SIGNS // 2)]
    high = [F.shiftright(F.col(f"_{WIDE + j}"), FIELD) for j in range(SIGNS // 2)]
    return sums.select(*keys, wide.alias("wide"), F.array(*[(2 * x - n).cast("int") for x in [*low, *high]]).alias("signs"))


def combined(left: Column, right: Column, modulus: int | None = None, sign: int = 1) -> Column:
    """Lanes of two documents' paragraphs together (``sign`` -1: of the left without the right)."""
    both = F.zip_with(left, right, lambda x, y: x + sign * y)
    return F.transform(both, lambda x: F.pmod(x, F.lit(modulus))) if modulus else both


def as_text(wide: Column, signs: Column) -> Column:
    """Fingerprint: eight hex digits a wide lane, four a sign lane (modulo 2 ** 16)."""
    wides = F.transform(wide, lambda x: F.lpad(F.hex(x), 8, "0"))
    return F.concat(F.array_join(wides, ""), F.lit("."), F.array_join(F.transform(signs, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFF))), 4, "0")), ""))


def likeness(wide_a: Column, signs_a: Column, wide_b: Column, signs_b: Column) -> Column:
    """1 for equal fingerprints, else the estimated cosine, within 0 and 1 (0 where a document has no words)."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(signs_a, signs_a) * dot(signs_b, signs_b))
    cosine = F.when(size > 0, dot(signs_a, signs_b) / F.when(size > 0, size)).otherwise(0.0)
    return F.when((wide_a == wide_b) & (signs_a == signs_b), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def neighbours(df: DataFrame) -> DataFrame:
    """Documents (id, key, text_hash, n_chars), each once, with ``rank`` by descending id, the document before it
    in that order (the last before the first) and ``need``, half of that one's code points.

    Ranks come from a range-partitioned sort: a row's place in its partition and the partitions' sizes.
    """
    once = df.groupBy("id", "key", "text_hash").agg(F.max("n_chars").alias("n_chars"))
    laid = once.repartitionByRange(F.desc("id"), "text_hash").sortWithinPartitions(F.desc("id"), "text_hash")
    # Written once: places depend on where the sort cut the partitions.
    laid = written(laid.withColumn("place", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("place", _POSITION)
    sizes = sorted(laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    starts, total = [F.lit(-1).cast("long"), F.lit(0)], 0
    for p, n in sizes:
        starts += [F.lit(p).cast("long"), F.lit(total)]
        total += n
    rank = F.element_at(F.create_map(*starts), part).cast("long") + F.col("place").bitwiseAND(F.lit((1 << _POSITION) - 1))
    ranked = laid.select("id", "key", "text_hash", "n_chars", rank.alias("rank"))
    before = ranked.select(F.col("key").alias("to_key"), F.col("text_hash").alias("to_hash"), F.floor(F.col("n_chars") / 2).alias("need"),
                           ((F.col("rank") + 1) % max(total, 1)).alias("rank"))
    return ranked.join(before.hint("merge"), "rank").withColumn("total", F.lit(max(total, 1)).cast("long"))


def edit_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document of ``df`` once: id, ``n_chars``, ``edited_sha256``, fingerprints of the text and its edit,
    and their likeness to each other and to the next document's.

    The edit replaces the last half of a text by as many of the next document's first code points, next by
    descending id and, after the last, the first.  Null text counts as empty; null ids come last; rows that
    repeat an id with another text are documents of their own, ordered by a hash of the text, and rows that repeat
    both are one document, returned once.  Other columns are not read.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    id_ = F.col(f"`{id_col}`")
    docs = df.select(id_.alias("id"), F.xxhash64(id_).alias("key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    near = neighbours(docs.select("id", "key", "text_hash", F.char_length("text").cast("long").alias("n_chars")))
    # Texts cross a shuffle once, by their key; both uses below read that shuffle.
    own = docs.select("key", "text_hash", "text").join(near.hint("merge"), ["key", "text_hash"]).dropDuplicates(["key", "text_hash"])
    heads = own.select(F.col("to_key").alias("key"), F.col("to_hash").alias("text_hash"), F.expr("substring(text, 1, cast(need as int))").alias("head"))
    joined = own.drop("to_key", "to_hash", "need").join(heads.hint("merge"), ["key", "text_hash"])
    keys = ["id", "key", "text_hash", "rank", "total", "n_chars"]
    edited = joined.select(*keys, "text", F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"), "head").alias("edited"))
    keys.append("edited_sha256")
    both = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keys, F.explode(F.array(
        F.struct(F.lit(False).alias("edit"), F.col("text").alias("text")), F.struct(F.lit(True).alias("edit"), F.col("edited").alias("text")))).alias("v"))
    lanes = fingerprint_lanes(both.select(*keys, F.col("v.edit").alias("edit"), F.col("v.text").alias("body")), [*keys, "edit"], "body")
    pair = lanes.groupBy(*keys).agg(*[F.max(F.when(F.col("edit") == flag, F.struct("wide", "signs"))).alias(name)
                                      for name, flag in (("own", False), ("new", True))])
    pair = written(pair.select("id", "rank", "total", "n_chars", "edited_sha256", "own", "new"), "lanes")
    after = pair.select(F.pmod(F.col("rank") - 1, "total").alias("rank"), F.col("own").alias("next"))
    out = pair.join(after.hint("merge"), "rank")
    own, new, following = ((F.col(f"{c}.wide"), F.col(f"{c}.signs")) for c in ("own", "new", "next"))
    return out.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", as_text(*own).alias("fingerprint"),
                      as_text(*new).alias("edited_fingerprint"), likeness(*own, *new).alias("near_edited"),
                      likeness(*own, *following).alias("near_next"))
