"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles; its sketch the k smallest
of their hashes.  Documents of equal sets are one class, of which one goes on.

Inverted lists of the retained values generate the pairs.  Two sets as alike as
asked share at least ``LEAST`` of k retained values (with k = 64 and a
similarity of 0.75, but for a chance under 1e-7); so they also share one of the
``k - LEAST + 1`` values that fewest sketches hold, and only those are listed.  A
passage that many documents share is left out by that wherever it is less than
the allowed rest of a sketch; no list is cut off.

Lists of up to ``SMALL`` documents give their pairs.  The pair's union sketch
(the k smallest of both) estimates the similarity and drops what is far off; the
full sets decide.  Longer lists are joined to clusters, and a cluster's
documents dealt into blocks; a task takes two blocks, estimates all overlaps by
a product of their sketch incidence matrices, decides by that of their full
sets, and returns no more links than a spanning forest of the two has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import kept_in_worker, written
from sluice.llm.components import components

WORDS = 5
SKETCH = 64
#: Retained values that similar sets share at least.
LEAST = 28
#: 100 * intersection >= PERCENT * union.
PERCENT = 75
SMALL = 16
BLOCK = 1024
#: Bits of the filter that says which documents' sets are wanted: fixed, so that it can go to every task.
FILTER_BITS = 1 << 23
#: Words whose hashes a task keeps; a full cache is emptied, which costs time only.
CACHE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word).to_bytes(8, "little")
        return found


def _hashes() -> _Hashes:
    return kept_in_worker("near-dedup", _Hashes)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word; invertible."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; with fewer words, of the whole sequence."""
    # bytes.lower and bytes.split know A-Z and the ASCII blanks only, as is asked.
    own = np.frombuffer(b"".join(map(_hashes().__getitem__, (text or "").encode("utf-8", "replace").lower().split())), "<u8")
    if not len(own):
        return own
    size = min(len(own), words)
    h = np.full(len(own) - size + 1, size, np.uint64)
    for j in range(size):
        h = h * _ODD + own[j:len(own) - size + 1 + j]
    return np.unique(_mixed(h))


def _similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * inter >= PERCENT * (a + b - inter)


def may_be_similar(x: np.ndarray, y: np.ndarray, k: int = SKETCH, least: int = LEAST) -> bool:
    """Estimate by the union sketch of two sorted sketches."""
    union = np.union1d(x, y)
    if len(x) < k and len(y) < k:  # whole sets
        return bool(_similar(np.int64(len(x) + len(y) - len(union)), np.int64(len(x)), np.int64(len(y))))
    # Of the k smallest of the union, those in both are retained by both.
    last = union[:k][-1]
    both = np.searchsorted(x, last, "right") + np.searchsorted(y, last, "right") - min(k, len(union))
    return both >= least


def _sets(values: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(v, "<u8") for v in values]


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices over ``width`` values at a time."""
    def codes(sets: list[np.ndarray], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        hit = shared[at] == flat
        order = np.argsort(at[hit], kind="stable")
        return rows[hit][order], at[hit][order]

    out = np.zeros((len(left), len(right)), np.float32)
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    if not len(shared):
        return out
    (lr, lc), (rr, rc) = codes(left, shared), codes(right, shared)
    for start in range(0, len(shared), width):
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        for matrix, rows, cols in ((a, lr, lc), (b, rr, rc)):
            lo, hi = np.searchsorted(cols, (start, start + width))
            matrix[rows[lo:hi], cols[lo:hi] - start] = 1
        out += a @ b.T
    return out


def _block_links(rows: pd.DataFrame, k: int, least: int) -> pd.DataFrame:
    """Links between (or within) two blocks, as a spanning forest of what they connect."""
    own = rows["block"] == rows["low"]
    left = rows[own].reset_index(drop=True)
    right = left if (rows["low"] == rows["high"]).all() else rows[~own].reset_index(drop=True)
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sets = [_sets(side["shingles"].tolist()) for side in (left, right)]
    sizes = [np.array([len(s) for s in side], np.int64) for side in sets]
    near = _overlaps(*[[s[:k] for s in side] for side in sets])
    whole = (sizes[0][:, None] <= 0.75 * k) & (sizes[1][None, :] <= 0.75 * k)
    maybe = np.where(whole, near > 0, near >= least)
    maybe &= 100 * np.minimum(sizes[0][:, None], sizes[1][None, :]) >= PERCENT * np.maximum(sizes[0][:, None], sizes[1][None, :])
    maybe &= left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :]
    li, ri = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(li):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    inter = _overlaps([sets[0][i] for i in li], [sets[1][i] for i in ri]).astype(np.int64)  # float32 would round 100 * inter
    linked = maybe[np.ix_(li, ri)] & _similar(inter, sizes[0][li][:, None], sizes[1][ri][None, :])
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a_ids, b_ids, found = left["id"].to_numpy()[li], right["id"].to_numpy()[ri], []
    for i, j in zip(*np.nonzero(linked)):
        a, b = int(a_ids[i]), int(b_ids[j])
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            found.append((a, b))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, least: int = LEAST,
               small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """For every row of ``df``: ``id`` (long), ``n_shingles``, ``component_id`` and ``kept``.

    Linked documents have 100 * intersection >= 75 * union of their shingle sets.  ``component_id`` is the
    smallest id that a document reaches; documents without words have empty sets and are linked with nothing.
    Null text counts as empty.  Rows of null id are linked with nothing and kept, with a null component.  Rows that
    repeat an id are one document, linked by any of their texts.  Other columns are not read.  An empty table
    gives no rows.
    """
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1):
                own = shingles(text.as_py())
                # The set's identity: two sums of independent bits.
                rows.append((len(own), int(own.sum().astype(np.int64)), int(_mixed(own ^ _ODD).sum().astype(np.int64)),
                             own[:k].astype(np.int64).tolist()))
            n, d1, d2, values = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                                              pa.array(values, pa.list_(pa.int64()))], names=["id", "n", "d1", "d2", "sketch"])

    sketched = written(docs.mapInArrow(sketch, "id long, n long, d1 long, d2 long, sketch array<long>"), "sketches")
    linkable = sketched.where("n > 0 AND id IS NOT NULL")
    classes = written(linkable.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")), "classes")

    # Values that one sketch alone holds come first in a document's order and make no list.
    values = classes.select("rep", "n", F.explode("sketch").alias("v"))
    held = values.groupBy("v").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = values.join(held.hint("merge"), "v").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("vs"))
    kept = F.least(F.col("n"), F.lit(k))
    must = F.when(F.col("n") <= 0.75 * k, F.ceil(F.col("n") * (PERCENT / 100))).otherwise(F.lit(least))
    alone = kept - F.size("vs")
    listed = shared.select("rep", "n", F.explode(F.slice("vs.v", F.lit(1), F.greatest(F.lit(0), kept - must + 1 - alone).cast("int"))).alias("v"))
    listed = written(listed, "lists")
    sizes = listed.groupBy("v").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("hub")).where("size > 1")
    members = listed.join(sizes.hint("merge"), "v")

    few = members.where(F.col("size") <= small).select("v", "rep", "n")
    other = few.select("v", F.col("rep").alias("b"), F.col("n").alias("m"))
    # Up to small - 1 partners a row; sizes too far apart cannot be similar.
    pairs = few.join(other.hint("merge"), "v").where(F.expr(f"rep < b AND 100 * least(n, m) >= {PERCENT} * greatest(n, m)"))
    pairs = pairs.select(F.col("rep").alias("a"), "b").distinct()
    sketches = classes.select(F.col("rep").alias("a"), F.col("sketch").alias("x"))
    with_both = pairs.join(sketches.hint("merge"), "a").join(sketches.toDF("b", "y").hint("merge"), "b")

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.array(v, np.int64).view(np.uint64) for v in c.to_pylist()] for c in (batch.column(2), batch.column(3)))
            yield batch.select([0, 1]).filter(pa.array([may_be_similar(p, q, k, least) for p, q in zip(x, y)], pa.bool_()))

    likely = written(with_both.select("a", "b", "x", "y").mapInArrow(estimate, "a long, b long"), "likely")

    # Longer lists: their documents' clusters, dealt into blocks.
    chains = members.where(F.col("size") > small).select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = components(chains)
    counted = clusters.join(clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "component")
    blocks = written(counted.select("id", "component", "blocks", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")), "blocks")

    wanted = written(likely.select(F.col("a").alias("id")).union(likely.select("b")).union(blocks.select("id")).distinct(), "wanted")
    full = written(_full_sets(docs, wanted), "sets")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_sets(c.to_pylist()) for c in (batch.column(2), batch.column(3)))
            inter = np.array([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)], np.int64)
            ok = _similar(inter, np.array([len(p) for p in x], np.int64), np.array([len(q) for q in y], np.int64))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    verified = (likely.join(full.toDF("a", "x").hint("merge"), "a").join(full.toDF("b", "y").hint("merge"), "b")
                .select("a", "b", "x", "y").mapInArrow(decide, "a long, b long"))
    dealt = blocks.join(full.hint("merge"), "id").select("id", "component", "block", "shingles", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    dealt = dealt.select("id", "shingles", "component", "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    blocked = dealt.groupBy("component", "low", "high").applyInPandas(lambda rows: _block_links(rows, k, least), "a long, b long")

    # The graph is one of classes; rows that repeat an id with another set tie their classes together.
    own = linkable.select("id", "n", "d1", "d2").join(classes.select("n", "d1", "d2", "rep").hint("merge"), ["n", "d1", "d2"])
    split = own.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    ties = own.join(split.select("id", "a").hint("merge"), "id").select("a", F.col("rep").alias("b"))
    found = components(written(verified.unionByName(blocked).unionByName(ties), "links"))
    out = sketched.select("id", "n", "d1", "d2").join(classes.select("n", "d1", "d2", "rep").hint("merge"), ["n", "d1", "d2"], "left")
    out = out.join(found.withColumnRenamed("id", "rep").hint("merge"), "rep", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles): the whole sets, as sorted 64-bit hashes, of the documents asked for.

    A filter of fixed size keeps most other texts from being read as sets; the join that follows is exact.
    """
    h = F.xxhash64("id")
    at = [h.bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(FILTER_BITS - 1))]
    # At most FILTER_BITS / 64 words, whatever is asked for.
    words = (wanted.select(F.explode(F.array(*at)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect())
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for word, bits in words:
        table[word] = bits

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(c).to_numpy() for c in (2, 3))
            hit = (table[first >> 6] >> (first & 63)) & (table[second >> 6] >> (second & 63)) & 1
            batch = batch.filter(pa.array(hit.astype(bool)))
            sets = [shingles(t.as_py()).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    some = docs.where("id IS NOT NULL").select("id", "text", *[c.alias(f"at{i}") for i, c in enumerate(at)])
    return some.mapInArrow(whole, "id long, shingles binary").join(wanted.hint("merge"), "id", "left_semi").distinct()
