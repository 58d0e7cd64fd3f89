"""Packing documents into fixed-length sequences by bounded-space online packing.

Every partition tokenizes its documents and packs them as they come.  Runs of
``length`` tokens become sequences of their own; what remains of a document
goes best-fit into one of at most ``windows`` open windows.  Where none has the
room, the fullest window is emitted and a new one opened.  Windows still open
at the end of a partition are leftovers.  Only their fill levels are merged, in
rounds over groups of partitions, so no task ever sees more than
``windows * group`` of them; the pieces of a merged window then move with it.

A document's tokens are those of its words: the tokenizer splits at spaces and
newlines, so a word's ids are worked out once per task and kept in a bounded
cache.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import kept_in_worker, runs, written

LENGTH = 2048
WINDOWS = 64
#: Partitions whose leftovers one task merges.
GROUP = 64
#: Entries of a task's caches, half of them older ones: when the newer half is full the older is dropped, and an
#: older word that comes again is new again.  This costs time only.
CACHE = 1 << 20
PUNCTUATION = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
#: Sequence ids of partition p begin at p << SHIFT.
SHIFT = 36


class Words(dict):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_file: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.most = cache // 2
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        if self._ids("a b\nc") != [i for w in "abc" for i in self._ids(w)]:
            raise ValueError("the tokenizer's words are not independent")
        self.model = self.tokenizer.model
        # How the model spells the letters up to ÿ: a run of them is one word, and the model alone encodes it.
        self.spelling = {c: "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c)))
                         for c in range(128, 256) if chr(c).isalpha()}
        self.parts: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Add new words.  Letters part from punctuation and are lower-cased by the tokenizer, so variants of a
        word share its letters' ids; all new runs of letters are encoded by one call."""
        if len(self) + len(words) > self.most:
            self.old = dict(self)
            self.clear()
        if len(self.parts) + len(words) > self.most:
            self.old_parts, self.parts = self.parts, {"": b""}
        parts, old, strip = self.parts, self.old, PUNCTUATION
        for word in words:
            if word in old:
                self[word] = old[word]
                continue
            if word.isalpha():
                core = word
            else:
                core = word.strip(strip)
                if not core.isalpha():
                    self[word] = self.encode(word)
                    continue
            if not core.isascii() and max(core) > "ÿ":
                self[word] = self.encode(word)
                continue
            low = core.lower()
            letters = parts.get(low)
            if letters is None:
                letters = parts[low] = self.old_parts.get(low) or self.encode_letters(low)
            if core is word:
                self[word] = letters
                continue
            before, after = word.split(core, 1)
            for part in (before, after):
                if part not in parts:
                    parts[part] = self.encode(part)
            self[word] = parts[before] + letters + parts[after]

    def encode_letters(self, run: str) -> bytes:
        spelled = run if run.isascii() else run.translate(self.spelling)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()


def _words(tokenizer_file: str, cache: int) -> Words:
    return kept_in_worker(f"packing {cache} {tokenizer_file}", lambda: Words(tokenizer_file, cache))


def _lowered(text: str) -> str:
    """In lower case, as the tokenizer writes words: one word instead of its variants.  Beyond Latin-1, where letters
    depend on what is around them, the text stays as it is."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def documents_ids(texts: list[str], words: Words) -> list[bytes]:
    """Ids of some documents; what words they have that are new is learned first."""
    split = [_lowered(text).replace("\n", " ").split(" ") for text in texts]
    known = [list(map(words.get, own)) for own in split]
    new = {word for own, ids in zip(split, known) if None in ids for word, i in zip(own, ids) if i is None}
    if not new:
        return list(map(b"".join, known))
    words.learn(new)
    # What was known stays as it was found: learning may have emptied the cache.
    return [b"".join([words[word] if i is None else i for word, i in zip(own, ids)] if None in ids else ids)
            for own, ids in zip(split, known)]


class Packer:
    """The open windows of one partition, as (room, sequence id) in ascending order."""

    def __init__(self, first: int, length: int, windows: int):
        self.next, self.length, self.windows = first, length, windows
        self.open: list[tuple[int, int]] = []

    def place(self, n: int) -> tuple[int, int]:
        """Sequence and offset of a piece of n tokens."""
        if n == self.length:
            self.next += 1
            return self.next - 1, 0
        at = bisect_left(self.open, (n, -1))
        if at < len(self.open):
            room, sequence = self.open.pop(at)
        else:
            if len(self.open) == self.windows:
                self.open.pop(0)  # the fullest is emitted
            room, sequence, self.next = self.length, self.next, self.next + 1
        if room > n:
            insort(self.open, (room - n, sequence))
        return sequence, self.length - room


def _merge_rounds(left: DataFrame, partitions: int, length: int, windows: int, group: int) -> DataFrame | None:
    """Leftover windows (sequence_id, fill) -> (sequence_id, target, base): where a window's pieces move."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        """Best fit by decreasing fill; the emptiest ``windows`` results stay open for the next round."""
        rows = rows.sort_values(["fill", "sequence_id"], ascending=[False, True])
        bins: list[tuple[int, int]] = []
        fills: dict[int, int] = {}
        target, base = [], []
        for sequence, fill in zip(rows["sequence_id"].tolist(), rows["fill"].tolist()):
            at = bisect_left(bins, (fill, -1))
            room, into = bins.pop(at) if at < len(bins) else (length, sequence)
            target.append(into)
            base.append(length - room)
            fills[into] = length - room + fill
            insort(bins, (room - fill, into))
        still = {s for _, s in sorted(((f, s) for s, f in fills.items()))[:windows]}
        return rows.assign(target=target, base=base, filled=[fills[t] for t in target], open=[t in still for t in target])

    moves, scale = None, group
    while True:
        step = left.withColumn("part", F.floor(F.shiftright("sequence_id", SHIFT) / scale)).groupBy("part").applyInPandas(
            merge, "sequence_id long, fill long, part long, target long, base long, filled long, open boolean")
        step = written(step.select("sequence_id", "target", "base", "filled", "open"), "pack-merge")
        if moves is None:
            moves = step.select("sequence_id", "target", "base")
        else:
            again = step.select(F.col("sequence_id").alias("target"), F.col("target").alias("further"), F.col("base").alias("more"))
            moves = moves.join(again, "target", "left").select(
                "sequence_id", F.coalesce("further", "target").alias("target"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"))
        if scale >= partitions:
            return moves
        left = step.where("open AND target = sequence_id").select("sequence_id", F.col("filled").alias("fill"))
        scale *= group


def pack(df: DataFrame, tokenizer_file: str, end_id: int = 1, length: int = LENGTH, windows: int = WINDOWS,
         group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", cache: int = CACHE) -> DataFrame:
    """One row per piece of a document: id, ``start`` and ``length`` in the document's ids, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` there and ``ids``, the piece's ids (little-endian unsigned 32-bit).

    A document's ids end with ``end_id``; null text counts as empty, so such a document has that id alone.
    Repeated rows are packed as often as they come.  Other columns are not read.  An empty table gives no rows.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file, cache)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(TaskContext.get().partitionId() << SHIFT, length, windows)

        def batch_of(ids: pa.Array, rows: dict[str, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids] + [pa.array(rows[n], pa.binary() if n == "ids" else pa.int64()) for n in names[1:]], names=names)

        for batch in batches:
            done = 0
            # A run of texts at a time: a batch's ids are never held at once.
            for own in runs(batch.column(1)):
                rows: dict[str, list] = {n: [] for n in names[1:]}
                at = []
                for k, ids in enumerate(documents_ids(own, words), done):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        n = min(length, total - start)
                        for name, v in zip(names[1:], (start, n, total, *packer.place(n), ids[4 * start:4 * (start + n)])):
                            rows[name].append(v)
                        at.append(k)
                done += len(own)
                yield batch_of(batch.column(0).take(pa.array(at, pa.int64())), rows)
        # Which windows are left open, as rows without a document.
        blank = {n: [None] * len(packer.open) for n in names}
        blank |= {"sequence_id": [s for _, s in packer.open], "length": [length - r for r, _ in packer.open]}
        yield batch_of(pa.array(blank["id"], id_type), blank)

    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["id"].dataType
    id_type = to_arrow_type(kind)
    schema = f"id {kind.simpleString()}, " + ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names[1:])
    # Written once: the leftovers and the pieces must come from the same packing.
    placed = written(docs.mapInArrow(fill, schema), "pack")
    left = placed.where("start IS NULL").select("sequence_id", F.col("length").alias("fill"))
    pieces = placed.where("start IS NOT NULL")
    last = left.agg(F.max("sequence_id")).first()[0] or 0
    moves = _merge_rounds(left, 1 + (last >> SHIFT), length, windows, group)
    moved = pieces.join(moves.where("sequence_id <> target"), "sequence_id", "left")
    return moved.select(F.col("id").alias(id_col), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                        F.coalesce("target", "sequence_id").alias("sequence_id"),
                        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"), "ids")
