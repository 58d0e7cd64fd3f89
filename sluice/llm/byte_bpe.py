"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Documents are gathered into blocks of bounded size.  A block's pre-tokens are
found once: its distinct words go out by a hash of the word, and the documents
keep the words' numbers by position.  Equal words of all blocks meet in one
part, which encodes each once.  Their ids go back to the block, whose documents
are put together from them by the positions.  Rows carry a block's words of one
part as one compressed list: what is shuffled is the positions, and the distinct
words of each block with their ids; no text.

Decoding looks every id up in the vocabulary's token-byte table, which has a
fixed size, and joins the bytes in order.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import shuffle_partitions

#: Bytes of a block, but for its last text.
BLOCK_BYTES = 4 << 20
#: White space before a space: there, and only there, pre-tokens depend on more than one run of white space and
#: what follows it.
_RUNS = re.compile(r"\s ")
_SHIFT = 33


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The token-byte table: an id's bytes."""
    table = ranks(path)
    out = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        out[rank] = token
    return out


def _pack(parts: list[bytes]) -> bytes:
    lengths = np.array([len(p) for p in parts], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(np.array([len(parts)], "<u4").tobytes() + lengths + b"".join(parts))


def _unpack(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


class Words:
    """The distinct pre-tokens of a block, numbered as they come."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.number: dict[str, int] = {}
        #: A word with the white space before it -> the numbers of its pre-tokens, as unsigned 32-bit integers.
        self.chunks: dict[str, bytes] = {}

    def numbers(self, text: str) -> bytes:
        if _RUNS.search(text):
            return self._numbers(text)
        first, *rest = text.split(" ")
        chunks = [first, *[" " + c for c in rest]]
        known = list(map(self.chunks.get, chunks))
        if None in known:
            for i, k in enumerate(known):
                if k is None:
                    known[i] = self.chunks[chunks[i]] = self._numbers(chunks[i])
        return b"".join(known)

    def _numbers(self, text: str) -> bytes:
        number = self.number
        return array("I", [number.setdefault(w, len(number)) for w in self.find(text)]).tobytes()


def _blocks(df: DataFrame, pattern: str, parts: int, block_bytes: int) -> DataFrame:
    """Rows of two kinds, by where they go (``goto``).  To a part (below zero): a block's distinct pre-tokens of the
    part, packed in the order of their numbers.  To the block (its number): ids of consecutive rows, each one's number
    of pre-tokens, and the part and place of every pre-token in order."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _SHIFT
        words = Words(pattern)
        found: list[bytes] = []
        at: list[pa.Array] = []
        size = 0

        def block() -> pa.RecordBatch:
            by_part: list[list[bytes]] = [[] for _ in range(parts)]
            for word in words.number:
                own = word.encode()
                by_part[crc32(own) % parts].append(own)
            some = [p for p in range(parts) if by_part[p]]
            ids = pa.chunked_array(at).combine_chunks().to_pylist()
            return pa.RecordBatch.from_arrays([
                pa.array([-1 - p for p in some] + [number], pa.int64()), pa.array([number] * (len(some) + 1), pa.int64()),
                pa.array([None] * len(some) + [ids], pa.list_(id_type)),
                pa.array([_pack(by_part[p]) for p in some] + [_pack(found)], pa.binary()),
                # Which part each distinct word went to, by its number.
                pa.array([None] * len(some) + [_pack([np.array([crc32(w.encode()) % parts for w in words.number], "<u4").tobytes()])], pa.binary())],
                names=["goto", "block", "ids", "payload", "dealt"])

        for batch in batches:
            for k, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                found.append(words.numbers(text))
                at.append(batch.column(0).slice(k, 1))
                size += len(text)
                if size >= block_bytes:
                    yield block()
                    words, found, at, size, number = Words(pattern), [], [], 0, number + 1
        if found:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema["id"].dataType
    id_type = to_arrow_type(kind)
    return df.mapInArrow(gather, f"goto long, block long, ids array<{kind.simpleString()}>, payload binary, dealt binary")


def _encoded(blocks: DataFrame, path: str, pattern: str) -> DataFrame:
    """The ids of every word, for its block: equal words of all blocks are in one part, which encodes each once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        part, known = None, {}
        for batch in batches:
            goto, block, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for g, packed in zip(goto, batch.column(3)):
                if g >= 0:  # a block's own row
                    continue
                if g != part:
                    part, known = g, {}
                words = _unpack(packed.as_py())
                for word in words:
                    if word not in known:
                        known[word] = array("I", encoder.encode_ordinary(word.decode())).tobytes()
                out.append(_pack([known[w] for w in words]))
            own = [(b, -1 - g) for g, b in zip(goto, block) if g < 0]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in own], pa.int64()), pa.array([p for _, p in own], pa.int64()),
                                              pa.array(out, pa.binary())], names=["goto", "part", "ids"])

    # A part's rows lie together: its distinct words are all that a task holds.
    return blocks.sortWithinPartitions("goto").mapInArrow(encode, "goto long, part long, ids binary")


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row's id with ``token_ids`` and ``decoded``, the bytes that they give by the token-byte table.

    Null text counts as empty.  Every match of the pattern is encoded separately, without special tokens.  Rows
    are independent, so repeated rows give repeated results; other columns are not read; an empty table gives no
    rows.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = shuffle_partitions(df.sparkSession)
    # Both uses read one shuffle, and whole rows of it, so that pre-tokens are found once.
    blocks = _blocks(docs, pattern, parts, block_bytes).repartition("goto")

    def assemble(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = own[own["goto"] >= 0]
        by_part = {p: iter(_unpack(i)) for p, i in zip(found["part"], found["ids"])}
        table, rows = token_bytes(path), []
        for ids, payload, dealt in zip(own["ids"], own["payload"], own["dealt"]):
            # A part's words came in the order of their numbers.
            words = [next(by_part[p]) for p in np.frombuffer(_unpack(dealt)[0], "<u4").tolist()]
            size = np.fromiter(map(len, words), np.int64, len(words)) // 4
            first = np.cumsum(size) - size
            flat = np.frombuffer(b"".join(words), "<u4")
            texts = [b"".join(map(table.__getitem__, memoryview(w).cast("I"))) for w in words]
            for i, numbers in zip(ids, _unpack(payload)):
                at = np.frombuffer(numbers, "<u4")
                ends = np.cumsum(size[at])
                begin = np.repeat(first[at] - ends + size[at], size[at])
                rows.append((i, flat[begin + np.arange(len(begin))].astype(np.int32), b"".join(map(texts.__getitem__, at.tolist()))))
        return pd.DataFrame(rows, columns=["id", "token_ids", "decoded"])

    kind = docs.schema["id"].dataType.simpleString()
    joined = blocks.groupBy("goto").cogroup(_encoded(blocks, path, pattern).groupBy("goto"))
    return joined.applyInPandas(assemble, f"id {kind}, token_ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Every row's id with ``decoded``: its token ids joined with the token-byte table, in order.

    Null ids count as none; an id that the table doesn't have is an error.
    """
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            joined = [b"".join([table[i] for i in ids.as_py() or []]) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(joined, pa.binary())], names=["id", "decoded"])

    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return own.mapInArrow(look_up, f"id {own.schema['id'].dataType.simpleString()}, decoded binary").withColumnRenamed("id", id_col)
