"""Exact token counts of every prefix of a text, by prefix dynamic programming.

The tokenizer is a sentencepiece BPE model with byte fallback.  For such a
model a row of pieces is the encoding of its text exactly when every piece
encodes to itself and every two neighbours, encoded together, stay as they are.
So the encoding of a prefix ends in the one piece ``t`` that is compatible with
the last piece of the prefix before ``t``, and

    count[i] = count[i - len(t)] + 1.

One pass over a text gives the counts of all its prefixes, from which "how many
tokens do the first n characters have" and "how many characters fit into b
tokens" are answered without encoding again.  No piece has a space after another
character, so texts fall into independent words; a word's counts are worked out
once per task and kept in a bounded cache.  Counts are stored as differences,
one signed byte per code point.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from sluice.llm.common import kept_in_worker, runs

SPACE = "\u2581"
#: Entries of a task's caches, half of them older ones: when the newer half is full the older is dropped, and an
#: older word that comes again is new again.  This costs time only.
CACHE = 1 << 20
#: Longer words are worked out in one go.
SHORT = 64
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]*")


class Pieces:
    """The pieces of a model and the two tests that the recurrence needs."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        special = [i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)]
        plain = set(range(sp.get_piece_size())) - set(special)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if sp.encode("") or sp.encode(f"a{SPACE}") != sp.encode("a ") or any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score):
            raise ValueError("the model's words are not independent")
        #: Pieces that encode to themselves -> what is known of pieces before them.
        self.units: dict[str, dict[str, bool]] = {p: {} for p in self.score if len(p) == 1 or self.merged(p) == [p]}
        #: Last two characters -> lengths of the units that end so, longest first.
        ends: dict[str, set[int]] = {}
        for p in self.units:
            if len(p) > 1:
                ends.setdefault(p[-2:], {1}).add(len(p))
        self.lengths = {e: sorted(n, reverse=True) for e, n in ends.items()}
        self.known = 0
        #: Two characters that some piece has side by side.  A text can be cut between any others.
        self.inside = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        #: The last word and its state: the next one goes on from their common beginning.
        self.word, self.count, self.last = "", [0], [""]
        self.lines_part = not any("\n" in two for two in self.inside)

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by the model's own rule: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def are_neighbours(self, left: str, right: str, before: dict[str, bool]) -> bool:
        if self.known >= CACHE:
            self.known = 0
            for found in self.units.values():
                found.clear()
        self.known += 1
        fits = before[left] = self.merged(left + right) == [left, right]
        return fits

    def counts(self, word: str) -> list[int]:
        """Tokens of word[:0], word[:1], ..., word."""
        before, count, last = self.word, self.count, self.last
        same, most = 0, min(len(word), len(before))
        while same < most and word[same] == before[same]:
            same += 1
        del count[same + 1:], last[same + 1:]
        self.word = word
        for i in range(same + 1, len(word) + 1):
            for n in self.lengths.get(word[i - 2:i], (1,)) if i > 1 else (1,):
                if n > i:
                    continue
                piece = word[i - n:i]
                before = self.units.get(piece)
                if before is None:
                    if n > 1:
                        continue
                    before = {}
                left = last[i - n]
                fits = n == i or before.get(left)
                if fits or fits is None and self.are_neighbours(left, piece, before):
                    # A character without a piece falls back to its bytes.
                    count.append(count[i - n] + (1 if piece in self.score else len(piece.encode("utf-8", "replace"))))
                    last.append(piece)
                    break
        return count


def _differences(counts: list[int]) -> bytes:
    """As signed bytes; array refuses what is not one."""
    return array("b", [b - a for a, b in zip(counts, counts[1:])]).tobytes()


class Words(dict):
    """word without its space -> differences of the counts, one signed byte per code point and one for the space."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        #: The same for runs that no space goes before.
        self.runs: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE // 2:
            self.old = dict(self)
            self.clear()
        if word in self.old:
            found = self[word] = self.old[word]
            return found
        if "\n" in word and self.pieces.lines_part:
            first, *rest = word.split("\n")
            end = self.run("\n")
            return self[first] + b"".join([end + self.run(r) for r in rest])
        if 1 < len(word) <= SHORT and word[-2:] not in self.pieces.inside:
            found = self[word[:-1]] + self.run(word[-1])
        else:
            found = _differences(self.pieces.counts(SPACE + word))
        self[word] = found
        return found

    def run(self, run: str) -> bytes:
        found = self.runs.get(run)
        if found is None:
            if len(self.runs) >= CACHE:
                self.runs = {"": b""}
            if 1 < len(run) <= SHORT and run[-2:] not in self.pieces.inside:
                found = self.run(run[:-1]) + self.run(run[-1])
            else:
                found = _differences(self.pieces.counts(run))
            self.runs[run] = found
        return found


def _words(model: str) -> Words:
    return kept_in_worker(f"token-counts {model}", lambda: Words(Pieces(model)))


def _split(text: str) -> list[str]:
    """The words of a text, each without the space before it."""
    text = text.replace(" ", SPACE)
    if SPACE + SPACE in text or text[0] == SPACE:
        return [w[1:] for w in _WORDS.findall(SPACE + text) if w]
    return text.split(SPACE)


def prefix_differences(texts: list[str], words: Words) -> list[bytes]:
    """For each text, the differences of the counts of text[:0], text[:1], ..., text: a signed byte a code point."""
    split = [_split(text) if text else [] for text in texts]
    # New words in order, as the counts of one go on from those of its neighbour.
    for word in sorted(set().union(*split).difference(words)):
        words[word]
    found = [b"".join(map(words.__getitem__, own)) for own in split]
    # The model puts a space before a text: it counts with the first character.
    return [np.frombuffer(f[:2], np.int8).sum(dtype=np.int8).tobytes() + f[2:] if f else f for f in found]


def prefix_counts(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: id, ``n_bytes`` (UTF-8), ``prefix_store``, which answers ``tokens_in`` and ``chars_within``, and
    ``n_tokens``, the store's answer for the whole text.

    Null text counts as empty: no bytes, no tokens, an empty store.  Strings of special tokens are ordinary
    text, as in the library.  Rows are independent, so repeated rows give repeated results; other columns are
    not read; an empty table gives no rows.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(model)
        for batch in batches:
            done = 0
            for texts in runs(batch.column(1)):
                stores = prefix_differences(texts, words)
                sizes = [len(text) if text.isascii() else len(text.encode()) for text in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), pa.array(sizes, pa.int64()), pa.array(stores, pa.binary())],
                                                 names=["id", "n_bytes", "prefix_store"])
                done += len(texts)

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"id {docs.schema['id'].dataType.simpleString()}, n_bytes long, prefix_store binary"
    stored = docs.mapInArrow(count, schema)
    return stored.select(F.col("id").alias(id_col), "n_bytes", tokens_in(F.col("prefix_store")).alias("n_tokens"), "prefix_store")


def tokens_in(store: Column, n_chars: Column | None = None) -> Column:
    """Tokens of the first ``n_chars`` code points (of the whole text where there are fewer, or None is given).  A null
    store or number gives null, a negative number 0."""
    @pandas_udf("long")
    def answer(stores: pd.Series, lengths: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or pd.isna(n) else int(np.frombuffer(s, np.int8)[:max(int(n), 0)].sum(dtype=np.int64))
                          for s, n in zip(stores, lengths)], dtype="Int64")

    return answer(store, (F.octet_length(store) if n_chars is None else n_chars).cast("long"))


def chars_within(store: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens; null where the store or the budget is null."""
    @pandas_udf("long")
    def answer(stores: pd.Series, budgets: pd.Series) -> pd.Series:
        found = []
        for s, b in zip(stores, budgets):
            if s is None or pd.isna(b):
                found.append(None)
                continue
            fits = np.flatnonzero(np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64) <= int(b))
            found.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(found, dtype="Int64")

    return answer(store, budget.cast("long"))
