"""Language identification by multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and every character that is no part of a word becomes a
blank.  Its features are the runs of 1 to ``GRAMS`` characters that do not hold
two blanks side by side, each hashed to one of a fixed number of buckets.
Fitting adds up the buckets of a bounded sample of each language's distinct
texts; the log-probabilities, a matrix of languages by buckets, are broadcast.
Scoring works on whole Arrow batches in numpy: the texts of a run are one array
of code points, their buckets come from shifted products of it, and a
language's scores from one lookup and one sum per text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

#: Distinct texts of a language to fit on, about: the bound of the sample.
SAMPLE = 5_000
#: Characters of an n-gram at most.
GRAMS = 4
#: Buckets of a language; with very many languages fewer, so that the matrix has MOST entries (128 MB) at most.
BUCKETS = 1 << 16
MOST = 1 << 24
#: Added to every count.
SMOOTHING = 0.5
UNKNOWN = "und"
#: Characters that are worked on at a time; longer texts are worked on in pieces.
_RUN = 1 << 18
_BLANK = 32
#: Odd multipliers of the characters of an n-gram, by its length.
_FACTORS = [[np.uint32((0x9E3779B1 * (16 * n + j) ** 2 + 0x85EBCA6B * (16 * n + j)) & 0xFFFFFFFF | 1) for j in range(n)] for n in range(1, 9)]

RESULT = "lang string, score double"


@dataclass(frozen=True)
class Model:
    #: Languages in ascending order, the matrix (languages x buckets) of log-probabilities and the log-priors.
    languages: list[str]
    weights: np.ndarray
    priors: np.ndarray

    @property
    def buckets(self) -> int:
        return self.weights.shape[1]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, 0 for the rest."""
    of = {"L": 2, "M": 1}
    return np.array([of.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in order, a list of about ``_RUN`` characters at a time; longer ones in pieces that overlap by as many
    characters as an n-gram needs."""
    at, own, total = [], [], 0
    for k, text in enumerate(texts):
        for start in range(0, len(text or ""), _RUN):
            own.append(text[max(start - GRAMS + 1, 0):start + _RUN].lower())
            at.append(k)
            total += len(own[-1])
            if total >= _RUN:
                yield at, own
                at, own, total = [], [], 0
    if own:
        yield at, own


def _features(own: list[str], buckets: int, first: list[bool]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each length of n-grams (the bucket and the piece of each), and whether a piece has a letter.

    ``first`` says which pieces begin their text; the others begin with what the piece before them ended with.
    """
    # A blank before, between and after the pieces: words at their ends are seen as such.
    codes = np.frombuffer((" " + " ".join(own) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[codes]
    lengths = np.array([len(p) for p in own], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    letters = np.add.reduceat((kinds == 2).astype(np.int64), starts) > 0
    codes = np.where(kinds > 0, codes, np.uint32(_BLANK)).astype(np.uint32)
    blank = codes == _BLANK
    piece = np.repeat(np.arange(len(own)), lengths + 1)  # of the n-gram that begins here
    begun = np.repeat(np.where(first, -1, GRAMS - 1), lengths + 1)
    place = np.arange(len(piece)) - starts[piece]
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    bad = blank[:-1] & blank[1:]
    found = []
    for n in range(1, GRAMS + 1):
        m = len(codes) - n + 1
        h = np.zeros(m, np.uint32)
        for j, factor in enumerate(_FACTORS[n - 1]):
            h += codes[j:j + m] * factor
        ok = ~blank[:m] if n == 1 else ~bad[:m]
        for j in range(1, n - 1):
            ok &= ~bad[j:j + m]
        own_piece = piece[:min(m, len(piece))]
        ok = ok[:len(own_piece)]
        # Within one piece and the blanks around it; what an overlap has again counts once.
        ok &= place[:len(own_piece)] + n <= lengths[own_piece] + 2
        ok &= place[:len(own_piece)] + n - 1 > begun[:len(own_piece)]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        found.append(((h[:len(own_piece)][ok] >> shift).astype(np.int64), own_piece[ok]))
    return found, letters


def _firsts(at: list[int], before: int) -> list[bool]:
    return [k != b for k, b in zip(at, [before, *at])]


def bucket_counts(texts: list[str | None], buckets: int) -> np.ndarray:
    """How often each bucket comes in some texts."""
    total, before = np.zeros(buckets, np.int64), -1
    for at, own in _pieces(texts):
        for found, _ in _features(own, buckets, _firsts(at, before))[0]:
            total += np.bincount(found, minlength=buckets)
        before = at[-1]
    return total


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """The model of the non-null languages of ``df``.

    A language is learned from about ``sample`` of its distinct texts (all of them if it has fewer rows), picked by a
    hash of the text; copies count once.  Its prior is its share of all rows.  Rows without text or language do not
    count; without any, the model has no language.
    """
    known = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL")
    # A row a language: as many as the matrix has, which is bounded below.
    rows = {r.lang: r["count"] for r in known.groupBy("lang").count().limit(MOST // 1024 + 1).collect()}
    if len(rows) > MOST // 1024:
        raise ValueError(f"more than {MOST // 1024} languages")
    languages = sorted(rows)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    buckets = min(BUCKETS, 1 << ((MOST // len(languages)).bit_length() - 1))
    spread = 1 << 40
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(spread, spread * sample // rows[k]))])
    picked = known.where(F.pmod(F.xxhash64("text"), F.lit(spread)) < share[F.col("lang")])
    once = picked.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            own: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own.setdefault(lang, []).append(text)
            for lang, texts in own.items():
                totals[lang] = totals.get(lang, 0) + bucket_counts(texts, buckets)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "bucket", "n"])

    counted = once.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    # MOST rows at most.
    counts = np.full((len(languages), buckets), SMOOTHING)
    number = {lang: i for i, lang in enumerate(languages)}
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[number[r.lang], r.bucket] += r.n
    weights = np.log(counts) - np.log(counts.sum(1, keepdims=True))
    priors = np.log(np.array([rows[k] for k in languages], float) / sum(rows.values()))
    return Model(languages, weights, priors)


def posteriors(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each text's probability of each language, and whether it has a letter."""
    scores = np.tile(model.priors, (len(texts), 1))
    lettered, before = np.zeros(len(texts), bool), -1
    for at, own in _pieces(texts):
        found, letters = _features(own, model.buckets, _firsts(at, before))
        rows = np.array(at)
        np.logical_or.at(lettered, rows, letters)
        for buckets, piece in found:
            if not len(buckets):
                continue
            # Pieces come in order, so that a piece's n-grams lie together.
            starts = np.flatnonzero(np.diff(piece, prepend=-1))
            for k in range(len(model.languages)):
                np.add.at(scores[:, k], rows[piece[starts]], np.add.reduceat(model.weights[k].take(buckets), starts))
        before = at[-1]
    scores -= scores.max(1, keepdims=True)
    likely = np.exp(scores)
    return likely / likely.sum(1, keepdims=True), lettered


def predict(text: Column, model: Model) -> Column:
    """``lang`` and ``score``, its probability, of whole texts; ties go to the first language.

    A text that is null, empty or without a letter is ``und`` with score 1, and so is any text under a model without
    languages.  Equal texts have equal results.  A column, so the other columns of a table, whatever their names, are
    not touched.
    """
    from pyspark.sql import SparkSession

    # As large as MOST allows.
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @pandas_udf(RESULT)
    def predicted(texts: pd.Series) -> pd.DataFrame:
        own = [t if isinstance(t, str) else None for t in texts]
        model = sent.value
        if not model.languages:
            return pd.DataFrame({"lang": [UNKNOWN] * len(own), "score": 1.0})
        likely, lettered = posteriors(own, model)
        best = likely.argmax(1)
        return pd.DataFrame({"lang": [model.languages[b] if k else UNKNOWN for b, k in zip(best, lettered)],
                             "score": np.where(lettered, likely[np.arange(len(own)), best], 1.0)})

    return predicted(text)
