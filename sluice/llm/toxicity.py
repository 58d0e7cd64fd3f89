"""Toxic passages by maximum-scoring segment search.

A token is a whole word or a part of one: ``nasty``, or ``nas*`` at a word's beginning, ``*sty`` at its end and
``*ast*`` within, of ``PART`` characters; so inflected and compound words are seen by what they share.  Fitting
counts how many toxic and clean texts have each token, and picks those that come in toxic texts more often than
chance gives: their exact hypergeometric tail, times the number of tokens tested, is at most ``FALSE``.  So how often
a token must come follows from the numbers of texts and tokens, and one that comes in toxic texts only needs few of
them.  A word counts for the first picked token that it has, whole words first, then the surest and longest parts; a
part must pass by the words that are left to it.  A token
scores the log of
its probability in a toxic passage over that in clean text: a picked token ``log(DENSITY * q / p)``, any other
``log(1 - DENSITY)``.

Scoring scans a text once and finds every maximal segment: one that no extension
and no part of it beats.  Scores are log-likelihood ratios, so the best segment
of n clean tokens follows an extreme-value law of scale 1 whose tail is at most
``n * exp(-S)``.  A segment of score S is evidence ``S - log(n)`` where that is
positive; the text's score is the logistic function of the evidence of all its
segments and of the prior odds.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from sluice.llm.common import kept_in_worker, written

#: Labelled rows to fit on, those of smallest hash; the only bound on what is read.
SAMPLE = 20_000
#: Tokens that may be picked by chance, of words and of parts each.
FALSE = 0.05
#: Characters of a part of a word, least and most.
PART = (2, 8)
#: Share of picked tokens in a toxic passage.
DENSITY = 0.25
#: Score of a text without evidence.
PRIOR = 0.05
THRESHOLD = 0.3
_TOKEN = re.compile(r"[^\W_]+")
#: Rows of counts that a task holds before it passes them on, and words that it remembers.
_HELD = 1 << 17
_WORDS = 1 << 15

RESULT = "score double, passages array<struct<first:long,last:long,score:double>>"


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def parts(word: str, least: int = PART[0], most: int = PART[1]) -> Iterator[str]:
    """The tokens that see inside a word."""
    for size in range(least, min(most, len(word) - 1) + 1):
        last = len(word) - size
        yield word[:size] + "*"
        yield "*" + word[last:]
        for i in range(1, last):
            yield "*" + word[i:i + size] + "*"


def finder(ranks: dict[str, int]) -> Callable[[str], str | None]:
    """word -> the token of least rank that it has."""
    sizes = [sorted({len(t.strip("*")) for t in ranks if (t[0] == "*", t[-1] == "*") == kind}) for kind in ((False, True), (True, False), (True, True))]

    def find(word: str) -> str | None:
        last = len(word)
        found = [word, *[word[:n] + "*" for n in sizes[0] if n < last], *["*" + word[last - n:] for n in sizes[1] if n < last],
                 *["*" + word[i:i + n] + "*" for n in sizes[2] for i in range(1, last - n)]]
        return min((t for t in found if t in ranks), key=ranks.__getitem__, default=None)

    return remembered(find)


def remembered(of: Callable) -> Callable:
    """``of`` by word; short words are remembered."""
    known = {}

    def get(word: str):
        if len(word) > 64:
            return of(word)
        if word not in known:
            if len(known) >= _WORDS:
                known.clear()
            known[word] = of(word)
        return known[word]

    return get


def chance(toxic: int, clean: int, n1: int, n0: int) -> float:
    """Log of the probability that of ``toxic + clean`` ones among n1 + n0, drawn blindly, ``toxic`` or more are among
    the n1."""
    k, n = toxic + clean, n1 + n0
    if toxic * n <= k * n1:
        return 0.0

    def choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    first = choose(n1, toxic) + choose(n0, clean) - choose(n, k)
    total, term = 1.0, 1.0
    for x in range(toxic, min(k, n1)):
        term *= (n1 - x) * (k - x) / ((x + 1) * (n0 - k + x + 1))
        total += term
        if term < 1e-12 * total:
            break
    return min(first + math.log(total), 0.0)


def surest(counts: Iterable[tuple[str, int, int]], n1: int, n0: int, tested: dict[bool, int]) -> list[str]:
    """Of (token, toxic, clean) the tokens that come in toxic ones too often for chance among as many tests, words
    first, then the surest and longest first.

    A token less than 1 / DENSITY times as frequent there as in clean ones is no evidence of a passage, however sure:
    longer texts have more of every common token."""
    known, found = {}, []
    for token, toxic, clean in counts:
        if DENSITY * toxic * n0 <= clean * n1:
            continue
        if (toxic, clean) not in known:
            known[toxic, clean] = chance(toxic, clean, n1, n0)
        if known[toxic, clean] <= math.log(FALSE / tested["*" in token]):
            found.append(("*" in token, known[toxic, clean], -len(token), token))
    return [f[-1] for f in sorted(found)]


def fit(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> dict[str, float]:
    """Token -> score, in the order in which a word takes its token.  Rows without an id, text or label do not count.

    Picked tokens must also come too often by their contexts, where a token counts once for each pair of neighbours
    that it has in toxic, or in clean, texts: so neither copies of a text, near or exact, nor a line that repeats make
    it look frequent.  Without toxic or without clean texts no token is picked and the model is empty.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(sample))
    # At most ``sample`` rows of two numbers.
    texts = written(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
                    .join(F.broadcast(known), "id").where("text IS NOT NULL")
                    .select("text", F.col("toxic").cast("boolean").alias("toxic")), "toxic-sample")
    n1, n0 = texts.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    if not n0 or not n1:
        return {}

    def counting(of: Callable[[], Callable[[str], Iterable[str]]]) -> DataFrame:
        """Texts with each token, of those that ``of()`` gives for a word."""
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept_in_worker("toxicity", dict)
            get, found = of(), (Counter(), Counter())

            def rows() -> pa.RecordBatch:
                names = list(found[0].keys() | found[1].keys())
                return pa.RecordBatch.from_pydict({"token": names, "clean": [found[0][t] for t in names], "toxic": [found[1][t] for t in names]},
                                                  pa.schema([("token", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))

            for batch in batches:
                for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                    found[toxic].update({t for w in set(tokens(text.as_py())) for t in get(w)})
                    if len(found[0]) + len(found[1]) >= _HELD:
                        yield rows()
                        found = (Counter(), Counter())
            yield rows()

        source = texts.where("toxic") if of is every else texts
        return (source.mapInArrow(count, "token string, clean long, toxic long")
                .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))

    def every() -> Callable[[str], Iterable[str]]:
        return lambda word: (word, *parts(word))

    # A token in k toxic texts and no clean one is as sure as k allows.  Those that cannot pass are not tested, nor
    # looked up in clean texts.
    toxic = written(counting(every).select("token", "toxic", F.col("token").contains("*").alias("part")), "toxic-tokens")
    held = toxic.groupBy("part", "toxic").count().collect()  # a row a number of texts
    least, tested = {}, {}
    for family in (False, True):
        for k in range(1, n1 + 1):
            m = sum(r["count"] for r in held if r.part == family and r.toxic >= k)
            if m and chance(k, 0, n1, n0) <= math.log(FALSE / m):
                least[family], tested[family] = k, m
                break
    able = F.lit(False)
    for family, k in least.items():
        able |= (F.col("part") == family) & (F.col("toxic") >= k)
    candidates = frozenset(r.token for r in toxic.where(able).select("token").collect())
    if not candidates:
        return {}
    sent = df.sparkSession.sparkContext.broadcast(candidates)

    def able_ones() -> Callable[[str], Iterable[str]]:
        among = sent.value
        return remembered(lambda word: [t for t in (word, *parts(word)) if t in among])

    def ranked(of: Callable[[], Callable[[str], Iterable[str]]]) -> dict[str, int]:
        picked = surest(((r.token, r.toxic, r.clean) for r in counting(of).collect()), n1, n0, tested)
        return {t: i for i, t in enumerate(picked)}

    def first_ones() -> Callable[[str], Iterable[str]]:
        find = finder(ranks)
        return lambda word: [t] if (t := find(word)) else []

    ranks = ranked(able_ones)
    # What is left of a token by those before it may not pass; its words go to the next.
    passed = ranked(first_ones) if ranks else {}
    ranks = {t: i for t, i in ranks.items() if t in passed}
    if not ranks:
        return {}

    def settings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Picked tokens with their neighbours; other words, as an empty token, by their number."""
        find = finder(ranks)
        for batch in batches:
            rows, rest = set(), [0, 0]
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = ["", *tokens(text.as_py()), ""]
                at = [(i, t) for i, w in enumerate(words) if (t := find(w))]
                rows.update((t, words[i - 1], words[i + 1], toxic) for i, t in at)
                rest[toxic] += len(words) - 2 - len(at)
            rows = [(*r, 1) for r in rows] + [("", "", "", bool(k), n) for k, n in enumerate(rest)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["token", "left", "right", "toxic", "n"])

    once = texts.mapInArrow(settings, "token string, left string, right string, toxic boolean, n long")
    once = once.groupBy("token", "left", "right", "toxic").agg(F.sum("n").alias("n"))
    each = F.when(F.col("token") == "", F.col("n")).otherwise(1)
    # The picked tokens and the empty one: (toxic, clean) contexts of each.
    own = {r.token: (r.toxic, r.clean) for r in once.groupBy("token").agg(
        F.sum(F.when(F.col("toxic"), each).otherwise(0)).alias("toxic"),
        F.sum(F.when(~F.col("toxic"), each).otherwise(0)).alias("clean")).collect()}
    n1, n0 = (sum(c) for c in zip(*own.values()))
    own.pop("", None)
    passed = set(surest([(t, *c) for t, c in own.items()], n1, n0, dict.fromkeys((False, True), len(own))))
    # Contexts in toxic texts beyond as many as clean text gives.
    more = {t: own[t][0] - own[t][1] * n1 / n0 for t in ranks if t in passed}
    total = sum(more.values())
    return {t: s for t, x in more.items()
            if (s := math.log(DENSITY * (x + 0.5) / (total + 0.5 * len(more)) / ((own[t][1] + 0.5) / (n0 + 1)))) > 0}


def segments(scored: list[tuple[int, float]], n: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of n tokens; ``scored`` has the tokens of
    positive score in order, every other token scores log(1 - DENSITY).  Linear in ``scored``: a list of
    candidates with the sums before (l) and after them (r) is kept, as Ruzzo and Tompa do."""
    other = math.log(1 - DENSITY)
    found: list[tuple[int, int, float, float, int]] = []  # first, last, l, r, the nearest earlier one with a smaller l
    total, at = 0.0, 0
    for position, score in scored:
        total += other * (position - at)
        first, last, before = position, position, total
        total += score
        at = position + 1
        near = len(found) - 1
        while True:
            while near >= 0 and found[near][2] >= before:
                near = found[near][4]
            if near < 0 or found[near][3] >= total:
                break
            # The sum rises beyond that candidate's end: both become one.
            first, before = found[near][0], found[near][2]
            del found[near:]
            near = len(found) - 1
        found.append((first, last, before, total, near))
    return [(f, e, r - b) for f, e, b, r, _ in found]


def judge(text: str | None, model: dict[str, float], find: Callable[[str], str | None] | None = None) -> tuple[float, list[tuple[int, int, float]]]:
    """Score of a text and its significant passages; ``find`` is the model's finder."""
    words = tokens(text or "")
    find = find or finder({t: i for i, t in enumerate(model)})
    scored = [(i, model[t]) for i, w in enumerate(words) if (t := find(w))] if model else []
    least = math.log(max(len(words), 1))
    passages = [s for s in segments(scored, len(words)) if s[2] > least]
    evidence = math.log(PRIOR / (1 - PRIOR)) + sum(s - least for _, _, s in passages)
    return (1 / (1 + math.exp(-evidence)) if evidence < 700 else 1.0), passages


def toxicity(text: Column, model: dict[str, float]) -> Column:
    """``score`` (0 to 1) and ``passages`` (first and last token, score) of whole texts.

    Null and empty texts have the prior's score and no passage; equal texts have equal scores.  A column, so
    the other columns of a table, whatever their names, are not touched.
    """
    @pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        kept_in_worker("toxicity", dict)
        find = finder({t: i for i, t in enumerate(model)})
        for texts in batches:
            found = [judge(t, model, find) for t in texts]
            yield pd.DataFrame({"score": [s for s, _ in found],
                                "passages": [[{"first": a, "last": b, "score": s} for a, b, s in p] for _, p in found]})

    return judged(text)
