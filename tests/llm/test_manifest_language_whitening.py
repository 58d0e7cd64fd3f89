"""Operators 11 to 13 against brute-force versions, and on awkward tables."""

import hashlib
import math
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import language_id, merkle, queries, whitening

from ..conftest import SF_MID, SF_SMALL
from .test_operators import AWKWARD, awkward

LANGS = {"aa": "lorem ipsum dolor sit amet", "bb": "быстрый заяц бежит домой", "cc": "zwölf große Bäume wachsen"}


# --- 11 language identification -----------------------------------------------

def grams(text):
    """Every n-gram of the blanked text, the plain way, as strings."""
    out = []
    for start in range(0, len(text), language_id._RUN):
        piece = text[max(start - language_id.GRAMS + 1, 0):start + language_id._RUN].lower()
        t = " " + "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in piece) + " "
        for n in range(1, language_id.GRAMS + 1):
            for i in range(len(t) - n + 1):
                if start and i + n - 1 <= language_id.GRAMS - 1:
                    continue
                g = t[i:i + n]
                if "  " not in g and g != " ":
                    out.append(g)
    return out


def bucket(gram, buckets):
    h = sum(ord(c) * int(f) for c, f in zip(gram, language_id._FACTORS[len(gram) - 1])) & 0xFFFFFFFF
    h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
    return h >> (32 - (buckets.bit_length() - 1))


@pytest.mark.parametrize("text", ["", "a", "Ab c", "  x--y  \n", "é ü ß 日本語 😀 ḱ", "123 456", "word " * 50, "xy" * 400 + " z"])
def test_buckets_are_those_of_the_plain_ngrams(text, monkeypatch):
    monkeypatch.setattr(language_id, "_RUN", 100)
    want = np.bincount([bucket(g, 1 << 12) for g in grams(text)], minlength=1 << 12)
    assert (language_id.bucket_counts(["other", text, None], 1 << 12) - language_id.bucket_counts(["other"], 1 << 12) == want).all()


def test_posteriors_are_those_of_naive_bayes(spark):
    rows = [(k, f"{v} {i}") for k, v in LANGS.items() for i in range(4)] + [("aa", LANGS["aa"] + " 0"), (None, "x"), ("aa", None)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    counts = {k: np.full(model.buckets, language_id.SMOOTHING) for k in LANGS}
    for lang, text in {(k, t) for k, t in rows if k and t}:
        for g in grams(text):
            counts[lang][bucket(g, model.buckets)] += 1
    shares = {k: sum(1 for own, t in rows if own == k and t) for k in LANGS}
    for text in ["lorem große заяц", "домой", "zzz"]:
        logs = np.array([math.log(shares[k] / sum(shares.values())) + sum(math.log(c[bucket(g, model.buckets)] / c.sum()) for g in grams(text))
                         for k, c in sorted(counts.items())])
        want = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        got, letters = language_id.posteriors([None, text, "1 2"], model)
        assert np.allclose(got[1], want) and letters.tolist() == [False, True, False]


def test_language_on_awkward_tables(spark):
    model = language_id.fit(spark.createDataFrame([(k, v) for k, v in LANGS.items()], "lang string, text string"))
    got = awkward(spark).select("doc_id", "text", language_id.predict(F.col("text"), model).alias("p")).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert (r.p.lang == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.p.score <= 1
    assert len({(r.p.lang, r.p.score) for r in got if r.text == "A b c"}) == 1
    none = language_id.fit(awkward(spark).where("false").withColumn("lang", F.lit("x")))
    assert {r.p.lang for r in awkward(spark).select(language_id.predict(F.col("text"), none).alias("p")).collect()} == {"und"}
    assert awkward(spark).where("false").select(language_id.predict(F.col("text"), model)).count() == 0


def test_held_out_documents_of_every_language_are_found(spark):
    langs = {r.doc_id: (r.lang, r.text) for r in queries.documents(spark, SF_MID).collect()}
    got = queries.op11_language_id(spark, SF_MID).collect()
    assert len(got) == len(langs)
    for lang in {k for k, _ in langs.values()}:
        own = [r.lang_pred == lang for r in got if r.held_out and langs[r.doc_id][0] == lang and r.lang_pred != "und"]
        assert sum(own) >= 0.95 * len(own)


# --- 12 whitening -----------------------------------------------------------

def brute_whitening(vectors, k):
    """Distinct vectors, their components and every row's projection, all by numpy alone."""
    x = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), float)
    centred = fit - fit.mean(0)
    values, vecs = np.linalg.eigh(centred.T @ centred / len(fit))
    order = np.argsort(values)[::-1]
    order = order[values[order] > 1e-12 * values.max()][:k]
    sums = [sum(v[i] for v in set(x)) for i in range(len(x[0]))]
    return (len(fit), [sum((len(fit) * a - s) ** 2 for a, s in zip(v, sums)) for v in x],
            (np.array(x, float) - fit.mean(0)) @ vecs[:, order] / np.sqrt(values[order]), values[order] / values.sum())


def same_components(got, want):
    for g, w in zip(np.array(got).T, np.array(want).T):
        assert np.allclose(g, w, atol=1e-8) or np.allclose(g, -w, atol=1e-8)


def test_op12_against_numpy(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    got = queries.op12_whitening(spark, SF_SMALL).orderBy("vec_id", "component").collect()
    ids = sorted(vectors)
    n, deviation, whitened, explained = brute_whitening([vectors[i] for i in ids], 4)
    assert [(r.vec_id, r.component) for r in got] == [(i, c) for i in ids for c in (1, 2, 3, 4)]
    assert {r.n for r in got} == {n} and [r.deviation for r in got[::4]] == deviation
    same_components(np.array([r.whitened for r in got]).reshape(-1, 4), whitened)
    assert np.allclose([r.explained for r in got[:4]], explained, rtol=1e-6)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6


def test_whitening_on_awkward_tables(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(1)
    odd = [(1, None), (2, [1.0, None, 2.0]), (3, [nan, 1.0, 1.0]), (4, [1.0, -inf, 0.0])]
    good = [(10 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 3)))]
    copies = [(100 + i, good[0][1]) for i in range(30)] + [(None, good[1][1]), (None, good[1][1]), (7, [-0.0, 0.5, 0.25])]
    schema = "vec_id long, embedding array<double>, x string, idx string, v string, index string, whitened string"
    df = spark.createDataFrame([(i, v, "x", "x", "x", "x", "x") for i, v in odd + good + copies], schema).repartition(3)
    rows, model, error = whitening.whiten(df, block_rows=8)
    got = rows.collect()
    kept = good + copies
    n, deviation, whitened, _ = brute_whitening([v for _, v in kept], 3)
    key = lambda i, d: (i is None, i or 0, d)
    order = sorted(range(len(kept)), key=lambda j: key(kept[j][0], deviation[j]))
    got.sort(key=lambda r: key(r.id, r.deviation))
    assert [(r.id, r.deviation) for r in got] == [(kept[j][0], deviation[j]) for j in order]
    assert model.n == n and error < 1e-9
    same_components([r.whitened for r in got], whitened[order])

    for some, size in (([], 0), (odd, 0), ([(1, [])], 1), (copies[:5], 5), ([(1, [1.0]), (2, [1.0, 2.0]), (3, [3.0])], 3), ([(1, [1e300, 0.0]), (2, [0.0, 1.0])], 2)):
        small, _, e = whitening.whiten(spark.createDataFrame(some, "vec_id long, embedding array<double>"))
        found = small.collect()
        assert len(found) == size and e < 1e-4
    assert all(r.whitened == [] and r.deviation == 0 for r in whitening.whiten(spark.createDataFrame(copies[:5], "vec_id long, embedding array<double>"))[0].collect())


# --- 13 Merkle manifest -------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(leaves, fanout):
    """Root of a list, and each leaf's siblings as (before, after) by level."""
    paths, spans = [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        runs = range(0, len(leaves), fanout)
        for at in runs:
            own = leaves[at:at + fanout]
            for slot in range(len(own)):
                for i in spans[at + slot]:
                    paths[i].append(("".join(own[:slot]), "".join(own[slot + 1:])))
        leaves, spans = [h(*leaves[a:a + fanout]) for a in runs], [sum(spans[a:a + fanout], []) for a in runs]
    return leaves[0], paths


def brute_manifest(rows, fields, fanout, changed):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row: dicts with doc_id and lang."""
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of([r[f] for f in fields]), r))
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(by[g], key=lambda x: x[:3])], fanout) for g in groups]
    root, upper = brute_tree([t[0] for t in trees], fanout)
    out = []
    for g, (subroot, paths), up in zip(groups, trees, upper):
        for (_, _, leaf, r), path in zip(sorted(by[g], key=lambda x: x[:3]), paths):
            node = leaf_of([r[f] for f in fields] if not changed(r) else [r[f] + 1 if f == "n_chars" and r[f] is not None else r[f] for f in fields])
            for before, after in path + up:
                node = h(before, node, after)
            out.append((r["doc_id"], leaf, subroot, root, h(*[s for step in path + up for s in step]), node))
    return out


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_against_brute_force(spark, fanout):
    rows = [{"doc_id": i, "source": None if i % 5 == 0 else f"s{i % 3}", "lang": [None, "", "é", "de", "lone"][4 if i == 17 else i % 4], "n_chars": None if i % 6 == 0 else i,
             "text": t} for i, t in enumerate(["", None, "a\nb", "日本 😀", "x" * 3000] * 20)]
    rows += [dict(rows[8])] * 40 + [{"doc_id": None, "source": "s", "lang": "de", "n_chars": 1, "text": "t"}] * 3
    schema = "doc_id long, source string, lang string, n_chars long, text string, grp string, idx string, cnt string, digest string, key string, path string"
    df = spark.createDataFrame([tuple(r.values()) + ("x",) * 6 for r in rows], schema).repartition(5)
    got = merkle.manifest(df, FIELDS, fanout=fanout, tampered={"n_chars": lambda n: n + 1}, where=F.col("doc_id") % 3 == 0)
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), "folded_root").collect()
    want = brute_manifest(rows, FIELDS, fanout, lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_manifest_of_few_rows(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema), FIELDS).count() == 0
    for rows in ([(1, "s", None, 1, "t")], [(1, "s", "a", 1, "t"), (2, "s", "b", 1, "t")], [(i, "s", "a", 1, "t") for i in range(3)]):
        got = merkle.manifest(spark.createDataFrame(rows, schema), FIELDS).collect()
        want = brute_manifest([dict(zip(FIELDS, r)) for r in rows], FIELDS, 2, lambda r: False)
        assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.folded_root) for r in got) == sorted((w[0], w[1], w[2], w[3], w[5]) for w in want)
        assert all(r.folded_root == r.root for r in got)


def test_op13_verifies_what_is_not_tampered_with(spark):
    got = queries.op13_merkle(spark, SF_SMALL).collect()
    assert got and len({r.root for r in got}) == 1
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
