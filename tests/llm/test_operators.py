"""Every operator against a brute-force version, and on awkward tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sluice.llm import (byte_bpe, chat, exact_dedup, fingerprints, line_dedup, near_dedup, packing, queries, sharding,
                        token_counts, toxicity)
from tools.oracle_check import digest, duck

from ..conftest import SF_SMALL

PIECES, WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in (queries.PIECES, queries.WORD_BPE, queries.BYTE_BPE))
LINE = "A line that many documents hold, and that is long enough to count."
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
#: Nulls, empty and blank texts, a very long one, ties, repeated rows, repeated ids with other texts.
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "A b c"), (4, "A b c"), (5, "a B c"), (6, LONG), (7, LONG.upper()), (None, "a b c"),
           (None, None), (8, "one text"), (8, "another text"), *[(10 + i, f"{LINE}\nown line {i}\n  {LINE.upper()} ") for i in range(6)],
           (20, "é ü ß 日本語 😀 <s> </s> <|endoftext|> [INST]"), (21, "\n\n\n"), (22, "x" * 5000)]
CLASHING = "doc_id long, text string, id string, row string, n long, grp string, v string, key string, slot string, h1 string, t string"


def awkward(spark, rows=AWKWARD):
    return spark.createDataFrame([(i, t, "x", "x", 1, "x", "x", "x", "x", "x", "x") for i, t in rows], CLASHING).repartition(3)


def pairs(rows=AWKWARD):
    return [(i, t or "") for i, t in rows]


def az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = duck(SF_SMALL).execute(queries.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, res.fetchall())


def test_empty_tables(spark):
    none = awkward(spark).where("false")
    assert sharding.shard_rows(none, sharding.tree(24)).count() == 0
    assert token_counts.prefix_counts(none, PIECES).count() == 0
    assert packing.pack(none, WORD_BPE).count() == 0
    assert byte_bpe.encode(none, BYTE_BPE, public_tokenizers.PATTERN).count() == 0
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert near_dedup.near_dedup(none).count() == 0
    assert fingerprints.edit_report(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert line_dedup.drop_common_lines(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(none, labels) == {}
    assert none.select(toxicity.toxicity(F.col("text"), {"bad": 5.0})).count() == 0


# --- 1 sharding ---------------------------------------------------------------

def test_sharding_moves_rows_into_the_new_shard_only(spark):
    got = sharding.shard_rows(awkward(spark), sharding.tree(24)).collect()
    assert len(got) == len(AWKWARD)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in pairs())
    many = sharding.shard_rows(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), sharding.tree(24)).collect()
    by = collections.defaultdict(list)
    for r in many:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and sorted(by) == list(range(24))
    assert max(map(len, by.values())) < 1.25 * 20_000 / 24
    assert 0.7 * 800 < sum(r.grown_shard == 24 for r in many) < 1.3 * 800


def test_sharding_change_of_weight_stays_in_its_subtrees(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    base = sharding.tree(24)
    heavier = [sharding.Shard(s.region, s.rack, s.shard, 2.0 if s.shard == 5 else 1.0) for s in base]
    moved = keys.select(sharding.place(F.col("k"), base).alias("a"), sharding.place(F.col("k"), heavier).alias("b")).where("a <> b").collect()
    # Shard 5 is in rack 1 of region 0: rows come into that region, into that rack, or into that shard.
    assert moved and all((r.a // 12 != 0 and r.b // 12 == 0) or (r.a // 12 == 0 and r.a // 4 != 1 and r.b // 4 == 1) or (r.a // 4 == 1 and r.b == 5) for r in moved)


# --- 2 token counts -------------------------------------------------------------

def test_prefix_counts_answer_every_prefix(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    store = token_counts.prefix_counts(awkward(spark), PIECES)
    got = store.collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted((len(t.encode()), len(sp.encode(t))) for _, t in pairs())
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdefgh tionThE .,;:'\n\t▁é😀日0123{}()\r") for _ in range(40)) for _ in range(60)]
    words = token_counts.Words(token_counts.Pieces(PIECES))
    for text, found in zip(texts, token_counts.prefix_differences(texts, words)):
        counts = np.cumsum(np.frombuffer(found, np.int8), dtype=np.int64)
        assert counts.tolist() == [len(sp.encode(text[:i + 1])) for i in range(len(text))]
    ask = store.where("doc_id = 20").select(
        token_counts.tokens_in(F.col("prefix_store"), F.lit(7).cast("long")).alias("n"),
        token_counts.chars_within(F.col("prefix_store"), F.lit(5).cast("long")).alias("c")).first()
    text = dict(AWKWARD)[20]
    assert ask.n == len(sp.encode(text[:7]))
    assert ask.c == max(i for i in range(len(text) + 1) if len(sp.encode(text[:i])) <= 5)


# --- 3 packing --------------------------------------------------------------------

def test_packing_keeps_every_id_once(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD_BPE)
    rnd = random.Random(2)
    rows = [r for r in AWKWARD if r[0] not in (None, 4, 8)] + [(100 + i, " ".join(rnd.choice(["The", "erth,", "thou."]) for _ in range(rnd.randint(0, 1500)))) for i in range(120)]
    got = packing.pack(awkward(spark, rows).repartition(7), WORD_BPE, windows=4, group=2).collect()
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, text in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        own = sorted(by[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == ids and {r.doc_tokens for r in own} == {len(ids) // 4}
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.length == len(r.ids) // 4 for r in own)
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
    assert sum(r.length for r in got) / (len(seqs) * packing.LENGTH) > 0.9
    repeated = packing.pack(awkward(spark), WORD_BPE).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in repeated}[4] == 2


@pytest.mark.parametrize("module", [packing, token_counts])
def test_caches_that_fill_up_change_nothing(monkeypatch, module):
    monkeypatch.setattr(module, "CACHE", 16)
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("The erth thou, and. whly\nEd of a b c d e f g h i j k l m n".split(" ")) for _ in range(30)) for _ in range(40)]
    if module is packing:
        words = packing.Words(WORD_BPE, 16)
        got = [ids for start in range(0, 40, 3) for ids in packing.documents_ids(texts[start:start + 3], words)]
        assert got == [words.encode(t) for t in texts]
    else:
        words, plain = (token_counts.Words(token_counts.Pieces(PIECES)) for _ in range(2))
        got = [d for start in range(0, 40, 3) for d in token_counts.prefix_differences(texts[start:start + 3], words)]
        monkeypatch.setattr(module, "CACHE", 1 << 20)
        assert got == token_counts.prefix_differences(texts, plain)


# --- 4 byte-level BPE -----------------------------------------------------------

def test_byte_bpe_round_trip(spark):
    encoder = byte_bpe._encoder(BYTE_BPE, public_tokenizers.PATTERN)
    rnd = random.Random(4)
    rows = AWKWARD + [(1000 + i, "".join(rnd.choice(["a", "bc", "'s", " ", "  ", "\n", "\t", "é", "1", "!", " ", "\x1c", " ", "字"]) for _ in range(20))) for i in range(200)]
    encoded = byte_bpe.encode(awkward(spark, rows), BYTE_BPE, public_tokenizers.PATTERN, block_bytes=20_000)
    rows_got = encoded.collect()
    got = [(r.doc_id, list(r.token_ids)) for r in rows_got]
    assert sorted(bytes(r.decoded).decode() for r in rows_got) == sorted(t for _, t in pairs(rows))
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1]))
    assert sorted(got, key=key) == sorted(((i, encoder.encode_ordinary(t)) for i, t in pairs(rows)), key=key)
    assert sorted(bytes(r.decoded).decode() for r in byte_bpe.decode(encoded, BYTE_BPE).collect()) == sorted(t for _, t in pairs(rows))
    # The runs that texts are cut at match in any script.
    assert all(encoder.encode_ordinary(c + " a") == byte_bpe._encoder(BYTE_BPE, public_tokenizers.PATTERN).encode_ordinary(c + " a") for c in "\x1c\x85　")


def test_registered_token_queries_against_the_libraries(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    texts = {r.doc_id: r.text or "" for r in queries.documents(spark, SF_SMALL).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = {i: len(sp.encode(t)) for i, t in texts.items()}
    got = queries.op2_token_counts(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {(i, len(t.encode()), counts[i], counts[i] > 4096) for i, t in texts.items()}

    words = Tokenizer.from_file(WORD_BPE)
    ids = {i: words.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    pieces = queries.op3_packing(spark, SF_SMALL).collect()
    for r in pieces:
        own = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens, len(own)) == (zlib.crc32(own), len(ids[r.doc_id]), 4 * r.length)
    assert sum(r.length for r in pieces) == sum(map(len, ids.values())) and len({(r.doc_id, r.start) for r in pieces}) == len(pieces)

    encoder = byte_bpe._encoder(BYTE_BPE, public_tokenizers.PATTERN)
    want = set()
    for i, t in texts.items():
        own = encoder.encode_ordinary(t)
        want.add((i, len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = queries.op4_byte_bpe(spark, SF_SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(texts)


def test_registered_chat_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    chats = collections.defaultdict(list)
    for r in rows:
        chats[r.conv_id].append((r.role, r.text or ""))
    chats[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, SF_SMALL).collect()}
    assert got.keys() == chats.keys()
    for c, turns in chats.items():
        said = "".join(t for role, t in turns if role == "assistant")
        digest_of = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), digest_of, len(said), hashlib.sha256(said.encode()).hexdigest())


# --- 5 chat formatting -----------------------------------------------------------

def test_chat_reads_back_and_masks_assistant_texts(spark):
    rnd = random.Random(5)
    marks = ["a", "<s>", "[INST]", "\\", "[", "<", "</s>", "[/INST]", " ", "\n", "é", chat.PROBE, "<<SYS>>", "[ROLE]"]
    chats = {c: [(rnd.choice(["user", "assistant", "system", "tool", ""]), "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 6))))
                 for _ in range(rnd.randint(1, 8))] for c in range(60)}
    rows = [(c, k, r, t or None, "x") for c, turns in chats.items() for k, (r, t) in enumerate(turns)] + [(None, None, None, None, "x")]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(4)).collect()}
    assert len(got) == 61 and chat.read_back(got[None].formatted) == [("", "")]
    for c, turns in chats.items():
        r = got[c]
        assert chat.read_back(r.formatted) == turns and not r.rewrites
        assert [chat.unescape(r.formatted[m["first"]:m["last"]]) for m in r.mask] == [t for role, t in turns if role == "assistant"]


def test_chat_detects_rewritten_history():
    def system_first(turns):
        return chat.render(sorted(turns, key=lambda t: t[0] != "system"))

    assert chat.locate([("user", "a"), ("assistant", "b")], system_first)[2] is False
    text, spans, rewrites = chat.locate([("user", "a"), ("system", "b")], system_first)
    assert rewrites and spans[1][0] == -1 and text == system_first([("user", "a"), ("system", "b")])


# --- 6 near dedup ------------------------------------------------------------------

def brute_components(rows):
    sets, up = collections.defaultdict(list), {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i].append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
        up.setdefault(i, i)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}, {i: sorted(map(len, s)) for i, s in sets.items()}


@pytest.mark.parametrize("small,block", [(16, 1024), (3, 40)])
def test_near_dedup_equals_brute_force(spark, small, block):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = [r for r in pairs() if r[0] is not None]
    for i in range(120):
        own = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 5, 8, 12])):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        rows.append((100 + i, " ".join(own)))
    hot = [rnd.choice(words) for _ in range(14)]
    rows += [(300 + i, " ".join(hot + [rnd.choice(words) for _ in range(rnd.randint(0, 30))])) for i in range(80)]
    got = near_dedup.near_dedup(awkward(spark, [*rows, (None, "a b c")]), small=small, block=block).collect()
    want, sizes = brute_components(rows)
    assert len(got) == len(rows) + 1 and [r.component_id for r in got if r.id is None] == [None]
    assert {r.id: r.component_id for r in got if r.id is not None} == want
    assert all(r.n_shingles in sizes[r.id] and r.kept == (r.id == want[r.id]) for r in got if r.id is not None)


# --- 7 fingerprints -----------------------------------------------------------------

def test_fingerprints_are_multiset_sums(spark):
    texts = [(1, "a one.\nb two. c\n\nd"), (2, "d\nb two. c\na one."), (3, "a one."), (4, "b two. c\nd"), (5, "a one.\nb two. c\nd\nd")]
    got = {r.k: r for r in fingerprints.fingerprint_lanes(spark.createDataFrame(texts, "k long, text string"), ["k"], "text").collect()}
    assert got[1].wide == got[2].wide and got[1].signs == got[2].signs  # order does not matter
    assert got[1].wide == [(x + y) % 2**32 for x, y in zip(got[3].wide, got[4].wide)]
    assert got[5].wide != got[1].wide
    one, other = (spark.createDataFrame([(got[1].wide, got[3].wide)], "x array<long>, y array<long>"), got[4].wide)
    assert one.select(fingerprints.combined(F.col("x"), F.col("y"), 2**32, -1)).first()[0] == other


def test_edit_report(spark):
    rows = [r for r in AWKWARD if r[0] not in (None, 4, 8)]
    got = {r.doc_id: r for r in fingerprints.edit_report(awkward(spark, rows)).collect()}
    docs = sorted(pairs(rows), reverse=True)
    prints = collections.defaultdict(set)
    for k, (i, t) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[t].add(r.fingerprint)
        if t == after:
            assert r.near_next == 1
    assert all(len(p) == 1 for p in prints.values())
    assert got[6].near_edited > 0.2
    # A repeated row is one document; another text of the same id, and a null id, are documents too.
    assert fingerprints.edit_report(awkward(spark)).count() == len(set(pairs()))


# --- 8 exact dedup ---------------------------------------------------------------------

@pytest.mark.parametrize("first,growth", [(64, 16), (1, 2)])
def test_exact_dedup_keeps_one_of_each(spark, first, growth):
    got = exact_dedup.exact_dedup(awkward(spark, [r for r in AWKWARD if len(r[1] or "") < 9000 or growth > 2]), first_digit=first, growth=growth)
    assert got.select("row.*").columns == awkward(spark).columns
    found = got.collect()
    groups = collections.defaultdict(list)
    for r in found:
        groups[az(r.row.text or "")].append(r)
    for own in groups.values():
        ids = [r.row.doc_id for r in own if r.row.doc_id is not None]
        assert {r.group_size for r in own} == {len(own)} and {r.keep_id for r in own} == {max(ids) if ids else None}
        kept = [r for r in own if r.kept]
        assert len(kept) == 1 and kept[0].row.doc_id == (max(ids) if ids else None)


# --- 9 line dedup ------------------------------------------------------------------------

def test_line_dedup_equals_brute_force(spark):
    rows = [r for r in AWKWARD if r[0] not in (None, 4, 8)]
    got = {r.doc_id: r for r in line_dedup.drop_common_lines(awkward(spark, rows), slices=3).collect()}
    strip = lambda line: az(line.strip(line_dedup.BLANKS))
    holders = collections.defaultdict(set)
    for i, t in pairs(rows):
        for line in t.split("\n"):
            holders[strip(line)].add(i)
    for i, t in pairs(rows):
        lines = t.split("\n")
        kept = [x for x in lines if not (len(strip(x)) >= 40 and len(holders[strip(x)]) >= 5 and max(holders[strip(x)]) != i)]
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_text) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert got[10].n_dropped == 2 and got[15].n_dropped == 0
    assert line_dedup.drop_common_lines(awkward(spark)).count() == len(AWKWARD)


def test_line_bitmaps_of_long_documents(spark):
    rows = [(i, "\n".join(f"line {k} {'x' * 40}" if k % 3 == 0 else f"own {i} {k} {'y' * 40}" for k in range(300))) for i in range(5)]
    got = {r.doc_id: r for r in line_dedup.drop_common_lines(awkward(spark, rows)).collect()}
    assert [got[i].n_dropped for i in range(5)] == [100] * 4 + [0]
    assert got[0].kept_text == "\n".join(x for k, x in enumerate(rows[0][1].split("\n")) if k % 3)


def test_line_bitmaps_split_every_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    docs = awkward(spark).withColumn("text", seen.asNondeterministic()("text"))
    got = {r.id: r.n_dropped for r in line_dedup.line_bitmaps(docs).collect()}
    assert got == {10 + i: 2 for i in range(5)}
    assert read.value == len(AWKWARD)


# --- 10 toxicity -----------------------------------------------------------------------------

def test_segments_are_the_maximal_ones():
    rnd = random.Random(3)
    other = np.log(1 - toxicity.DENSITY)

    def brute(scores, lo, hi):
        best = max(((sum(scores[i:j + 1]), i - j, i, j) for i in range(lo, hi) for j in range(i, hi)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, i, j = best
        return brute(scores, lo, i) + [(i, j)] + brute(scores, j + 1, hi)

    for _ in range(200):
        scores = [rnd.uniform(.05, 3) if rnd.random() < .3 else other for _ in range(rnd.randint(1, 24))]
        got = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0], len(scores))
        assert [(i, j) for i, j, _ in got] == brute(scores, 0, len(scores))
        assert all(abs(s - sum(scores[i:j + 1])) < 1e-9 for i, j, s in got)


def test_toxicity_finds_passages_and_leaves_clean_texts(spark):
    rnd = random.Random(10)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(300):
        own = [rnd.choice(words) for _ in range(80)]
        if i % 5 == 0:
            for _ in range(4):
                own.insert(rnd.randrange(len(own)), rnd.choice(["vile", "Nasty"]))
        docs.append((i, " ".join(own)))
        labels.append((i, int(i % 5 == 0), "x"))
    labels += [(None, 1, "x"), (3, None, "x"), (999, 1, "x")]
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string"))
    assert set(model) == {"vile", "nasty"}
    test = spark.createDataFrame([(1, " ".join(words[:60] + ["vile", "nasty"] + words[60:120])), (2, " ".join(words)), (3, ""), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.t for r in test.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("t")).collect()}
    assert got[1].score > 0.9 and [(p["first"], p["last"]) for p in got[1].passages] == [(60, 61)]
    assert all(got[i].score == pytest.approx(toxicity.PRIOR) and not got[i].passages for i in (2, 3, 4))


def test_toxicity_held_out_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    scored = queries.op10_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    hits = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    # A few per cent of the labels are noise.
    assert hits[1, 1] > 0.75 * (hits[1, 1] + hits[1, 0]) and hits.get((0, 1), 0) < 0.01 * (hits[0, 0] + hits.get((0, 1), 0))


def test_toxicity_held_out_recall_of_each_language(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    scored = (queries.op10_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
              .join(queries.documents(spark, sf).select("doc_id", "lang"), "doc_id"))
    got = {r.lang: r for r in scored.where("toxic = 1").groupBy("lang").agg(F.count("*").alias("n"), F.sum("predicted").alias("hits")).collect()}
    assert set(got) == {"de", "en", "es", "fr"}
    assert all(r.hits >= 0.85 * r.n for r in got.values()), got


def test_toxicity_few_texts_give_a_model(spark):
    model = queries.toxic_model(spark, SF_SMALL)
    assert {"trash", "scum", "moron"} <= set(model)
    assert toxicity.judge("some words and trash scum moron here", model)[0] > toxicity.THRESHOLD


def test_toxicity_parts_of_words_and_their_chance():
    parts = set(toxicity.parts("nasty"))
    assert parts == {"na*", "nas*", "nast*", "*ty", "*sty", "*asty", "*as*", "*st*", "*ast*"}
    rnd = random.Random(5)
    for _ in range(300):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        ranks = {t: i for i, t in enumerate(rnd.sample(sorted(ts), min(len(ts), 4)))} if (ts := {word, *toxicity.parts(word + "ab")}) else {}
        own = [t for t in (word, *toxicity.parts(word)) if t in ranks]
        assert toxicity.finder(ranks)(word) == min(own, key=ranks.get, default=None)
    for toxic, clean, n1, n0 in ((4, 0, 9, 55), (3, 2, 10, 20), (7, 5, 8, 30), (1, 9, 10, 90)):
        k, n = toxic + clean, n1 + n0
        tail = sum(math.comb(n1, x) * math.comb(n0, k - x) for x in range(toxic, min(k, n1) + 1)) / math.comb(n, k)
        assert math.exp(toxicity.chance(toxic, clean, n1, n0)) == pytest.approx(tail if toxic * n > k * n1 else 1.0)


def test_near_dedup_links_exact_ties_of_large_sets_in_blocks():
    import pandas as pd
    m = 250_003  # 3 m of 4 m shingles are shared, and 100 * 3 m is not a float32
    a = np.arange(875_010, dtype="<u8")
    b = np.concatenate([np.arange(3 * m, dtype="<u8"), np.arange(10**6, 10**6 + 4 * m - len(a), dtype="<u8")])
    rows = pd.DataFrame({"block": [0, 1], "low": [0, 0], "high": [1, 1], "id": [1, 2], "shingles": [a.tobytes(), b.tobytes()]})
    assert len(near_dedup._block_links(rows, near_dedup.SKETCH, near_dedup.LEAST)) == 1
