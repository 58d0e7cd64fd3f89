"""The stages of the pipeline one by one, and the whole of it on a small table."""

import pytest

import corpus_pipeline
from sluice.llm import queries, toxicity

from ..conftest import SF_MID
from .test_operators import AWKWARD, awkward


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def test_stage_names_and_sql(stages):
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_tables_pass_every_stage(spark, stages, rows):
    docs = awkward(spark, AWKWARD).where("true" if rows else "false")
    for name in ("toxicity", "exact dedup", "near dedup"):
        out = stages[name](spark, docs, SF_MID)
        assert out.columns == docs.columns
        out.count()
    texts = [r.text for r in stages["exact dedup"](spark, docs, SF_MID).collect()]
    assert len({(t or "").lower() for t in texts}) == len(texts)
    pieces = stages["packing"](spark, docs, SF_MID)
    assert pieces.selectExpr("coalesce(sum(if(start = 0, 1, 0)), 0)").first()[0] == len(rows)


def test_each_stage_does_its_work(spark, stages):
    docs = queries.documents(spark, SF_MID)
    model = queries.toxic_model(spark, SF_MID)
    want = {r.doc_id for r in docs.collect() if toxicity.judge(r.text, model)[0] < toxicity.THRESHOLD}
    clean = stages["toxicity"](spark, docs, SF_MID)
    assert {r.doc_id for r in clean.collect()} == want and len(want) < docs.count()
    exact = {}
    for r in clean.collect():
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        exact[key] = max(exact.get(key, -1), r.doc_id)
    assert {r.doc_id for r in stages["exact dedup"](spark, clean, SF_MID).collect()} == set(exact.values())


def test_run_ends_with_the_pieces_of_kept_documents(spark):
    out = corpus_pipeline.run(spark, SF_MID)
    got = out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert got and all(r["sum(length)"] == r["max(doc_tokens)"] for r in got)
    total = queries.documents(spark, SF_MID).count()
    assert 0.7 * total < len(got) < total
