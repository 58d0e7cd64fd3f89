"""What the pipeline's stages hold at once, and what a Python worker gives back."""

import ctypes
import subprocess
import sys

import pytest

import corpus_pipeline
from sluice.llm import common

from ..conftest import ROOT, SF_SMALL

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
READ = "spark.sql.parquet.columnarReaderBatchSize"


@pytest.fixture
def settings(spark):
    """The test's own settings, taken back afterwards."""
    yield spark.conf
    for key in (ROWS, READ):
        spark.conf.unset(key)


def most_rows(spark) -> int:
    """Rows of the largest batch that a worker gets."""
    def count(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return spark.range(0, 3000, 1, 1).mapInArrow(count, "n long").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("name", ["toxicity", "near dedup", "packing"])
@pytest.mark.parametrize("before, after", [(10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (100, 100)])
def test_workers_get_small_batches(spark, settings, monkeypatch, name, before, after):
    # What a stage does with its rows is tested elsewhere.
    monkeypatch.setattr(corpus_pipeline, "toxic_model", lambda *_: {})
    monkeypatch.setattr(corpus_pipeline.near, "near_dedup", lambda docs: docs.selectExpr("true AS kept", "doc_id AS id"))
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs, *_, **__: docs)
    settings.set(ROWS, before)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    dict(corpus_pipeline.STAGES)[name](spark, docs, SF_SMALL)
    assert most_rows(spark) == after
    assert int(spark.conf.get(READ)) == common.BATCH_ROWS


def test_row_groups_of_written_tables_are_bounded(spark):
    import glob

    import pyarrow.parquet as pq

    # 40 MB of text that no encoding makes smaller.
    df = spark.range(0, 10_000, 1, 1).selectExpr("id", "concat_ws('', transform(sequence(1, 64), k -> sha2(concat(id, '-', k), 256))) AS text")
    again = common.written(df, "row-groups")
    sizes = [group.total_byte_size for path in again.inputFiles() for name in glob.glob(path.removeprefix("file://"))
             for meta in [pq.read_metadata(name)] for group in map(meta.row_group, range(meta.num_row_groups))]
    assert sum(sizes) > 4 * common.ROW_GROUP and max(sizes) <= 1.5 * common.ROW_GROUP
    assert again.exceptAll(df).count() == 0 == df.exceptAll(again).count()


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="another C library")
def test_a_worker_gives_back_what_an_earlier_operator_kept():
    code = """
from sluice.llm.common import kept_in_worker

def mb():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

# Blocks that the C library keeps when they are freed: one that stays lies behind them.
kept_in_worker("first", lambda: [bytearray(b"x" * 60_000) for _ in range(4000)])
last = bytearray(b"x" * 60_000)
before = mb()
kept_in_worker("second", dict)
print(before - mb())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert int(out.stdout) > 200, out.stderr
