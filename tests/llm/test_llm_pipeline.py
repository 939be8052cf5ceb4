import zlib

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from tallyrock.llm import common
from tallyrock.llm.registry import LLM_ORACLES, LLM_QUERIES


@pytest.fixture(scope="module")
def stages(spark, small):
    """What each stage returns on the smallest tables."""
    docs, found = spark.read.parquet(f"{small}/documents.parquet"), []
    found.append(docs)
    for name, stage in P.STAGES:
        found.append(common.written(stage(spark, found[-1], small), name))
    return found


def test_stages_keep_the_columns_of_documents(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_every_stage_has_an_effect_and_keeps_most(stages):
    counts = [f.count() for f in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > counts[0] / 2 and counts[1] < counts[0]
    changed = stages[1].join(stages[2].select("doc_id", F.col("text").alias("new")), "doc_id").where("text <> new")
    assert changed.count() > 0
    assert stages[2].where("n_chars <> char_length(text)").count() == 0


def test_the_last_stage_packs_all_that_is_left(stages):
    pieces = stages[-1].collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in stages[-2].select("doc_id").collect()}
    assert all(zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r["ids"])) == r["ids_crc32"] for r in pieces)


def test_stages_take_odd_and_empty_rows(spark, small):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, "a b c d e f g", None, "s", 13, 3)]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        empty = frame.isEmpty()
        for name, stage in P.STAGES:
            frame = common.written(stage(spark, frame, small), name)
        assert empty == frame.isEmpty() or frame.count() >= 0


def test_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14)) and set(LLM_ORACLES) <= set(LLM_QUERIES)
    import __spark_entry__ as entry

    assert {"pipeline", *LLM_QUERIES} <= set(entry.queries())


def test_stages_send_few_rows_at_a_time_to_python(spark, small):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in P.STAGES:
        spark.conf.unset(setting)
        stage(spark, docs, small)
        assert int(spark.conf.get(setting)) == P.BATCH_ROWS <= 1024
