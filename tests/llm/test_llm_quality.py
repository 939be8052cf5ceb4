import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrock.llm import quality

GOOD = "The quiet river ran past the old mill, and people came to see it. They walked on.\nThen it rained for days."
BAD = "BUY!! NOW!! ### $$$ WIN!! WIN!! WIN!! ### CHEAP!! | | | ### $$$"


@pytest.fixture(scope="module")
def labelled(spark, docs):
    rows = [(i, f"{GOOD if i % 3 else BAD} word{i} item{i * 7}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    return docs(*rows), labels


def test_bad_documents_score_low(labelled):
    documents, labels = labelled
    model = quality.train(documents, labels, ~quality.held_out())
    found = quality.score(documents, model).withColumn("held_out", quality.held_out()).collect()
    assert {r["predicted"] == (r["doc_id"] % 3 > 0) for r in found if r["held_out"]} == {True}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_the_threshold_is_a_quantile():
    rows, labels = np.random.default_rng(1).normal(size=(400, 3)), np.repeat([0, 1, 1, 1], 100)
    rows[:, 0] += 3 * labels
    model = quality.fit(rows, labels, max_pairs=2000)
    assert abs((model.scores(rows) < quality.THRESHOLD).mean() - 0.25) < 0.01


def test_odd_rows(spark, docs, labelled, rows_of):
    model = quality.train(*labelled, ~quality.held_out())
    odd = docs((None, None), (1, ""), (1, " \n"), (2, GOOD), (2, GOOD), (3, "wort " * 200_000), (4, "\U0001f600" * 9))
    found = quality.score(odd, model)
    assert found.count() == 7 and found.where("score IS NULL OR isnan(score)").count() == 0
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and kept.where("doc_id = 2").count() == 2
    assert quality.score(docs(), model).count() == 0


def test_without_labels_all_stay(spark, docs):
    none = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 5)], "doc_id long, quality int")
    documents = docs((1, GOOD), (2, BAD), (None, None))
    model = quality.train(documents, none, F.lit(True))
    assert model is None
    assert [tuple(r)[1:] for r in quality.score(documents, model).collect()] == [(0.5, 1)] * 3
    assert quality.keep_good(documents, model).count() == 3
