import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrock.llm import toxicity as X


@pytest.mark.parametrize("lengths", [[1], [5, 1, 3], [7] * 3, [2] * 14 + [9], [1] * 20 + [12, 6]])
def test_marginals_are_those_of_all_taggings(lengths):
    draw = np.random.default_rng(len(lengths))
    lengths, a = np.array(lengths), np.exp(draw.normal(size=(2, 2)))
    odds = np.exp(draw.normal(size=lengths.sum()))
    found, start = X.marginals(odds, lengths, a), 0
    for n in lengths:
        total, hit = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            weight = np.prod([odds[start + k] if t else 1 for k, t in enumerate(tags)])
            weight *= np.prod([a[x, y] for x, y in zip(tags, tags[1:])])
            total, hit = total + weight, hit + weight * np.array(tags)
        assert np.allclose(found[start : start + n], hit / total)
        start += n


def text(toxic):
    words = [f"w{random.randrange(300)}" for _ in range(random.randint(20, 60))]
    if toxic:
        for _ in range(3):
            words.insert(random.randrange(len(words)), random.choice(["vile", "nastyish", "nastyest", "nastyly"]))
    return " ".join(w + ("." if random.random() < 0.1 else "") for w in words)


@pytest.fixture(scope="module")
def labelled(spark, docs):
    random.seed(6)
    toxic = {k: int(k % 6 == 0) for k in range(600)}
    return docs(*((k, text(t)) for k, t in toxic.items())), spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(labelled):
    return X.train(*labelled, ~X.held_out())


def test_held_out_documents(labelled, model):
    found = X.tag(labelled[0], model).where(X.held_out()).collect()
    right = [r["predicted"] == int(r["doc_id"] % 6 == 0) for r in found]
    assert sum(right) / len(right) > 0.98 and all(0 <= r["score"] <= 1 for r in found)


def test_spans_are_the_toxic_words(spark, docs, model):
    said = "w1 w2 vile nastyish w3. w4"
    r = X.tag(docs((1, f"é {said}")), model).first()
    assert [f"é {said}"[s["start"] : s["end"]] for s in r["spans"]] == ["vile nastyish"]
    # A form that no training row has is suspected by its beginning.
    new, plain = X.tag(docs((1, "w1 nastyfresh w2"), (2, "w1 other w2")), model).orderBy("doc_id").collect()
    assert new["score"] > plain["score"]


def test_odd_rows(docs, model):
    odd = docs((None, None), (1, ""), (2, " \n "), (3, "vile " * 60_000), (4, "ok"), (4, "ok"), (5, "!!! ..."), (6, "word " * 200_000))
    found = X.tag(odd, model).collect()
    assert len(found) == 8 and all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (None, 1, 2)}
    assert len(empty) == 1 and empty.pop() < X.THRESHOLD
    assert {r["predicted"] for r in found if r["doc_id"] == 3} == {1}
    assert X.tag(docs(), model).count() == 0


def test_without_labels_nothing_is_toxic(spark, docs):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    documents = docs((1, "a"), (2, "vile"))
    model = X.train(documents, labels, F.lit(True))
    assert model is None and {(r["score"], r["predicted"]) for r in X.tag(documents, model).collect()} == {(0.0, 0)}
