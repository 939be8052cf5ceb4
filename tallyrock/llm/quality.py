"""Quality scores learned from preference pairs by the Bradley-Terry model.

A good and a bad labelled document make a pair; the model is the linear score
whose differences best explain, under logistic loss, which of two documents is
preferred. The score at the share of bad labels, as a quantile of the labelled
documents, is the threshold: it maps to THRESHOLD, and the slope of the map
comes from the labels.

Only the text is an input. The model is fitted on at most `max_rows` labelled
rows, those with the smallest hash of their id, and on `max_pairs` pairs drawn
from them with a fixed seed. Labels other than 0 and 1 and labels without an id
are left out; of several labels of an id the highest counts. Without labels of
both kinds every score is 0.5 and every document is kept. NULL text counts as
empty and gets a score like any other. Repeated rows are scored one by one, and
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.llm.common import Numbered, crc_mod, gather, map_rows, read

THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 5, 0
MAX_ROWS = 12_000
MAX_PAIRS = 60_000
SHAPES = 96
PLAIN = 20
FEATURES = PLAIN + SHAPES

KEEP_RUNS = re.compile(r"(.)\1+", re.S)
CHAR_KINDS = str.maketrans(
    {c: "0" for c in "0123456789"} | {c: "x" for c in "abcdefghijklmnopqrstuvwxyz"} | {c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
)


def shape(word: str) -> int:
    """The place of a word's outline: letters and digits by kind, runs cut to one."""
    kinds = "".join(c if c < "\x80" else "x" if c.islower() else "X" if c.isupper() else "w" for c in word)
    return zlib.crc32(KEEP_RUNS.sub(r"\1", kinds.translate(CHAR_KINDS)).encode()) % SHAPES


def features(text: str, shapes: Numbered) -> np.ndarray:
    found = np.zeros(FEATURES)
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        found[0] = 1
        return found
    places = gather(shapes, words, np.int64)
    lines = text.split("\n")
    counts = Counter(words)
    top = counts.most_common(1)[0][1]
    same = sum(map(str.__eq__, words, words[1:]))
    pairs = Counter(zip(words, words[1:]))
    upper = sum(map(str.isupper, words))
    title = sum(map(str.istitle, words))
    letters = len(text.translate(NOT_LETTERS))
    filled = [line for line in lines if line.strip()]
    found[1:PLAIN] = (
        min(n, 40) / 40,
        np.log1p(n) / 10,
        sum(map(len, words)) / n / 10,
        upper / n,
        title / n,
        same / n,
        len(counts) / n,
        len(counts) / n**0.75,
        top / n,
        1 - len(pairs) / n,
        (size - letters) / size,
        sum(text.count(c) for c in "#*$%&|<>") / size,
        text.count("!") / n,
        sum(text.count(c) for c in ".,;:") / n,
        sum(text.count(c) for c in "0123456789") / size,
        1 - len(set(filled)) / len(filled),
        min(1, len(filled) / n * 5),
        text.count("|") / n,
        sum(len(w) > 24 for w in counts) / n,
    )
    found[PLAIN:] = np.sqrt(np.bincount(places, minlength=SHAPES) / n)
    return found


NOT_LETTERS = {c: None for c in range(0x80) if not chr(c).isalpha()}


@dataclass
class Model:
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, THRESHOLD at the threshold of the ranking."""
        z = self.slope * (rows @ self.weights - self.threshold) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, max_pairs: int = MAX_PAIRS, ridge: float = 3.0) -> Model | None:
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return None
    draw = np.random.default_rng(7)
    left, right = draw.choice(good, max_pairs), draw.choice(bad, max_pairs)
    weights = np.zeros(rows.shape[1])
    for _ in range(12):  # Newton steps on the logistic loss of the differences
        gradient, hessian = ridge * weights, ridge * np.eye(len(weights))
        for start in range(0, max_pairs, 8192):
            d = rows[left[start : start + 8192]] - rows[right[start : start + 8192]]
            p = 1 / (1 + np.exp(np.clip(d @ weights, -30, 30)))
            gradient -= d.T @ p
            hessian += d.T @ (d * (p * (1 - p))[:, None])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    raw = rows @ weights
    threshold = float(np.quantile(raw, len(bad) / len(labels)))
    return Model(weights, threshold, slope(raw - threshold, labels))


def slope(raw: np.ndarray, labels: np.ndarray) -> float:
    """The steepness that makes the scores most likely, given the threshold."""
    offset, candidates = np.log(THRESHOLD / (1 - THRESHOLD)), np.geomspace(0.05, 20, 60)

    def loss(k):
        z = np.where(labels == 1, 1, -1) * np.clip(k * raw + offset, -30, 30)
        return np.log1p(np.exp(-z)).sum()

    return float(min(candidates, key=loss))


def feature_rows(documents: DataFrame, *kept: str, types: str = "") -> DataFrame:
    """The kept columns and `features`, an array of FEATURES numbers, of each document."""
    state: dict = {}

    def work(columns: list[list]) -> list[list]:
        shapes = state.setdefault("shapes", Numbered(shape))
        return [*columns[:-1], [features(t or "", shapes) for t in columns[-1]]]

    return map_rows(documents.select(*kept, "text"), work, f"{types}features array<double>")


def labelled_sample(labels: DataFrame, column: str, training: Column, max_rows: int) -> DataFrame:
    """At most `max_rows` (doc_id, label), those with the smallest hash of the id."""
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & training)
    one = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def train(documents: DataFrame, labels: DataFrame, training: Column, max_rows: int = MAX_ROWS) -> Model | None:
    """The model of the labelled rows for which `training`, a condition on doc_id, holds."""
    sample = labelled_sample(labels, "quality", training, max_rows)
    # The sample is bounded by max_rows, so it is small enough to broadcast.
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    rows = feature_rows(texts, "label", types="label int, ").toPandas()
    if not len(rows):
        return None
    return fit(np.stack(rows["features"].to_numpy()), rows["label"].to_numpy())


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    state: dict = {}

    def work(columns: list[list]) -> list[list]:
        shapes = state.setdefault("shapes", Numbered(shape))
        ids, texts = columns
        if model is None or not ids:
            return [ids, [0.5] * len(ids), [1] * len(ids)]
        found = model.scores(np.stack([features(t or "", shapes) for t in texts]))
        return [ids, found, (found >= THRESHOLD).astype(np.int32)]

    return map_rows(documents.select("doc_id", "text"), work, "doc_id long, score double, predicted int")


def held_out() -> Column:
    return crc_mod("doc_id", FOLDS) == HELD_OUT_FOLD


def op1_bradley_terry(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    model = train(documents, read(spark, folder, "labels", "doc_id", "quality"), ~held_out())
    return score(documents, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents, with all their columns, that the model does not reject."""
    state: dict = {}

    def batches(parts):
        shapes = state.setdefault("shapes", Numbered(shape))
        for part in parts:
            for start in range(0, part.num_rows, 1024):
                piece = part.slice(start, 1024)
                texts = piece.column(piece.schema.get_field_index("text")).to_pylist()
                if model is None:
                    yield piece
                else:
                    found = model.scores(np.stack([features(t or "", shapes) for t in texts]))
                    yield piece.filter(pa.array(found >= THRESHOLD))


    return documents.mapInArrow(batches, documents.schema)
