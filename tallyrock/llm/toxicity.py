"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

The labels are of documents, so tokens are labelled first: in a toxic document
of the training rows, a token is toxic if it, or a beginning of it, is much more
frequent in toxic documents than in others; all other tokens are not. A chain
with two tags is fitted on these sentences: a token's own evidence comes from
its form and its beginnings, its neighbours' from the transitions. Forward and
backward passes give every token of every document its exact marginal; sums and
maxima of these, weighed by a logistic fit to the document labels, are the score.
Runs of tokens with a marginal of at least SPAN_LEVEL are the offending spans.

Only the text is an input. Training uses at most `max_rows` labelled rows, those
with the smallest hash of their id, and at most `max_tokens` of their tokens.
Labels other than 0 and 1 and labels without an id are left out; of several
labels of an id the highest counts. Without labels of both kinds every score is
0 and there are no spans. NULL text counts as empty, and gets the score of a
text without evidence. Repeated rows are scored one by one; an empty table gives
no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.llm.common import Numbered, crc_mod, gather, map_rows, read
from tallyrock.llm.quality import labelled_sample

THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
MAX_ROWS = 10_000
MAX_TOKENS = 400_000
SPAN_LEVEL = 0.5
BUCKETS = 1 << 18
PREFIXES = range(3, 9)
CERTAINTY = 4.2  # root of the likelihood ratio, for a form to label tokens
PRECISION = 0.7  # of the documents with a form, so many must be toxic

TOKEN = re.compile(r"\S+")
EDGES = ".,;:!?\"'()[]{}|#*$%&<>"
ENDS_SENTENCE = 1000.0  # added to a cached score, far beyond any score itself
LIMIT = 30.0


def forms(token: str) -> list[str]:
    """The token's word and its beginnings."""
    word = token.strip(EDGES).lower()
    return [word, *(f"{word[:k]}-" for k in PREFIXES if len(word) > k)] if word else []


def buckets(token: str) -> list[int]:
    return [zlib.crc32(form.encode()) % BUCKETS for form in forms(token)]


@dataclass
class Chain:
    """Weights of the forms, a bias, and log weights of transitions from tag to tag."""

    weights: np.ndarray
    bias: float
    transitions: np.ndarray

    def evidence(self, token: str) -> float:
        score = self.bias + float(self.weights[buckets(token)].sum())
        return min(LIMIT, max(-LIMIT, score)) + ENDS_SENTENCE * (token[-1] in ".!?")


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts of the sequences, longest first; how many have a token at each step; how many steps go side by side."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    steps = np.arange(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -steps, side="left")
    return starts[order], active, int((active >= 12).sum())


def passes(odds: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of tag 1 at each token; `odds` is the token's own, `a` the transition weights.

    Sequences go side by side, a step of all at a time; where only a few long ones are left they go one by one.
    """
    starts, active, together = layout(lengths)
    x, y = np.empty_like(odds), np.ones_like(odds)
    (a00, a01), (a10, a11) = a.tolist()
    for t in range(together):
        at = starts[: active[t]] + t
        if t == 0:
            x[at] = odds[at]
        else:
            last = x[at - 1]
            x[at] = odds[at] * (a01 + last * a11) / (a00 + last * a10)
    rest = active[together] if together < len(active) else 0
    ordered = np.sort(lengths)[::-1]
    for start, length in zip(starts[:rest].tolist(), ordered[:rest].tolist()):
        own, done = odds[start : start + length].tolist(), x[start : start + length]
        now = done[together - 1] if together else None
        tail = []
        for t in range(together, length):
            now = own[t] * (a01 + now * a11) / (a00 + now * a10) if t else own[0]
            tail.append(now)
        done[together:] = tail
        now, tail = 1.0, [1.0]
        for t in range(length - 2, together - 2 if together else -1, -1):
            z = own[t + 1] * now
            now = (a10 + a11 * z) / (a00 + a01 * z)
            tail.append(now)
        tail.reverse()
        y[start + length - len(tail) : start + length] = tail
    for t in range(together - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        z = odds[at + 1] * y[at + 1]
        y[at] = (a10 + a11 * z) / (a00 + a01 * z)
    return x, y


def marginals(odds: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> np.ndarray:
    x, y = passes(odds, lengths, a)
    both = x * y
    return both / (1 + both)


def sentence_lengths(ends: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Lengths of the sentences of tokens in a row; a sentence also ends where its document does."""
    last = ends.copy()
    last[np.cumsum(documents)[documents > 0] - 1] = True
    places = np.flatnonzero(last)
    return np.diff(np.concatenate([[-1], places]))


def family(text: str) -> object:
    """The same for nearly all copies and near copies of a text: its smallest hash of three words in a row."""
    words = text.split()
    return min((zlib.crc32(" ".join(words[k : k + 3]).encode()) for k in range(len(words) - 2)), default=text)


def toxic_forms(texts: list[str], labels: np.ndarray) -> set[str]:
    """Forms that surely prefer toxic documents, by the likelihood ratio; copies of a text count once."""

    def of(text: str) -> set[str]:
        return {form for token in set(text.split()) for form in forms(token)}

    toxic, clean = Counter(), Counter()
    single = {(family(text), int(label)): text for text, label in zip(texts, labels)}
    for (_, label), text in single.items():
        if label == 1:
            toxic.update(of(text))
    candidates = {form for form, n in toxic.items() if n >= 3}
    for (_, label), text in single.items():
        if label == 0:
            clean.update(of(text) & candidates)
    share = sum(label for _, label in single) / len(single)

    def certain(form: str) -> bool:
        a, b = toxic[form], clean[form]
        ratio = 2 * (a * np.log(a / (a + b) / share) + (b * np.log(b / (a + b) / (1 - share)) if b else 0))
        return a / (a + b) >= PRECISION and ratio >= CERTAINTY**2

    return {form for form in candidates if certain(form)}


def fit_chain(texts: list[str], labels: np.ndarray, max_tokens: int = MAX_TOKENS, rounds: int = 60) -> Chain:
    """The chain that best explains the labelled tokens, by gradient steps of adaptive size."""
    known = toxic_forms(texts, labels)
    order = sorted(range(len(texts)), key=lambda i: (-labels[i], i))  # toxic documents first
    tokens, tags, sizes = [], [], []
    budget = {1: max_tokens // 2, 0: max_tokens // 2}
    for i in order:
        words = texts[i].split()
        if 0 < len(words) <= budget[int(labels[i])]:
            budget[int(labels[i])] -= len(words)
            tokens += words
            tags += [labels[i] == 1 and not known.isdisjoint(forms(w)) for w in words]
            sizes.append(len(words))
    y = np.array(tags, dtype=float)
    ends = np.array([w[-1] in ".!?" for w in tokens], dtype=bool)
    lengths = sentence_lengths(ends, np.array(sizes))
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.ones(len(tokens), dtype=bool)
    inside[firsts] = False  # tokens with one before them
    cache = Numbered(buckets)
    lists = [cache[w] for w in tokens]
    widths = np.array([len(x) for x in lists])
    flat = np.array([b for x in lists for b in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(tokens)), widths)

    chain = Chain(np.zeros(BUCKETS), -4.0, np.zeros((2, 2)))
    sums = {"w": np.full(BUCKETS, 1e-8), "b": 1e-8, "t": np.full((2, 2), 1e-8)}
    pairs = np.zeros((2, 2))
    before, after = y[:-1][inside[1:]], y[1:][inside[1:]]
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = ((before == i) & (after == j)).sum()
    for _ in range(rounds):
        u = chain.bias + np.bincount(owner, chain.weights[flat], minlength=len(tokens))
        odds, a = np.exp(np.clip(u, -LIMIT, LIMIT)), np.exp(chain.transitions)
        x, back = passes(odds, lengths, a)
        p = x * back / (1 + x * back)
        g = y - p
        here, z = x[:-1][inside[1:]], (odds * back)[1:][inside[1:]]
        joint = np.stack([a[0, 0] + 0 * z, a[0, 1] * z, here * a[1, 0], here * a[1, 1] * z])
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        steps = {
            "w": np.bincount(flat, g[owner], minlength=BUCKETS) - 0.5 * chain.weights,
            "b": g.sum() - 0.01 * chain.bias,
            "t": pairs - expected - chain.transitions,
        }
        for name, step in steps.items():
            sums[name] = sums[name] + step**2
            move = 0.5 * step / np.sqrt(sums[name])
            if name == "w":
                chain.weights += move
            elif name == "b":
                chain.bias += float(move)
            else:
                chain.transitions += move
    return chain


def evidence_rows(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What a document's score is made of: its highest, summed and mean marginals."""
    rows = np.zeros((len(sizes), 5))
    rows[:, 0] = 1
    filled = sizes > 0
    if filled.any():
        starts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        top, total = np.maximum.reduceat(p, starts), np.add.reduceat(p, starts)
        rows[filled, 1:] = np.stack([top, np.log1p(total), np.minimum(total, 3) / 3, total / sizes[filled] * 10], axis=1)
    return rows


@dataclass
class Model:
    chain: Chain
    weights: np.ndarray
    state: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"state": {}}

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Marginals of all tokens in a row, the number of tokens of each text, and the tokens."""
        cache = self.state.setdefault("cache", Numbered(self.chain.evidence))
        words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        if not sizes.sum():
            return np.zeros(0), sizes, words
        scores = np.concatenate([gather(cache, w, np.float64) for w in words])
        ends = scores > ENDS_SENTENCE / 2
        odds = np.exp(scores - ENDS_SENTENCE * ends)
        lengths = sentence_lengths(ends, sizes)
        return marginals(odds, lengths, np.exp(self.chain.transitions)), sizes, words

    def scores(self, p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence_rows(p, sizes) @ self.weights, -LIMIT, LIMIT)))


def fit(texts: list[str], labels: np.ndarray) -> Model | None:
    if len(set(labels.tolist())) < 2:
        return None
    model = Model(fit_chain(texts, labels), np.zeros(5))
    rows = np.concatenate([
        evidence_rows(*model.tokens(texts[k : k + 512])[:2]) for k in range(0, len(texts), 512)
    ])
    w = model.weights
    for _ in range(25):  # Newton steps of a logistic fit
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -LIMIT, LIMIT)))
        hessian = rows.T @ (rows * (p * (1 - p))[:, None]) + 0.5 * np.eye(len(w))
        step = np.linalg.solve(hessian, rows.T @ (labels - p) - 0.5 * w)
        w = w + np.clip(step, -3, 3)
    model.weights = w
    return model


def train(documents: DataFrame, labels: DataFrame, training: Column, max_rows: int = MAX_ROWS) -> Model | None:
    """The model of the labelled rows for which `training`, a condition on doc_id, holds."""
    sample = labelled_sample(labels, "toxic", training, max_rows)
    # The sample is bounded by max_rows, so it is small enough to broadcast.
    joined = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])
    rows = joined.orderBy("doc_id").toPandas()
    return fit([t or "" for t in rows["text"]], rows["label"].to_numpy())


def spans_of(text: str, p: np.ndarray, level: float = SPAN_LEVEL) -> list[dict]:
    """Runs of tokens with marginals of at least `level`, as code point offsets into the text."""
    found, run = [], None
    for token, value in zip(TOKEN.finditer(text), p):
        if value >= level and run:
            run = {"start": run["start"], "end": token.end(), "score": max(run["score"], float(value))}
        elif value >= level:
            run = {"start": token.start(), "end": token.end(), "score": float(value)}
        elif run:
            found.append(run)
            run = None
    return [*found, run] if run else found


def tag(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted, spans) of every document; spans have start, end and their highest marginal."""

    def work(columns: list[list]) -> list[list]:
        ids, texts = columns[0], [t or "" for t in columns[1]]
        if model is None or not ids:
            return [ids, [0.0] * len(ids), [0] * len(ids), [[]] * len(ids)]
        p, sizes, _ = model.tokens(texts)
        found, starts = model.scores(p, sizes), np.concatenate([[0], np.cumsum(sizes)])
        own = [p[starts[i] : starts[i + 1]] for i in range(len(ids))]
        spans = [spans_of(t, q) if len(q) and q.max() >= SPAN_LEVEL else [] for t, q in zip(texts, own)]
        return [ids, found, (found >= THRESHOLD).astype(np.int32), spans]

    return map_rows(
        documents.select("doc_id", "text"),
        work,
        "doc_id long, score double, predicted int, spans array<struct<start: int, end: int, score: double>>",
        rows=512,
    )


def held_out() -> Column:
    return crc_mod("doc_id", FOLDS) == HELD_OUT_FOLD


def op5_crf_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    model = train(documents, read(spark, folder, "labels", "doc_id", "toxic"), ~held_out())
    return tag(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans")
    )
