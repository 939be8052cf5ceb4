"""Benchmark decontamination: a BM25 index of test items, searched by every passage of the corpus.

The items are the indexed texts and the passages the queries. A passage retrieves
every item whose BM25 score is at least `share` of the item's own, which is the
most that any passage can score. The search is block-max WAND over many passages
side by side: a passage's terms have a highest weight over all items and one per
block of items; a passage whose sum of bounds stays below the threshold is done,
and so is a block; only what is left is scored. Nothing above the threshold is
lost. Each retrieved item is then verified: enough of its question's word
sequences and of its answer's words must stand in the passage.

Passages are `width` words and start every width/2 words, so every run of width/2
words is whole in one. Items are classed by length, and each class is an index of its
own whose width is at least twice its longest item: an item that stands in a
document lies whole in one passage, whatever its length and offset.

Document frequencies and the mean length are counted over all items by Spark. The items are read
to the driver in parts of at most `part_items` rows and `part_bytes` of text, one part at a time: its index
is built, sent, searched and released before the next one. As the statistics are the same for all, the number of parts does
not change any score. Items that repeat with the same id and text count once. Items
and documents with NULL or empty text match nothing; NULL ids are kept as they
are. Repeated documents are searched one by one. Case does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.llm.common import map_rows, read, unused, with_may_be_among, written
from tallyrock.session import scratch_path

K1, B = 1.2, 0.75
SHARE = 0.6
WIDTH = 128
BLOCK = 16
CELLS = 1 << 22  # bounds of blocks that are held at a time
PART_ITEMS = 50_000
PART_BYTES = 64 * 1024 * 1024
SEQUENCE = 5
MIN_QUESTION, MIN_ANSWER = 0.5, 0.5


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's last sentence is its answer; of a single sentence, the last quarter."""
    words = words_of(text)
    ends = [k + 1 for k, w in enumerate(words[:-1]) if w[-1] in ".!?"]
    cut = ends[-1] if ends else len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def sequences(words: list[str]) -> set[tuple[str, ...]]:
    size = min(SEQUENCE, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if size else set()


def width_for(words: int) -> int:
    """The width of passages for items of so many words: twice the next power of two, at least WIDTH."""
    return max(WIDTH, 2 << max(0, words - 1).bit_length())


@dataclass
class Totals:
    """What the weights need to know of all items; df may hold the terms of some only."""

    items: int
    mean: float  # words
    df: dict[str, int]


def totals_of(texts: list[str]) -> Totals:
    df: dict[str, int] = {}
    items = total = 0
    for own in filter(None, map(words_of, texts)):
        items, total = items + 1, total + len(own)
        for w in set(own):
            df[w] = df.get(w, 0) + 1
    return Totals(items, total / max(1, items), df)


@dataclass
class Index:
    """Postings of the items' terms, scaled so that the threshold of every item is 1.

    Everything is as long as the postings or shorter; nothing is kept for a term in a block without it.
    """

    terms: dict[str, int]
    items: np.ndarray  # of each posting, by term and item
    cells: np.ndarray  # term and block of each posting, as one number
    weights: np.ndarray
    highest: np.ndarray  # of each term over all items
    starts: np.ndarray  # of each term among the bounds
    bound_blocks: np.ndarray  # the blocks that a term occurs in, term by term
    bounds: np.ndarray  # the highest weight of the term there
    ids: list
    texts: list[str]
    blocks: int
    width: int = WIDTH  # of the passages that search it


def build(
    ids: list, texts: list[str], share: float = SHARE, block: int = BLOCK, totals: Totals | None = None
) -> Index | None:
    """The index of some items, whose statistics are `totals` or else their own."""
    totals = totals or totals_of(texts)
    sizes = np.array([len(words_of(t)) for t in texts], np.int64)
    # Items alike in length share a block.
    kept = sorted(np.flatnonzero(sizes).tolist(), key=lambda i: (sizes[i], texts[i]))
    if not kept:
        return None
    ids, texts, sizes = [ids[i] for i in kept], [texts[i] for i in kept], sizes[kept].astype(float)
    # In order, so that the sums over an item's terms are the same whatever other items the index has.
    terms = {w: k for k, w in enumerate(sorted({w for text in texts for w in words_of(text)}))}
    pairs, counts = [], []
    for item, text in enumerate(texts):
        own = [terms[w] for w in words_of(text)]
        term, tf = np.unique(np.array(own, np.int64), return_counts=True)
        pairs.append(term * len(texts) + item)
        counts.append(tf)
    pairs, tf = np.concatenate(pairs), np.concatenate(counts).astype(float)
    order = np.argsort(pairs, kind="stable")
    term, item, tf = pairs[order] // len(texts), pairs[order] % len(texts), tf[order]
    df = np.fromiter(map(totals.df.__getitem__, terms), float, len(terms))
    idf = np.log(1 + (totals.items - df + 0.5) / (df + 0.5))
    weights = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[item] / totals.mean))
    weights /= share * np.bincount(item, weights, minlength=len(ids))[item]
    blocks = (len(ids) + block - 1) // block
    cells = term * blocks + item // block
    firsts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    bounds = np.maximum.reduceat(weights, firsts)
    starts = np.searchsorted(cells[firsts], np.arange(len(terms) + 1) * blocks)
    highest = np.maximum.reduceat(bounds, starts[:-1])
    width = width_for(int(sizes.max()))
    return Index(terms, item, cells, weights, highest, starts, cells[firsts] % blocks, bounds, ids, texts, blocks, width)


def build_classes(ids: list, texts: list[str], totals: Totals | None = None) -> list[Index]:
    """An index for each class of items whose passages are of one width, all with the same statistics."""
    totals, classes = totals or totals_of(texts), {}
    for item, text in zip(ids, texts):
        if size := len(words_of(text)):
            classes.setdefault(width_for(size), []).append((item, text))
    return [build(*map(list, zip(*classes[width])), totals=totals) for width in sorted(classes)]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, passages: int, block: int = BLOCK):
    """(passage, item, score) with score >= 1 of distinct (passage, term) pairs, sorted by passage."""
    floor = 1 - 1e-9
    alive = np.bincount(passage, index.highest[term], minlength=passages) >= floor
    on = alive[passage]
    passage, term = passage[on], term[on]
    if not len(passage):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    firsts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    many = index.starts[term + 1] - index.starts[term]
    if max(many.sum(), len(firsts) * index.blocks) > CELLS and len(firsts) > 1:
        cut = firsts[len(firsts) // 2]
        halves = [retrieve(index, passage[s], term[s], passages, block) for s in (slice(cut), slice(cut, None))]
        return tuple(np.concatenate(columns) for columns in zip(*halves))
    # The bounds of a passage's terms, added up by the blocks in which they occur.
    at = spread(index.starts[term], many)
    sizes = np.diff(np.append(firsts, len(passage)))
    row = np.repeat(np.repeat(np.arange(len(firsts)), sizes), many)
    sums = np.bincount(row * index.blocks + index.bound_blocks[at], index.bounds[at], minlength=len(firsts) * index.blocks)
    rows, blocks = np.divmod(np.flatnonzero(sums >= floor), index.blocks)
    # What is left is scored side by side: the postings of each (passage, block) for each of its terms.
    sizes = sizes[rows]
    pair = np.repeat(np.arange(len(rows)), sizes)
    key = term[spread(firsts[rows], sizes)] * index.blocks + blocks[pair]
    lo, hi = np.searchsorted(index.cells, key), np.searchsorted(index.cells, key, side="right")
    pair, lo, many = pair[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    posting = spread(lo, many)
    place = np.repeat(pair, many) * block + index.items[posting] % block
    scores = np.bincount(place, index.weights[posting], minlength=len(rows) * block)
    found = np.flatnonzero(scores >= floor)
    return passage[firsts[rows[found // block]]], blocks[found // block] * block + found % block, scores[found]


def search(index: Index, texts: list[str | None], share: float = SHARE, width: int | None = None) -> list[tuple]:
    """(row, item, share of the item's own score, question overlap, answer overlap), verified, best passage each."""
    width = width or index.width
    step = width // 2
    words = [words_of(t) for t in texts]
    lookup = index.terms.get
    keys, spans, row_of = [], [], []
    for row, own in enumerate(words):
        n = len(own)
        if not n:
            continue
        terms = np.fromiter(map(lookup, own, repeat(-1)), np.int64, n)
        known = np.flatnonzero(terms >= 0)
        first = len(spans)
        count = max(1, -(-(n - step) // step)) if n > step else 1
        spans += [(k * step, min(n, k * step + width)) for k in range(count)]
        row_of += [row] * count
        last = np.minimum(known // step, count - 1)
        earlier = known // step - 1
        twice = (earlier >= 0) & (earlier < last)
        place = np.concatenate([last, earlier[twice]]) + first
        keys.append(place * len(index.terms) + np.concatenate([terms[known], terms[known[twice]]]))
    pairs = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    if not len(pairs):
        return []
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    p, items, scores = retrieve(index, pairs // len(index.terms), pairs % len(index.terms), len(spans))
    best: dict[tuple[int, int], tuple] = {}
    current, seen_by = -1, {}
    for passage, item, score in zip(p.tolist(), items.tolist(), scores.tolist()):
        row = row_of[passage]
        if passage != current:  # items of one passage follow each other
            start, end = spans[passage]
            current, own, seen_by = passage, words[row][start:end], {}
            known = set(own)
        question, answer = question_and_answer(index.texts[item])
        asked, told = sequences(question), set(answer)
        size = len(next(iter(asked), ()))
        if size not in seen_by:
            seen_by[size] = {tuple(own[k : k + size]) for k in range(len(own))}
        seen = seen_by[size]
        q = len(asked & seen) / len(asked) if asked else 1.0
        a = len(told & known) / len(told)
        if q >= MIN_QUESTION and a >= MIN_ANSWER:
            new = (score * share, q, a)
            best[row, item] = max(best.get((row, item), new), new)
    return [(row, item, *values) for (row, item), values in sorted(best.items())]


def word_lists(items: DataFrame) -> DataFrame:
    """(part, word): the distinct words of each item with a column `part`."""

    def work(columns: list[list]) -> list[list]:
        found = [(part, word) for part, text in zip(*columns) for word in set(words_of(text))]
        return [list(c) for c in zip(*found)] or [[], []]

    return map_rows(items.select("part", "text"), work, "part long, word string")


class Benchmark:
    """The items of a benchmark in parts, each small enough to be indexed on the driver."""

    def __init__(self, items: DataFrame, part_items: int = PART_ITEMS, part_bytes: int = PART_BYTES):
        distinct = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
        self.rows, self.parts = self.split(distinct, part_items, part_bytes)
        counts = map_rows(self.rows.select("text"), lambda c: [[len(words_of(t)) for t in c[0]]], "words long").where("words > 0")
        self.items, self.mean = counts.agg(F.count("*"), F.avg("words")).first()
        self.words = written(word_lists(self.rows), "item-words")
        self.df = written(self.words.groupBy("word").agg(F.count("*").alias("df")), "item-df")

    def split(self, items: DataFrame, part_items: int, part_bytes: int) -> tuple[DataFrame, int]:
        """The items, written, with the number of their part; parts are halved until all are within their bounds.

        A text that is larger than the bound on its own is a part of one item.
        """
        number, parts = F.xxhash64("item_id", "text"), 1
        while True:
            sizes = items.groupBy(F.pmod(number, F.lit(parts)).alias("part")).agg(
                F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")
            )
            large = sizes.where((F.col("rows") > 1) & ((F.col("rows") > part_items) | (F.col("bytes") > part_bytes)))
            if parts >= 1 << 40 or large.isEmpty():
                return written(items.withColumn("part", F.pmod(number, F.lit(parts)).cast("long")), "items"), parts
            parts *= 2

    def indexes(self) -> Iterator[list[Index]]:
        """The indexes of one part after the other."""
        if not self.items:
            return
        for part in sorted(r["part"] for r in self.rows.select("part").distinct().collect()):
            rows = self.rows.where(F.col("part") == part).orderBy("item_id", "text").collect()
            known = self.words.where(F.col("part") == part).select("word").distinct().join(self.df, "word").toPandas()
            totals = Totals(self.items, self.mean, dict(zip(known["word"], known["df"].tolist())))
            yield build_classes([r["item_id"] for r in rows], [r["text"] for r in rows], totals)


def leaks(documents: DataFrame, items: DataFrame, part_items: int = PART_ITEMS, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row per document and item that leaks into it: doc_id, item_id, score, question and answer overlap.

    A written table, to which every part of the benchmark adds its rows; `version` is a hash of the document's text.
    """
    spark = documents.sparkSession
    schema = "doc_id long, version long, item_id long, score double, question_overlap double, answer_overlap double"
    found = scratch_path(spark, "leaks")
    spark.createDataFrame([], schema).write.parquet(found)
    texts = documents.select("doc_id", F.xxhash64("text").alias("version"), "text")
    for part in Benchmark(items, part_items, part_bytes).indexes():

        def work(columns: list[list], part=part) -> list[list]:
            rows = [(columns[0][r], columns[1][r], x.ids[i], *v) for x in part for r, i, *v in search(x, columns[2])]
            return [list(c) for c in zip(*rows)] or [[]] * 6

        map_rows(texts, work, schema, rows=512).write.mode("append").parquet(found)
    return spark.read.schema(schema).parquet(found)


def without_leaks(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, into which no item leaks.

    Only texts that may be among those with a leak are shuffled.
    """
    dirty = written(leaks(documents, items, **options).select("doc_id", "version").distinct(), "dirty")
    key, flag, doc, version = (unused(documents, n) for n in ("own_key", "may_leak", "dirty_id", "dirty_version"))
    keys = dirty.toDF(doc, version).withColumn(key, F.xxhash64(doc, version))
    own = documents.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")))
    flagged = with_may_be_among(own, key, keys, key, flag)
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(version))
    rest = flagged.where(F.col(flag)).join(keys.drop(key), same, "left_anti")
    return flagged.where(~F.col(flag)).unionByName(rest).select(*(f"`{c}`" for c in documents.columns))


def op8_block_max_wand(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks(read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text"))
    return found.drop("version")
