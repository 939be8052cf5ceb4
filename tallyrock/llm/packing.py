"""Packing documents into token sequences, each document next to lexically similar ones.

Documents are tokenised once and dealt by content to shards of less than twice `shard_docs`:
a tree over the whole corpus halves it again and again, each time at the
median along the direction in which sketches of the documents (signed sums of the
idf of their ids) differ most, so documents of like content share a shard at any
size of the corpus. The tree is built from a sample, of which equal sketches are halved by
a hash of the row, and has at most 2 ** TREE_DEPTH leaves, so it is small enough to be sent to every task.
Below it the signs of the sketch deal on. The documents of a leaf are then cut into shards in the order of these signs, so a
shard is bounded whatever the documents are, copies of one included. Every shard has a BM25 inverted index of its documents over token ids, with document
frequencies and lengths of the whole corpus. Packing starts with a seed, whose
tokens fill one window after another; the room in its last window goes to the
unused document that the index scores highest for the seed, and so on until
the window is full. A document that does not fit goes on in the next window and
is its seed. So every window is full but a shard's last. Every document is the
query of its shard's index at most once.

A document is its ids and then the id 0. NULL text counts as empty, which is the
id 0 alone. Repeated rows are documents of their own; NULL ids are kept. Equal
scores go to the smaller doc_id. An empty table gives no rows. Very long documents
are cut at window ends like any other.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.llm.common import read, written

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1024
END = 0
SHARD_DOCS = 1024
K1, B = 1.2, 0.75
SKETCH = 128  # numbers
SAMPLE = 64  # documents a shard that the tree is built from, but
LEAST_SAMPLE, MOST_SAMPLE = 1 << 12, 1 << 17  # in all
TREE_DEPTH = 12  # 2 MB of directions
SIGN_DEPTH = 16  # more levels by signs
LEAF_BITS = 63 - TREE_DEPTH - SIGN_DEPTH  # for the sequences of a leaf
ROWS = 256  # queries of a shard that are scored at a time
DENSE = 24  # terms in more documents of a shard are scored as a matrix, the others by their postings

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, by its rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def load_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE vocabulary of a tokenizers file, run by the faster library; special tokens are text."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    symbols, vocabulary = byte_symbols(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    # Ids in the order of the merges are what makes them ranks.
    assert all(vocabulary["".join(m)] == 256 + k for k, m in enumerate(merges))
    ranks = {bytes(symbols[c] for c in t): k for t, k in vocabulary.items() if k < 256 + len(merges)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def squeeze(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.tobytes())


def unsqueeze(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def tokenised(documents: DataFrame, path: str) -> DataFrame:
    """A written table: a row per document with its ids, and one per task with its document frequencies.

    Columns: doc_id, key (a hash of the row), tokens, ids (compressed; of a task's
    row the frequency of each id), docs (of a task's row only).
    """
    names = ["doc_id", "key", "tokens", "ids", "docs"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(path)
        size = encoder.n_vocab
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        frequencies, docs, tokens = np.zeros(size, np.int64), 0, 0
        for part in parts:
            for start in range(0, part.num_rows, 1024):
                doc_ids, keys, texts = (c.to_pylist() for c in part.slice(start, 1024).columns)
                lengths, packed = [], []
                for text in texts:
                    ids = np.array(encoder.encode_ordinary(text or ""), kind)
                    if len(ids):
                        ordered = np.sort(ids)
                        frequencies[ordered[np.append(True, ordered[1:] != ordered[:-1])]] += 1
                    lengths.append(len(ids) + 1)
                    packed.append(squeeze(np.append(ids, kind(END))))
                docs, tokens = docs + len(texts), tokens + sum(lengths)
                columns = [doc_ids, keys, lengths, packed, [None] * len(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        columns = [[None], [None], [tokens], [squeeze(frequencies)], [docs]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    # The row's number tells rows apart that are equal.
    number = F.monotonically_increasing_id()
    keyed = documents.select("doc_id", F.xxhash64("doc_id", "text", number).alias("key"), "text")
    return written(keyed.mapInArrow(encode, "doc_id long, key long, tokens long, ids binary, docs long"), "tokens")


def corpus_statistics(tokens: DataFrame) -> tuple[int, int, np.ndarray]:
    """Number of documents and of tokens, and the document frequency of each id: at most the vocabulary's size."""

    def explode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for raw in part.column(0).to_pylist():
                df = unsqueeze(raw, np.int64)
                ids = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(df[ids])], ["id", "df"])

    parts = tokens.where("docs IS NOT NULL")
    docs, total = parts.agg(F.sum("docs"), F.sum("tokens")).first()
    rows = parts.select("ids").mapInArrow(explode, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toPandas()
    frequencies = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1)
    frequencies[rows["id"].to_numpy(np.int64)] = rows["df"].to_numpy()
    return docs or 0, total or 0, frequencies


class Sketcher:
    """Documents as points: the idf of their ids summed by a hash of the id, with its sign, at length 1."""

    def __init__(self, idf: np.ndarray):
        mixed = np.arange(len(idf), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.place = (mixed >> np.uint64(40)).astype(np.int64) % SKETCH
        self.signed = np.where(mixed >> np.uint64(39) & np.uint64(1), idf, -idf)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        ids = ids[:-1]  # without END
        point = np.bincount(self.place[ids], self.signed[ids], SKETCH)
        return (point / max(1e-9, np.sqrt((point * point).sum()))).astype(np.float32)


def right_of(points: np.ndarray, keys: np.ndarray, directions: np.ndarray, medians: np.ndarray, level: int) -> np.ndarray:
    """Whether points go to the right at their nodes of a level; equal ones by a bit of their keys."""
    along = np.round((points * directions).sum(axis=1, dtype=np.float64), 6)
    return (along > medians) | ((along == medians) & ((keys >> level) & 1 == 1))


def split_tree(points: np.ndarray, keys: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Directions and medians of the 2 ** level nodes of each level."""
    tree, node = [], np.zeros(len(points), np.int64)
    for level in range(depth):
        directions, medians = np.zeros((1 << level, SKETCH), np.float32), np.zeros(1 << level)
        order = np.argsort(node, kind="stable")
        ends = np.searchsorted(node[order], np.arange((1 << level) + 1))
        for k in range(1 << level):
            own = points[order[ends[k] : ends[k + 1]]].astype(np.float64)
            if not len(own):
                continue  # what comes here is halved by key
            centred = own - own.mean(axis=0)
            way = centred[np.argmax((centred * centred).sum(axis=1))]
            for _ in range(8):
                way = centred.T @ (centred @ way)
                way = way / max(1e-30, np.sqrt(way @ way))
            directions[k] = way
            along = np.round((own.astype(np.float32) * directions[k]).sum(axis=1, dtype=np.float64), 6)
            medians[k] = np.median(along)
        tree.append((directions, medians))
        node = 2 * node + right_of(points, keys, directions[node], medians[node], level)
    return tree


def leaves(points: np.ndarray, keys: np.ndarray, tree: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for level, (directions, medians) in enumerate(tree):
        node = 2 * node + right_of(points, keys, directions[node], medians[node], level)
    return node


def signs(points: np.ndarray) -> np.ndarray:
    """The signs of the first 63 numbers of each sketch as bits, the first one highest."""
    bits = (points[:, :63] > 0).astype(np.int64)
    return bits @ (np.int64(1) << np.arange(62, -1, -1, dtype=np.int64))


def dealt(rows: DataFrame, docs: int, idf: np.ndarray, kind, shard_docs: int) -> DataFrame:
    """(leaf, place, key, doc_id, ids) of documents, all of a leaf in one task and in order of place."""
    depth = max(0, int(np.ceil(np.log2(max(1, docs) / shard_docs))))
    by_tree, by_signs = min(depth, TREE_DEPTH), min(max(0, depth - TREE_DEPTH), SIGN_DEPTH)
    sketch = Sketcher(idf)

    def points_of(raws: list[bytes]) -> np.ndarray:
        return np.array([sketch(unsqueeze(raw, kind)) for raw in raws], np.float32).reshape(-1, SKETCH)

    def sample(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            points = [p.tobytes() for p in points_of(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(points, pa.binary())], ["key", "point"])

    tree = []
    if by_tree:
        share = min(MOST_SAMPLE, max(LEAST_SAMPLE, SAMPLE << by_tree)) / docs
        some = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(min(1, share) * (1 << 30)))
        found = some.select("key", "ids").mapInArrow(sample, "key long, point binary").toArrow().sort_by(
            [("point", "ascending"), ("key", "ascending")]
        )
        points = np.frombuffer(b"".join(found["point"].to_pylist()), np.float32).reshape(-1, SKETCH)
        tree = split_tree(points, found["key"].to_numpy().astype(np.int64), by_tree)

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, 1024):
                piece = part.slice(start, 1024)
                points, keys = points_of(piece.column(2).to_pylist()), piece.column(1).to_numpy()
                place = signs(points)
                leaf = (leaves(points, keys, tree) << by_signs) | (place >> (63 - by_signs))
                columns = [pa.array(leaf), pa.array(place), piece.column(1), piece.column(0), piece.column(2)]
                yield pa.RecordBatch.from_arrays(columns, ["leaf", "place", "key", "doc_id", "ids"])

    schema = "leaf long, place long, key long, doc_id long, ids binary"
    found = rows.select("doc_id", "key", "ids").mapInArrow(deal, schema)
    return found.repartition("leaf").sortWithinPartitions("leaf", "place", "key")


def shards(parts: Iterator[pa.RecordBatch], shard_docs: int) -> Iterator[tuple[int, bool, list[tuple]]]:
    """Shards of sorted rows: the leaf, whether it begins, and (doc_id, ids) of less than twice shard_docs documents."""
    current, begins, held = None, True, []
    for part in parts:
        for leaf, doc_id, raw in zip(*(part.column(k).to_pylist() for k in (0, 3, 4))):
            if leaf != current:
                if held:
                    yield current, begins, held
                current, begins, held = leaf, True, []
            held.append((doc_id, raw))
            if len(held) == 2 * shard_docs:
                yield current, begins, held[:shard_docs]
                begins, held = False, held[shard_docs:]
    if held:
        yield current, begins, held


def similarities(documents: list[np.ndarray], idf: np.ndarray, mean_tokens: float) -> np.ndarray:
    """BM25 of every document (column) for every document as a query (row), from the postings of their ids."""
    n = len(documents)
    found = [np.unique(ids, return_counts=True) for ids in documents]
    doc = np.repeat(np.arange(n), [len(t) for t, _ in found])
    term = np.concatenate([t for t, _ in found]).astype(np.int64)
    tf = np.concatenate([c for _, c in found]).astype(np.float32)
    sizes = np.array([len(ids) for ids in documents], np.float32)
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean_tokens))
    order = np.argsort(term, kind="stable")
    doc, term, weight = doc[order], term[order], weight[order].astype(np.float32)
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
    local = np.diff(np.append(starts, len(term)))
    wide = np.flatnonzero(local > DENSE)
    column = np.repeat(np.cumsum(local > DENSE) - 1, local)
    in_wide = np.repeat(local > DENSE, local)
    matrix = np.zeros((n, len(wide)), np.float32)
    matrix[doc[in_wide], column[in_wide]] = weight[in_wide]
    scores, across = np.empty((n, n), np.float32), np.ascontiguousarray(matrix.T)
    for top in range(0, n, ROWS):
        scores[top : top + ROWS] = (matrix[top : top + ROWS] > 0).astype(np.float32) @ across
    del matrix, across
    flat = scores.reshape(-1)
    for size in range(2, DENSE + 1):
        first = starts[local == size]
        if len(first):
            at = first[:, None] + np.arange(size)
            docs, weights = doc[at], weight[at]
            cells = (docs[:, :, None] * n + docs[:, None, :]).reshape(-1)
            flat += np.bincount(cells, np.repeat(weights[:, None, :], size, axis=1).reshape(-1), n * n)
    return scores


def fill_windows(sizes: list[int], scores: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece."""
    unused = np.zeros(len(sizes), np.float32)  # -inf for used documents
    seed, current, sequence, offset = 0, 0, 0, 0
    for left in range(len(sizes), 0, -1):
        unused[current] = -np.inf
        start = 0
        while start < sizes[current]:
            if offset == 0:
                seed = current  # of the window that begins
            length = min(sizes[current] - start, window - offset)
            yield current, start, length, sequence, offset
            start, offset = start + length, offset + length
            if offset == window:
                sequence, offset = sequence + 1, 0
        if left > 1:
            current = int(np.argmax(scores[seed] + unused))


def pack(
    documents: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
    keep_ids: bool = True,
) -> DataFrame:
    """A row per piece: PIECE_SCHEMA, and its ids where `keep_ids` is set."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    tokens = tokenised(documents, path)
    docs, total, df = corpus_statistics(tokens)
    idf = np.log(1 + (docs - df + 0.5) / (df + 0.5))
    kind = np.uint16 if len(df) <= 1 << 16 else np.uint32
    mean_tokens = max(1.0, total / max(1, docs))

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * keep_ids

    def fill(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0  # number of the shard's first sequence among those of its leaf
        for leaf, begins, held in shards(parts, shard_docs):
            rows = sorted(
                ((doc_id, unsqueeze(raw, kind)) for doc_id, raw in held),
                key=lambda r: (r[0] is not None, r[0], len(r[1]), r[1].tobytes()),
            )
            ids = [r[1].astype("<u4") for r in rows]
            scores = similarities([x[:-1] for x in ids], idf, mean_tokens)
            first, last = 0 if begins else first, 0
            columns: list[list] = [[] for _ in range(8)]
            for doc, start, length, sequence, offset in fill_windows([len(x) for x in ids], scores, window):
                piece, last = ids[doc][start : start + length], sequence
                values = (rows[doc][0], start, length, zlib.crc32(piece.tobytes()), len(ids[doc]),
                          (leaf << LEAF_BITS) + first + sequence, offset, piece)
                for column, value in zip(columns, values):
                    column.append(value)
            first += last + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(kinds)])

    rows = dealt(tokens.where("docs IS NULL"), docs, idf, kind, shard_docs)
    return rows.mapInArrow(fill, PIECE_SCHEMA + (", ids array<int>" if keep_ids else ""))


def op3_bm25_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents", "doc_id", "text"), keep_ids=False)
