"""Alignment of two tokenizers over the same texts by lockstep merging.

A text is encoded by a byte-level BPE vocabulary (A, which gets a space in front of the
text) and by a piece vocabulary (B, which adds that space itself). The tokens of both
lie on the same bytes. All documents of a batch are merged at once: a NumPy state
vector holds, for each of them, the A and the B token it has come to. A step emits a link
between the two, a cut where both end at the same byte, and moves on whichever ends first;
documents that are through leave the vector. Cuts divide the tokens into groups.
A long document takes several places of the vector, divided at bytes where both end, so
that it does not keep a batch waiting; links never cross such a byte.

Then links are counted by their pair of ids over the whole corpus: batches add up their own
pairs first, Spark adds up the batches, and each batch gets the counts of its pairs back.

NULL and empty texts, and texts that either tokenizer does not give back byte by byte, have
no tokens: their numbers are 0, their arrays empty, their digest ''. Special tokens' strings are plain
text. Texts are never cut before encoding. Repeated rows and rows without an id each give a
row and count each time. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tallyrock.llm.common import read, written
from tallyrock.llm.packing import load_encoder, squeeze, unsqueeze

A_VOCABULARY = "byte_bpe_50k.json"
B_VOCABULARY = "piece_bpe_32k.model"
BATCH_CHARS, BATCH_ROWS = 1 << 22, 1 << 14  # a batch ends when it holds either
LANE = 4096  # A tokens, about, that one place of the state vector merges
PROBES = 256  # A tokens in which a place to divide a long document is looked for

ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ARRAYS = ", a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>"


class Tokenizers:
    """Both encoders, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        self.fast = load_encoder(a_path)
        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [self.fast.decode_single_token_bytes(i) for i in range(self.fast.n_vocab)]
        self.b_bytes = [
            bytes.fromhex(piece[3:5]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.pieces.id_to_piece, range(self.pieces.get_piece_size())))
        ]
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int32)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int32)
        # How an id is written where its group goes on, and where it ends.
        a_names = [name for i in range(len(self.a_bytes)) for name in (f"{i},", f"{i}|")]
        b_names = [name for i in range(len(self.b_bytes)) for name in (f"{i},", f"{i};")]
        self.names = a_names + b_names

    def encode_a(self, text: str) -> list[int]:
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters that Python's tables do not know: the two libraries may class them differently.
            return self.library.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both, or none of either."""
        if text:
            raw = b" " + text.encode("utf-8", "surrogatepass")
            a, b = self.encode_a(text), self.pieces.encode(text)
            if b"".join(map(self.b_bytes.__getitem__, b)) == raw and b"".join(map(self.a_bytes.__getitem__, a)) == raw:
                return a, b
        return [], []


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


@dataclass
class Aligned:
    """Links of a batch in order, by the places of their tokens in the batch, and which of them end in a cut."""

    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray


def lanes(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, lane: int = LANE) -> np.ndarray:
    """The A tokens at which the places of the state vector start: documents, and bytes inside long ones where both end."""
    starts = [a_bounds[:-1][np.diff(a_bounds) > 0]]
    for first, stop in zip(a_bounds[:-1], a_bounds[1:]):
        at = first + lane
        while at < stop:
            ends = a_ends[at - 1 : min(at - 1 + PROBES, stop - 1)]
            here = np.searchsorted(b_ends, ends)
            both = np.flatnonzero(b_ends[here] == ends)
            if len(both):
                at += int(both[0])
                starts.append(np.array([at]))
                at += lane
            else:
                at += PROBES
    return np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, lane: int = LANE) -> Aligned:
    """Merges the tokens of all documents of a batch; ends count the bytes from the start of the batch."""
    first = lanes(a_ends, b_ends, a_bounds, lane)
    stop = np.append(first[1:], len(a_ends))[: len(first)]
    bytes_before = np.where(first > 0, a_ends[first - 1], 0) if len(first) else np.zeros(0, a_ends.dtype)
    i, j = first.copy(), np.searchsorted(b_ends, bytes_before, side="right")
    # A place makes at most as many links as it has tokens, so each writes into a stretch of its own.
    place = i + j
    room = len(a_ends) + len(b_ends)
    out_a, out_b, cut = np.full(room, -1, np.int32), np.full(room, -1, np.int32), np.zeros(room, bool)
    while len(i):
        a_end, b_end = a_ends[i], b_ends[j]
        out_a[place], out_b[place], cut[place] = i, j, a_end == b_end
        i += a_end <= b_end
        j += b_end <= a_end
        place += 1
        going = i < stop
        if not going.all():
            i, j, place, stop = i[going], j[going], place[going], stop[going]
    found = out_a >= 0
    return Aligned(out_a[found], out_b[found], cut[found])


class Batch:
    """Documents collected until there are enough of them to be merged together."""

    def __init__(self, both: Tokenizers, arrays: bool):
        self.both, self.arrays = both, arrays
        self.clear()

    def clear(self) -> None:
        self.doc_ids, self.a, self.b, self.chars = [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> bool:
        """Whether the batch is full."""
        a, b = self.both.encode(text)
        self.doc_ids.append(doc_id)
        self.a.append(np.array(a, np.int32))
        self.b.append(np.array(b, np.int32))
        self.chars += len(text or "")
        return self.chars >= BATCH_CHARS or len(self.doc_ids) >= BATCH_ROWS

    def result(self, number: int) -> pa.RecordBatch:
        """A row for each document, and one with the batch's pairs of ids and their counts."""
        both, n = self.both, len(self.doc_ids)
        a_bounds = np.append(0, np.cumsum([len(x) for x in self.a], dtype=np.int64))
        b_bounds = np.append(0, np.cumsum([len(x) for x in self.b], dtype=np.int64))
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        links = lockstep(np.cumsum(both.a_sizes[a], dtype=np.int64), np.cumsum(both.b_sizes[b], dtype=np.int64), a_bounds)

        doc_of = np.repeat(np.arange(n, dtype=np.int32), np.diff(a_bounds))[links.a]
        n_links = np.bincount(doc_of, minlength=n)
        n_groups = np.bincount(doc_of[links.cut], minlength=n)
        digests, groups = self.groups(a, b, a_bounds, b_bounds, links, n_groups)

        pairs = a[links.a].astype(np.int64) * len(both.b_bytes) + b[links.b]
        distinct, local, totals = np.unique(pairs, return_inverse=True, return_counts=True)
        # In a document, how often each pair occurs, by its place among those of the batch.
        keys, counts = np.unique(doc_of.astype(np.int64) * max(1, len(distinct)) + local, return_counts=True)
        doc, local = keys // max(1, len(distinct)), (keys % max(1, len(distinct))).astype(np.uint32)
        bounds = np.searchsorted(doc, np.arange(n + 1))
        own = [squeeze(np.concatenate([local[s:e], counts[s:e].astype(np.uint32)])) for s, e in zip(bounds[:-1], bounds[1:])]

        last = [None]
        columns = {
            "batch": pa.array([number] * (n + 1), pa.int64()),
            "doc_id": pa.array(self.doc_ids + last, pa.int64()),
            "n_a": pa.array([*np.diff(a_bounds).tolist(), None], pa.int64()),
            "n_b": pa.array([*np.diff(b_bounds).tolist(), None], pa.int64()),
            "n_groups": pa.array(n_groups.tolist() + last, pa.int64()),
            "n_links": pa.array(n_links.tolist() + last, pa.int64()),
            "groups_sha256": pa.array(digests + last, pa.string()),
        }
        if self.arrays:
            columns |= {k: pa.array(v + last, pa.list_(pa.int32())) for k, v in groups.items()}
        columns["own"] = pa.array(own + last, pa.binary())
        columns["pairs"] = pa.array([None] * n + [squeeze(np.concatenate([distinct, totals.astype(np.int64)]))], pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def groups(self, a, b, a_bounds, b_bounds, links: Aligned, n_groups) -> tuple[list[str], dict[str, list]]:
        """The digest of each document's groups, and its ids and where its groups end."""
        a_last, b_last = links.a[links.cut].astype(np.int64), links.b[links.cut].astype(np.int64)
        a_in, b_in = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        # A group's A tokens come after the B tokens of those before it, its B tokens after its A tokens.
        codes = np.zeros(len(a) + len(b), np.int64)
        a_place = np.arange(len(a)) + np.repeat(b_last - b_in + 1, a_in)
        b_place = np.arange(len(b)) + np.repeat(a_last + 1, b_in)
        codes[a_place], codes[b_place] = 2 * a, 2 * (b + len(self.both.a_bytes))
        codes[a_place[a_last]] += 1
        codes[b_place[b_last]] += 1
        name, digests = self.both.names.__getitem__, []
        for start, stop in zip(a_bounds[:-1] + b_bounds[:-1], a_bounds[1:] + b_bounds[1:]):
            if start == stop:
                digests.append("")
                continue
            text = "".join(map(name, codes[start:stop].tolist()))[:-1]
            digests.append(hashlib.sha256(text.encode()).hexdigest())
        found: dict[str, list] = {}
        if self.arrays:
            ends = np.append(0, np.cumsum(n_groups))
            cuts = list(zip(ends[:-1], ends[1:]))
            found = {
                "a_ids": self.a,
                "b_ids": self.b,
                "group_a": [a_last[s:e] + 1 - first for (s, e), first in zip(cuts, a_bounds)],
                "group_b": [b_last[s:e] + 1 - first for (s, e), first in zip(cuts, b_bounds)],
            }
        return digests, found


def merged(documents: DataFrame, a_path: str, b_path: str, arrays: bool) -> DataFrame:
    """A written table: a row per document, and one per batch with its pairs of ids."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = Batch(load(a_path, b_path), arrays)
        number = TaskContext.get().partitionId() << 32
        for part in parts:
            for start in range(0, part.num_rows, 64):
                for doc_id, text in zip(*(c.to_pylist() for c in part.slice(start, 64).columns)):
                    if batch.add(doc_id, text):
                        yield batch.result(number)
                        number += 1
                        batch.clear()
        if batch.doc_ids:
            yield batch.result(number)

    schema = f"batch long, {ROW}{ARRAYS if arrays else ''}, own binary, pairs binary"
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)
    return written(rows, "aligned")


def pairs_of(batches: DataFrame) -> DataFrame:
    """(batch, pair, n) of the pairs of each batch."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number, raw in zip(*(c.to_pylist() for c in part.columns)):
                both = unsqueeze(raw, np.int64).reshape(2, -1)
                columns = [np.full(both.shape[1], number), both[0], both[1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["batch", "pair", "n"])

    return batches.where("pairs IS NOT NULL").select("batch", "pairs").mapInArrow(work, "batch long, pair long, n long")


def pair_counts(pairs: DataFrame, b_size: int) -> DataFrame:
    """(pair, links, best): how many links of the corpus hold a pair, and whether no pair of its B id has more."""
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("links"))
    b_id = F.pmod("pair", F.lit(b_size))
    highest = totals.groupBy(b_id.alias("b_id")).agg(F.max("links").alias("highest"))
    # One row per id of B's vocabulary at most, whatever the corpus.
    joined = totals.withColumn("b_id", b_id).join(F.broadcast(highest), "b_id")
    return joined.select("pair", "links", (F.col("links") == F.col("highest")).alias("best"))


def align(
    documents: DataFrame, a_vocabulary: str | None = None, b_vocabulary: str | None = None, arrays: bool = True
) -> DataFrame:
    """A row per document: ROW, n_best and count_sum.

    With `arrays` also the ids of both, and of each group how many ids of A and of B there are up to its end.
    """
    a_path = a_vocabulary or public_tokenizers.path(A_VOCABULARY)
    b_path = b_vocabulary or public_tokenizers.path(B_VOCABULARY)
    rows = merged(documents, a_path, b_path, arrays)
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    pairs = pairs_of(rows)
    counts = written(pair_counts(pairs, b_size), "pair-counts")
    known = pairs.select("batch", "pair").join(counts, "pair").select("batch", "pair", "links", "best")
    documents_of = rows.where("pairs IS NULL").drop("pairs")
    kept = [c for c in documents_of.columns if c not in ("batch", "own")]

    def add_counts(key: tuple, docs: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs["pair"].to_numpy())  # as in the batch, by id
        links = pairs["links"].to_numpy()[order]
        best = pairs["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        n_best, sums = [], []
        for raw in docs["own"].to_pylist():
            local, n = unsqueeze(raw, np.uint32).reshape(2, -1).astype(np.int64)
            n_best.append(int((best[local] * n).sum()))
            sums.append(int((links[local] * n).sum()))
        found = docs.select(kept)
        return found.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    schema = f"{ROW}{ARRAYS if arrays else ''}, n_best long, count_sum long"
    return documents_of.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(add_counts, schema)


def op12_lockstep_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = align(read(spark, folder, "documents", "doc_id", "text"), arrays=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
