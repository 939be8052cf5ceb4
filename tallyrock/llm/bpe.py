"""Byte-pair encoding and decoding with the vocabulary of a tokenizers file, by a pair occurrence index.

A task cuts the texts of a partition into words and merges the words it has not met
yet all at once: their symbols lie in one row, and an index maps the rank of each
pair to all places where the pair stands. The lowest rank that occurs is applied at
all its places, from left to right; a merge takes the pairs it breaks out of their
lists and puts the pairs it makes into theirs. This goes on until no listed pair is
left. A merge only makes pairs of higher ranks, which loading checks, so that ranks
in ascending order are the order in which a single word would be merged.

Supported are files with the layout of `word_bpe_49k.json`: NFC, lower case, a pattern
whose matches are the words, bytes as symbols, a suffix on a word's last symbol, no decoder. Others
are refused. Strings of added tokens in a text become their ids, as the library does.
Decoding joins the tokens' strings by a space.

NULL and empty texts have no ids and decode to empty text. A text of any length is
encoded whole; the words of a batch are merged in groups of about `GROUP` bytes, a word is never
cut. Every row gives one row, repeated ones and those without an id included.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tallyrock.llm.common import read
from tallyrock.llm.packing import byte_symbols

VOCABULARY = "word_bpe_49k.json"
GROUP = 1 << 20  # bytes of words that are merged together
KEPT_WORDS = 200_000  # words a task remembers
ROWS = 256  # texts worked on at a time


class Vocabulary:
    """Symbols, merges, pattern and added tokens of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, ids = content["model"], content["model"]["vocab"]
        steps = [step["type"] for step in content["normalizer"]["normalizers"]]
        split, as_bytes = content["pre_tokenizer"]["pretokenizers"]
        added = content["added_tokens"]
        plain = ("single_word", "lstrip", "rstrip", "normalized")
        if (
            # White space is in no word, so what is put in its place does not matter.
            steps != ["NFC", "Replace", "Lowercase"]
            or (split["type"], split["behavior"], split["invert"]) != ("Split", "Removed", True)
            or (as_bytes["type"], as_bytes["add_prefix_space"], as_bytes["use_regex"]) != ("ByteLevel", False, False)
            or model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"]
            or content["decoder"] or content["post_processor"]
            or any(token[name] for token in added for name in plain)
        ):
            raise ValueError(f"a layout that is not supported: {path}")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.added = {token["content"]: token["id"] for token in added}
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        suffix, symbols = model["end_of_word_suffix"] or "", byte_symbols()
        self.library, self.symbols = Tokenizer.from_file(path), symbols
        inner, last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for character, byte in symbols.items():
            inner[byte], last[byte] = ids[character], ids[character + suffix]
        self.inner, self.last = inner, last
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = [ids[a + b] for a, b in merges]
        self.parts = [(ids[a], ids[b]) for a, b in merges]
        self.ranks = {pair: rank for rank, pair in enumerate(self.parts)}
        # Of two bytes that follow each other, by whether the second ends its word; -1 for none.
        self.first_ranks = np.array(
            [[[self.ranks.get((a, b), -1) for b in ends] for a in inner.tolist()] for ends in (inner.tolist(), last.tolist())]
        )
        born = {made: rank for rank, made in enumerate(self.made)}
        if len(born) < len(merges) or any(born.get(part, -1) >= rank for rank, pair in enumerate(self.parts) for part in pair):
            raise ValueError(f"a merge that makes a pair of a lower rank: {path}")
        self.tokens = {i: token for token, i in chain(ids.items(), self.added.items())}

    def cut(self, text: str) -> list[str | int]:
        """The words of a text, and the ids of its added tokens."""
        found, start = [], 0
        for match in self.specials.finditer(text):
            found += self.words_of(text[start : match.start()])
            found.append(self.added[match.group()])
            start = match.end()
        return found + self.words_of(text[start:]) if start else self.words_of(text)

    def words_of(self, text: str) -> list[str]:
        if text.isascii():
            return self.words.findall(text.lower())
        letters = set(text)
        if any(unicodedata.category(c) == "Cn" for c in letters):
            # Characters younger than Python's tables: only the library knows what they are.
            text = self.library.normalizer.normalize_str(text)
            found = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [bytes(map(self.symbols.__getitem__, w)).decode("utf-8", "surrogatepass") for w, _ in found]
        text = unicodedata.normalize("NFC", text)
        # The library lowers each character by itself: a sigma at the end of a word is no case of its own.
        return self.words.findall("".join(c.lower() for c in text) if "Σ" in letters else text.lower())

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and the number of ids of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    row = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    symbols = vocabulary.inner[row]
    symbols[ends - 1] = vocabulary.last[row[ends - 1]]
    n, ranks, parts, made = len(row), vocabulary.ranks, vocabulary.parts, vocabulary.made
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    symbols, after, before = symbols.tolist(), after.tolist(), before.tolist()

    places = defaultdict(set)  # of each rank
    ends_word = np.zeros(n, np.int64)
    ends_word[ends - 1] = 1
    first = np.where(ends_word[:-1] == 1, -1, vocabulary.first_ranks[ends_word[1:], row[:-1], row[1:]])
    known = np.flatnonzero(first >= 0)
    known = known[np.argsort(first[known], kind="stable")]
    starts = np.flatnonzero(np.append(True, first[known[1:]] != first[known[:-1]])) if len(known) else known
    for part in np.split(known, starts[1:]) if len(known) else ():
        places[int(first[part[0]])] = set(part.tolist())
    active = list(places)
    heapify(active)
    while active:
        rank = heappop(active)
        (left, right), new = parts[rank], made[rank]
        found = places.pop(rank)
        for place in sorted(found):
            if symbols[place] != left:
                continue  # the place has become another symbol or the right half of a merge
            second = after[place]
            if second < 0 or symbols[second] != right:
                continue
            ahead, behind = after[second], before[place]
            # The pairs that end here stay in the index: their places are looked at when their turn comes.
            symbols[place], symbols[second], after[place] = new, -1, ahead
            if ahead >= 0:
                before[ahead] = place
                grown = ranks.get((new, symbols[ahead]))
                if grown is not None:
                    if grown not in places:
                        heappush(active, grown)
                    places[grown].add(place)
            if behind >= 0:
                grown = ranks.get((symbols[behind], new))
                if grown is not None:
                    if grown not in places:
                        heappush(active, grown)
                    places[grown].add(behind)
    merged = np.array(symbols, np.int32)
    alive = merged >= 0
    counts = np.add.reduceat(alive, ends - sizes, dtype=np.int64) if n else np.zeros(0, np.int64)
    return merged[alive], counts


class Numbers(dict):
    """Numbers words in the order in which they are met; `new` are those not merged yet."""

    def __init__(self):
        self.new: list[str | int] = []

    def __missing__(self, word: str | int) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes batches of texts and remembers the words it has merged."""

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        self.vocabulary, self.kept_words = vocabulary, kept_words
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.ids = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge_new(self) -> None:
        """Merges the words met for the first time, in groups, and appends their ids."""
        new, self.numbers.new = self.numbers.new, []
        ids, sizes, group, size = [self.ids], [self.sizes], [], 0
        for k, word in enumerate(new):
            added = isinstance(word, int)
            if not added:
                group.append(word.encode("utf-8", "surrogatepass"))
                size += len(group[-1])
            if group and (added or size >= GROUP or k == len(new) - 1):
                merged, counts = merge_words(group, self.vocabulary)
                ids.append(merged)
                sizes.append(counts)
                group, size = [], 0
            if added:
                ids.append(np.array([word], np.int32))
                sizes.append(np.ones(1, np.int64))
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end, with a 0 in front."""
        if len(self.numbers) > self.kept_words:
            self.forget()
        words = [self.vocabulary.cut(text) if text else [] for text in texts]
        bounds = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, bounds[-1])
        if self.numbers.new:
            self.merge_new()
        sizes = self.sizes[at]
        ends = np.append(0, np.cumsum(sizes))
        inside = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        return self.ids[np.repeat(self.starts[at], sizes) + inside], ends[bounds]


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The encoder of a Python worker, which keeps the words it has merged from one task to the next."""
    return Encoder(load(path))


def round_trip(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of each row: the ids of its text, and the text that these ids decode to."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, encoder = load(path), encoder_of(path)
        for part in parts:
            for start in range(0, part.num_rows, ROWS):
                piece = part.slice(start, ROWS)
                ids, ends = encoder(piece.column(1).to_pylist())
                flat = ids.tolist()
                decoded = [words.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                arrays = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([piece.column(0), arrays, pa.array(decoded, pa.string())], schema=schema)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, ids array<int>, decoded string"
    )


def op11_pair_index_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = round_trip(read(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
