"""Quality rules: distance of a document's histograms from its nearest language.

Every language of the corpus gets two reference histograms, counted over all of
its documents: characters by class, and its most common words against all the
rest. A document is compared with each language by Jensen-Shannon distance (the
square root of the divergence in bits, 0 to 1) and judged by the nearest one.
Rules on plain counts come first.

NULL text counts as empty: no words, all counts 0, base rules failed. A distance
is NULL where the text is shorter than its guard, and then rejects nothing; so
it is for documents of a language without a reference, which is one of too little
text to learn from, whatever its share of the corpus. Rows with a NULL lang add to
no reference and are judged by all languages. Repeated rows are judged one by
one. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyrock.llm.common import Numbered, gather, map_rows, read, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

COMMON_WORDS = 64
MIN_REFERENCE_WORDS = 5_000  # of a language in all its documents, for it to get a reference
MIN_REFERENCE_CHARS = 10_000  # outside white space
MAX_LANGUAGES = 8192  # with a reference; more than there are codes in ISO 639-3
MIN_CHARS = 200  # bytes outside white space, for the distance of character classes
MIN_COMMON_WORDS = 100  # words, for the distance of common words
MAX_CHAR_DISTANCE = 0.14
MAX_WORD_DISTANCE = 0.37

CLASSES = 9
SPACE, LOWER, UPPER, DIGIT, STOP, SHOUT, SYMBOL, OTHER, WIDE = range(CLASSES)
INSIDE = CLASSES  # of a character that is longer than one byte


def byte_classes() -> np.ndarray:
    """The class of each UTF-8 byte; a character counts by its first byte."""
    table = np.full(256, OTHER, dtype=np.int64)
    table[[ord(c) for c in " \t\n\x0b\x0c\r"]] = SPACE
    table[ord("a") : ord("z") + 1] = LOWER
    table[ord("A") : ord("Z") + 1] = UPPER
    table[ord("0") : ord("9") + 1] = DIGIT
    table[[ord(c) for c in ".,;:'\"-"]] = STOP
    table[[ord(c) for c in "!?"]] = SHOUT
    table[[ord(c) for c in SYMBOLS]] = SYMBOL
    table[0x80:0xC0] = INSIDE
    table[0xC0:] = WIDE
    return table


BYTE_CLASSES = byte_classes()


def char_histogram(raw: bytes) -> np.ndarray:
    return np.bincount(BYTE_CLASSES[np.frombuffer(raw, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """How many words stand in a window of `width` words that is found twice or more."""
    count = len(hashes) - width + 1
    if count < 2:
        return 0
    windows = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(count, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = text.split("\n")
    if len(lines) == len(set(lines)):
        return 0
    seen, found = set(), 0
    for line in lines:
        if line in seen:
            found += bool(line.strip(" \t\n\x0b\x0c\r"))
        seen.add(line)
    return found


def distances(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of one histogram to each row of `references`."""
    p = counts / counts.sum()
    q = references / references.sum(axis=1, keepdims=True)
    m = (p + q) / 2

    def entropy(x):
        return -(x * np.log2(np.where(x > 0, x, 1))).sum(axis=-1)

    return np.sqrt(np.maximum(0, entropy(m) - (entropy(p) + entropy(q)) / 2))


def corpus_counts(documents: DataFrame, most_words: int = 100_000) -> DataFrame:
    """(lang, kind, key, n) over all documents: kind d documents, c characters of a class, w a word.

    A task holds at most `most_words` different words; it sends them on and starts anew.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = defaultdict(lambda: np.zeros(CLASSES, dtype=np.int64))
        docs, words = Counter(), defaultdict(Counter)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64()))],
                names=["lang", "kind", "key", "n"],
            )

        def word_rows() -> pa.RecordBatch:
            found = rows([(lang, "w", w, n) for lang, c in words.items() for w, n in c.items()])
            words.clear()
            return found

        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                docs[lang] += 1
                if text:
                    raw = text.encode("utf-8")
                    chars[lang] += char_histogram(raw)
                    words[lang].update(raw.split())
                    if sum(map(len, words.values())) > most_words:
                        yield word_rows()
        yield word_rows()
        yield rows(
            [(lang, "d", b"", n) for lang, n in docs.items()]
            + [(lang, "c", b"%d" % k, int(n)) for lang, c in chars.items() for k, n in enumerate(c)]
        )

    counted = documents.where(F.col("lang").isNotNull()).select("lang", "text")
    rows = counted.mapInArrow(count, "lang string, kind string, key binary, n long")
    return rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def language_references(
    documents: DataFrame,
    common_words: int = COMMON_WORDS,
    min_share: float = 0.0,
    min_words: int = MIN_REFERENCE_WORDS,
    min_chars: int = MIN_REFERENCE_CHARS,
    max_languages: int = MAX_LANGUAGES,
) -> list[tuple[str, np.ndarray, dict[bytes, int], int]]:
    """Per language: name, characters by class, counts of its common words, count of all words.

    At most `max_languages` languages with `common_words` words each come to the driver; more fail the job.
    """
    counts = written(corpus_counts(documents), "histograms")
    total = counts.where("kind = 'd'").agg(F.sum("n")).first()[0] or 0

    def of(rows) -> Column:
        return F.sum(F.when(rows, F.col("n")).otherwise(0))

    kind = F.col("kind")
    spaces = F.col("key") == F.lit(b"%d" % SPACE)
    sizes = counts.groupBy("lang").agg(
        of(kind == "d").alias("docs"), of(kind == "w").alias("words"), of((kind == "c") & ~spaces).alias("chars")
    )
    enough = (F.col("docs") >= min_share * total) & (F.col("words") >= min_words) & (F.col("chars") >= min_chars)
    langs = {r["lang"] for r in sizes.where(enough).select("lang").limit(max_languages + 1).collect()}
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages have text enough for a reference")
    if not langs:
        return []
    some = F.col("lang").isin(sorted(langs))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    words = counts.where(some & (F.col("kind") == "w"))
    top = words.withColumn("place", F.row_number().over(best)).where(F.col("place") <= common_words)
    sums = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes, common = defaultdict(lambda: np.zeros(CLASSES)), defaultdict(dict)
    for r in counts.where(some & (F.col("kind") == "c")).collect():
        classes[r["lang"]][int(r["key"])] = r["n"]
    for r in top.select("lang", "key", "n").collect():
        common[r["lang"]][bytes(r["key"])] = r["n"]
    return [(lang, classes[lang], common[lang], sums[lang]) for lang in sorted(sums)]


def quality_rules(
    documents: DataFrame,
    references: list | None = None,
    min_chars: int = MIN_CHARS,
    min_common_words: int = MIN_COMMON_WORDS,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """A row per document: its counts, its distances and nearest language, base_failed and kept."""
    if references is None:
        references = language_references(documents)
    names = [r[0] for r in references]
    judging = {None, *names} if names else set()  # languages whose documents get distances
    classes = np.array([r[1] for r in references]).reshape(len(references), CLASSES)
    places = {word: k for k, word in enumerate(sorted({w for r in references for w in r[2]}))}
    # Each language has its own common words; all other words are its last bin.
    own = [np.array([places[w] for w in sorted(r[2])], dtype=np.int64) for r in references]
    word_refs = [
        np.array([*(r[2][w] for w in sorted(r[2])), r[3] - sum(r[2].values())], dtype=float) for r in references
    ]
    state: dict = {}

    def judge(columns: list[list]) -> list[list]:
        if not state:
            state["hash"] = Numbered(xxhash.xxh64_intdigest)
        found = []
        for doc_id, text, lang in zip(*columns):
            text = text or ""
            raw = text.encode("utf-8")
            words, chars = raw.split(), char_histogram(raw)
            n, inside = len(words), int(chars.sum() - chars[SPACE])
            repeated = repeated_words(gather(state["hash"], words, np.uint64))
            failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
            by_class = by_word = nearest = None
            if lang in judging and inside >= min_chars:
                all_classes = distances(chars, classes)
                nearest, by_class = names[int(all_classes.argmin())], float(all_classes.min())
            if lang in judging and n >= min_common_words:
                hits = [places[w] for w in words if w in places]
                known = np.bincount(hits, minlength=len(places)) if hits else np.zeros(len(places))
                all_words = []
                for mine, reference in zip(own, word_refs):
                    counts = known[mine]
                    all_words.append(distances(np.append(counts, n - counts.sum()), reference[None])[0])
                by_word = float(min(all_words))
            kept = not (
                failed
                or (by_class is not None and by_class > max_char_distance)
                or (by_word is not None and by_word > max_word_distance)
            )
            found.append(
                (doc_id, n, inside, int(chars[SYMBOL]), duplicate_lines(text), repeated, failed, kept,
                 by_class, by_word, nearest)
            )
        return [list(c) for c in zip(*found)] or [[]] * 11

    return map_rows(
        documents.select("doc_id", "text", "lang"),
        judge,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, char_distance double, word_distance double, nearest_lang string",
    )


def op7_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents", "doc_id", "text", "lang"))
