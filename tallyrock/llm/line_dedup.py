"""Removes lines that repeat, exactly or within a few edits, by a segment-partition edit join.

The first occurrence of a line, by doc_id and line number, stays. Another
occurrence goes, however short the line is; and a line goes everywhere if a different line that occurs
earlier is at most `threshold` edits away. Lines of less than `min_chars`
characters are not compared with different ones: a few edits turn short lines into each other
that have nothing in common. Blank lines are left alone.

The join cuts every line evenly into threshold + 1 segments. A line within
`threshold` edits has one of them unchanged, at a place that its number and
the two lengths bound; so every line probes the segments of its own and of the
`threshold` smaller lengths with the few substrings that can match. Lines that
meet must have words that so few edits can explain, checked inside the join by 64
bits of each line, and are then verified by Spark's edit distance of the band of
2 threshold + 1 diagonals. All of it is DataFrame functions.

Lines go through shuffles as hashes: 128 bits decide equality. Occurrences of a line become one row
first, and map tasks combine theirs before the shuffle, so a line that very many documents
share meets others once. Texts are read again only of lines that meet others. NULL text is one empty line. NULL ids come last and are one
document each text; repeated rows with one id and text are one document, and
rows with one id and different texts are ordered by a hash of the text. An
empty table gives no rows. Other columns are kept by `without_repeated_lines`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyrock.llm.common import may_be_among, read, unused, written

THRESHOLD = 2
MIN_CHARS = 32
NOT_BLANK = r"[^ \t\r\f\x0B]"
PREFIX_BITS = 20
KEY = re.compile(r"k\d+")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def lines_of(documents: DataFrame) -> DataFrame:
    """(doc_id, version, place, line) of the lines that are not blank."""
    # What is computed from a text comes before its lines are rows. No array is empty; a plain explode would cut once more to check that.
    once = documents.select("doc_id", F.xxhash64("text").alias("version"), split_lines(F.col("text")).alias("lines"))
    lines = once.select("doc_id", "version", F.posexplode_outer("lines").alias("place", "line"))
    # Most lines start with a character that is none of the blanks: those need no search.
    return lines.where((F.ascii("line") > 32) | F.col("line").rlike(NOT_BLANK))


def line_hashes() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]


def segment(length: Column, number: int, threshold: int) -> tuple[Column, Column]:
    """Start, from 1, and length of a segment of a line; the last ones are longer where it does not divide evenly."""
    parts = threshold + 1
    longer = length % parts
    base = ((length - longer) / parts).cast("int")
    start = base * number + F.greatest(F.lit(0), longer - (parts - number)) + 1
    return start, base + F.when(longer >= parts - number, 1).otherwise(0)


def segment_key(length: Column, number: int, part: Column) -> Column:
    return F.xxhash64(F.lit(number), length, part)


def segment_keys(threshold: int) -> list[Column]:
    line, length, keys = F.col("line"), F.col("size"), []
    for number in range(threshold + 1):
        start, size = segment(length, number, threshold)
        keys.append(segment_key(length, number, F.substr(line, start, size)))
    return keys


def probe_keys(threshold: int) -> list[Column]:
    """Keys, other than those of its own segments, of the segments that a line of the same or a smaller length can share with this one.

    Edits before a segment move it by at most its number, edits after it by at most the number of
    segments behind it; the difference in length ties the two together.
    """
    line, keys = F.col("line"), []
    for shorter in range(threshold + 1):
        length = F.col("size") - shorter
        for number in range(threshold + 1):
            start, size = segment(length, number, threshold)
            behind = threshold - number
            for move in range(max(-number, shorter - behind), min(number, shorter + behind) + 1):
                if shorter or move:
                    keys.append(segment_key(length, number, F.substr(line, start + move, size)))
    return keys


def all_keys(threshold: int) -> list[Column]:
    """Those of a line's segments, which also are probes, and then those that are probes only."""
    return segment_keys(threshold) + probe_keys(threshold)


def word_bits() -> Column:
    """64 bits, each the parity of the number of words that hash to it."""
    return F.expr("aggregate(split(line, ' '), 0L, (bits, word) -> bits ^ shiftleft(1L, cast(xxhash64(word) & 63 AS INT)))")


def words_allow(a: Column, b: Column, threshold: int) -> Column:
    """Whether so few edits can turn bits a into b: an edit changes a word into another, or two from or into one."""
    return F.bit_count(a.bitwiseXOR(b)) <= 3 * threshold


def keyed_lines(lines: DataFrame, threshold: int) -> DataFrame:
    """(key, part, h1, bits): a row for each segment of a line, and one for each substring it probes with besides.

    `part` is the number of the key in all_keys: up to the threshold it is a segment.
    """
    sized = lines.select("line", F.char_length("line").alias("size"))
    # What is computed from the text comes before the rows are multiplied.
    once = sized.select(F.xxhash64("line").alias("h1"), word_bits().alias("bits"), F.array(*all_keys(threshold)).alias("keys"))
    # No array is empty; a plain explode would compute them once more to check that.
    return once.select(F.posexplode_outer("keys").alias("part", "key"), "h1", "bits").select("key", "part", "h1", "bits")


def meeting(threshold: int) -> Column:
    """Whether row l of a segment and row r of `keyed_lines` are of different lines that meet and may be near."""
    return (
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.h1") != F.col("r.h1"))
        & words_allow(F.col("l.bits"), F.col("r.bits"), threshold)
    )


def lines_that_meet(firsts: DataFrame, threshold: int) -> DataFrame:
    """(h1) of the lines of which a segment is another line's substring, or the other way round.

    firsts has a row for each line, with its keys k0, k1 and so on. One shuffle by key: a row
    meets another if the smallest or the largest hash that it may meet under its key is not its own.
    A segment meets all rows, a mere probe meets segments. The lowest bit of a hash says which it is.
    """
    names = [c for c in firsts.columns if KEY.fullmatch(c)]
    keys = F.array(*(F.col(c) for c in names))
    rows = firsts.where(F.col(names[0]).isNotNull()).select(F.posexplode_outer(keys).alias("part", "key"), "h1")
    h1, is_segment = F.col("h1"), F.col("part") <= threshold
    marked = rows.select("key", F.when(is_segment, h1.bitwiseOR(F.lit(1))).otherwise(h1.bitwiseAND(F.lit(~1))).alias("mark"))
    same, own = Window.partitionBy("key"), F.col("mark").bitwiseAND(F.lit(~1))
    segment_only = F.when(F.col("mark") != own, own)
    ends = {
        f"{end}_{side}": of(hashes).over(same)
        for end, of in (("low", F.min), ("high", F.max))
        for side, hashes in (("all", own), ("segment", segment_only))
    }
    other = [F.when(F.col("mark") != own, F.col(f"{end}_all")).otherwise(F.col(f"{end}_segment")) for end in ("low", "high")]
    found = marked.withColumns(ends).where((other[0] != own) | (other[1] != own))
    return found.select(own.alias("near_h1")).distinct()


def edit_distance(a: Column, b: Column, threshold: int) -> Column:
    """The edit distance of two texts, right up to `threshold` and larger than it otherwise: of the band of that width only."""
    found = F.levenshtein(a, b, threshold)
    return F.when(found < 0, threshold + 1).otherwise(found)


def texts_of(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """(h1, h2, line) of the lines whose h1, without its lowest bit, is wanted."""
    # At most 2 ** PREFIX_BITS rows, whatever the number of lines: drops most others before the shuffle.
    prefix = F.shiftrightunsigned("h1", 64 - PREFIX_BITS)
    prefixes = F.broadcast(wanted.select(F.shiftrightunsigned("near_h1", 64 - PREFIX_BITS).alias("prefix")).distinct())
    hashed = lines_of(documents).select(*line_hashes(), "line").withColumn("prefix", prefix)
    some = hashed.join(prefixes, "prefix", "left_semi").select("h1", "h2", "line")
    met = some.withColumn("near_h1", F.col("h1").bitwiseAND(F.lit(~1))).join(wanted, "near_h1", "left_semi")
    return met.select("h1", "h2", "line").dropDuplicates(["h1", "h2"])


def near_pairs(firsts: DataFrame, documents: DataFrame, threshold: int, min_chars: int) -> DataFrame:
    """Pairs of different lines at most `threshold` edits apart: hashes (a1, a2) and (b1, b2).

    Lines that meet are found first, then their texts meet again and are compared inside the join:
    pairs that are not near are never listed.
    """
    wanted = written(lines_that_meet(firsts, threshold), "lines-that-meet")
    texts = written(texts_of(wanted, documents).where(F.char_length("line") >= min_chars), "line-texts")
    rows = written(keyed_lines(texts, threshold), "line-keys")
    segments, probes = (side.join(texts, "h1") for side in (rows.where(F.col("part") <= threshold), rows))
    shorter, longer = F.char_length("l.line"), F.char_length("r.line")
    # Lines of one length probe each other; one direction is enough.
    close = (longer - shorter <= threshold) & ((shorter < longer) | ((shorter == longer) & (F.col("l.h1") < F.col("r.h1"))))
    near = edit_distance(F.col("l.line"), F.col("r.line"), threshold) <= threshold
    met = segments.alias("l").join(probes.alias("r"), meeting(threshold) & close & near)
    return met.select(
        F.col("l.h1").alias("a1"), F.col("l.h2").alias("a2"), F.col("r.h1").alias("b1"), F.col("r.h2").alias("b2")
    ).distinct()


def repeated_lines(documents: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, version, dropped): for each document with lines to drop, their numbers from 0, in order.

    `version` is a hash of the text, which tells rows with the same doc_id apart.
    """
    documents = documents.select("doc_id", "text")
    long = F.col("size") >= min_chars
    lines = lines_of(documents).withColumn("size", F.char_length("line"))
    keys = F.when(long, F.array(*all_keys(threshold))).alias("keys")
    where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "place")
    # The texts are cut once more for the places: keys of every line are more to store than the documents.
    places = lines.select(*line_hashes(), "doc_id", "version", "place")
    keyed = lines.select(*line_hashes(), "doc_id", "version", "place", keys)
    firsts = keyed.groupBy("h1", "h2").agg(F.min(where).alias("first"), F.first("keys").alias("keys"))
    firsts = written(firsts, "first-lines")

    # One column through the aggregation, whose rows would be twice as wide with a column a key.
    each = firsts.select("h1", *(F.col("keys")[n].alias(f"k{n}") for n in range(len(all_keys(threshold)))))
    near = written(near_pairs(each, documents, threshold, min_chars), "near-lines")
    # Few lines are near another: most are dropped before the joins.
    ends = near.select(F.explode(F.array("a1", "b1")).alias("end"))
    some = written(may_be_among(firsts.select("h1", "h2", "first"), "h1", ends, "end"), "near-firsts")
    a = some.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("first").alias("fa"))
    b = some.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("fb"))
    ordered = near.join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    later = F.when(F.col("fa") < F.col("fb"), F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2"))).otherwise(
        F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2"))
    )
    gone = ordered.select(later.alias("line")).select("line.*").distinct().withColumn("gone", F.lit(True))
    known = firsts.select("h1", "h2", "first").join(gone, ["h1", "h2"], "left")
    judged = places.join(known, ["h1", "h2"])
    dropped = judged.where(F.col("gone") | (where != F.col("first")))
    return dropped.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("place")).alias("dropped"))


def with_dropped(documents: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The documents with a column of the numbers of their lines to drop: empty for most."""
    doc, version, places, own = (unused(documents, n) for n in ("dropped_id", "dropped_version", "dropped", "own_version"))
    joined = documents.withColumn(own, F.xxhash64("text")).join(
        dropped.toDF(doc, version, places),
        F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(version)),
        "left",
    )
    found = F.coalesce(places, F.array().cast("array<int>"))
    return joined.select(*(F.col(f"`{c}`") for c in documents.columns), found.alias(name))


def without_repeated_lines(
    documents: DataFrame,
    threshold: int = THRESHOLD,
    min_chars: int = MIN_CHARS,
    drop_emptied: bool = False,
) -> DataFrame:
    """The documents, with all their columns, without their repeated lines; text is the only column that changes.

    A document that loses lines and has none but blank ones left, a copy of others, goes if `drop_emptied` is set.
    """
    name = unused(documents, "lines_to_drop")
    dropped = repeated_lines(documents, threshold, min_chars)
    marked = with_dropped(documents, dropped, name)
    lines, found = split_lines(F.col("text")), F.col(name)
    kept = F.filter(lines, lambda line, place: ~F.array_contains(found, place))
    if drop_emptied:
        marked = marked.where((F.size(found) == 0) | F.exists(kept, lambda line: line.rlike(NOT_BLANK)))
    text = F.when(F.size(found) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    return marked.withColumn("text", text).drop(name)


def op4_segment_edit_join(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    dropped = repeated_lines(documents)
    counted = documents.select("doc_id", "text", F.size(split_lines(F.col("text"))).alias("n_lines"))
    return with_dropped(counted, dropped, "found").select(
        "doc_id",
        "n_lines",
        F.size("found").alias("n_dropped"),
        F.array_join(F.col("found").cast("array<string>"), ",").alias("dropped"),
    )


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS place
  FROM documents),
said AS (SELECT doc_id, line, place FROM lines WHERE regexp_matches(line, '[^ \t\r\f\v]')),
firsts AS (SELECT line, min((doc_id, place)) AS first FROM said GROUP BY line),
gone AS (
  SELECT DISTINCT b.line FROM firsts a JOIN firsts b ON length(a.line) BETWEEN length(b.line) - 2 AND length(b.line) + 2
    AND length(a.line) >= 32 AND length(b.line) >= 32 AND a.first < b.first AND levenshtein(a.line, b.line) <= 2),
dropped AS (
  SELECT doc_id, place FROM said JOIN firsts USING (line)
  WHERE line IN (SELECT line FROM gone) OR (doc_id, place) <> first),
per_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS dropped FROM dropped GROUP BY doc_id)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS INTEGER) AS n_lines,
  CAST(coalesce(n, 0) AS INTEGER) AS n_dropped, coalesce(dropped, '') AS dropped
FROM documents LEFT JOIN per_doc USING (doc_id)
"""
