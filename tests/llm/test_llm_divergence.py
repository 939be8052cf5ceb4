import random
from collections import Counter

import numpy as np
import pytest

from tallyrock.llm import divergence as D

LANGS = {"en": "the of and to in is it on", "de": "der die und ein ist von zu mit"}


def plain(text):
    """The counts of a text by its definition."""
    words, text = [], text or ""
    for part in text.encode().split():
        words.append(part)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = text.split("\n")
    again = sum(line in lines[:k] and bool(line.encode().split()) for k, line in enumerate(lines))
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), chars, symbols, again, len(covered), failed


def prose(lang, n):
    common = LANGS[lang].split()
    return " ".join(random.choice(common) if random.random() < 0.5 else random.choice("abcdeä") * random.randint(2, 9) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    random.seed(8)
    found = [(k, prose(lang, 200), lang) for k, lang in enumerate(["en", "de"] * 30)]
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, "src", 3) for r in rows], "doc_id long, text string, lang string, kept string, n int")


ODD = [(100, None, "en"), (101, "", None), (102, " \n\n ", "xx"), (103, "same line\nsame line\n\n\nother", "en"),
       (104, "a b c d e f g h " * 5, "en"), (105, "x " * 100_000, "en"), (None, "one\x1ctwo\x0bthree é#|", None)]


def test_counts_are_as_defined(spark, rows):
    rows = [*rows[:4], *ODD, ODD[3]]
    found = D.quality_rules(frame(spark, rows)).collect()
    got = sorted(
        (tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in found)
    )
    assert got == sorted(plain(t) for _, t, _ in rows)
    assert all(not r["kept"] for r in found if r["base_failed"])


def test_junk_goes_and_prose_stays(spark, rows):
    random.seed(9)
    junk = [(200 + k, " ".join(f"{random.choice('ABCXYZ') * 5}{random.choice('#|$')}!!" for _ in range(150)), "en") for k in range(3)]
    found = {r["doc_id"]: r for r in D.quality_rules(frame(spark, [*rows, *junk])).collect()}
    assert {found[k]["kept"] for k, _, _ in rows} == {True}
    assert {found[k]["kept"] for k, _, _ in junk} == {False}
    assert all(found[k]["nearest_lang"] in LANGS and found[k]["char_distance"] < 0.1 for k, _, _ in rows)


def test_references_count_all_documents_of_a_language(spark, rows):
    references = {r[0]: r for r in D.language_references(frame(spark, [*rows, *ODD]), min_share=0.2)}
    assert set(references) == {"en", "de"}
    words = Counter(w.encode() for _, t, lang in [*rows, *ODD] if lang == "de" for w in (t or "").split())
    assert references["de"][3] == words.total()
    top = sorted(words.items(), key=lambda p: (-p[1], p[0]))[: D.COMMON_WORDS]
    assert references["de"][2] == dict(top)


def test_distance_is_jensen_shannon():
    p, q = np.array([0.5, 0.5, 0]), np.array([0.25, 0.25, 0.5])
    m = (p + q) / 2
    kl = sum(x * np.log2(x / z) for x, z in zip(p, m) if x) / 2 + sum(x * np.log2(x / z) for x, z in zip(q, m) if x) / 2
    assert D.distances(p * 8, q[None] * 100)[0] == pytest.approx(np.sqrt(kl))
    assert D.distances(p, p[None])[0] == 0


def test_an_empty_table(spark):
    assert D.quality_rules(frame(spark, [])).count() == 0


def test_a_rare_language_is_judged_by_itself_or_not_at_all(spark, rows):
    random.seed(10)

    def foreign(n, common):
        return " ".join(random.choice(common) if random.random() < 0.5 else random.choice("opqrst") * random.randint(2, 9) for _ in range(n))

    many = [(1000 + k, prose("en", 5), "en") for k in range(36_000)]
    rare = [(200 + k, foreign(200, "ja ei on se että hän mutta".split()), "fi") for k in range(30)]  # under 0.1% of all
    few = [(300 + k, foreign(200, "az és nem hogy egy van meg".split()), "hu") for k in range(2)]
    junk = [(400, " ".join(random.choice("ABCXYZ") * 5 + "#!!" for _ in range(150)), None)]
    found = {r["doc_id"]: r for r in D.quality_rules(frame(spark, [*rows, *many, *rare, *few, *junk])).collect()}
    assert all(found[k]["kept"] and found[k]["word_distance"] < D.MAX_WORD_DISTANCE for k, _, _ in rare)
    assert all(found[k]["kept"] and found[k]["word_distance"] is found[k]["char_distance"] is None for k, _, _ in few)
    assert found[200]["nearest_lang"] and found[300]["nearest_lang"] is None
    assert not found[400]["kept"]


def test_the_number_of_languages_is_bounded(spark, rows):
    with pytest.raises(ValueError, match="more than 1 languages"):
        D.language_references(frame(spark, rows), max_languages=1)
