import random

import pytest
from pyspark.sql import functions as F

from tallyrock.llm import line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(rows, threshold, min_chars):
    """(doc_id, text) to kept lines, by comparing all lines with all."""
    order = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    firsts = {}
    for k, (_, text) in enumerate(order):
        for place, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r\f\v"):
                firsts.setdefault(line, (k, place))
    long = {line: at for line, at in firsts.items() if len(line) >= min_chars}
    gone = {
        b for b, at in long.items()
        if any(x < at and abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold for a, x in long.items())
    }
    kept = {}
    for k, (doc_id, text) in enumerate(order):
        lines = enumerate((text or "").split("\n"))
        kept[doc_id, text] = [
            line for place, line in lines if line not in firsts or (line not in gone and firsts[line] == (k, place))
        ]
    return kept


def edited(line, edits):
    for _ in range(edits):
        k = random.randrange(len(line))
        line = random.choice([line[:k] + line[k + 1 :], line[:k] + "é" + line[k:], line[:k] + "x" + line[k + 1 :]])
    return line


@pytest.fixture(scope="module")
def rows():
    random.seed(11)
    bases = ["".join(random.choice("abcdeé ") for _ in range(random.randint(10, 90))) for _ in range(40)]
    texts = ["\n".join(edited(random.choice(bases), random.randint(0, 4)) for _ in range(random.randint(0, 6))) for _ in range(90)]
    return [*enumerate(texts), (200, None), (201, ""), (202, "\n\n"), (203, bases[0] * 400)]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_the_same_lines_go_as_by_brute_force(docs, rows, threshold):
    documents = docs(*rows)
    found = L.without_repeated_lines(documents, threshold=threshold, min_chars=16)
    assert found.columns == documents.columns
    kept = brute_force(rows, threshold, 16)
    texts = dict(rows)
    for r in found.collect():
        assert (r["text"] or "").split("\n") == (kept[r["doc_id"], texts[r["doc_id"]]] or [""])


def test_odd_rows(docs):
    line = "a line that is long enough to count here"
    documents = docs((1, line), (None, f"own\n{line}"), (1, line), (3, f"{line}!\nshort"), (4, None), (5, f"{line}\n{line}"))
    found = L.without_repeated_lines(documents)
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in found.collect()), key=str) == sorted(
        [(1, line), (1, line), (0, "own"), (3, "short"), (4, None), (5, "")], key=str
    )
    assert L.without_repeated_lines(documents, drop_emptied=True).where("doc_id = 5").count() == 0
    assert L.without_repeated_lines(docs()).count() == 0


@pytest.mark.parametrize("threshold", [1, 2, 4])
def test_the_banded_distance_is_right_up_to_the_threshold(spark, threshold):
    random.seed(threshold)
    pairs = []
    for _ in range(400):
        a = "".join(random.choice("abé") for _ in range(random.randint(8, 40)))
        pairs.append((a, edited(a, random.randint(0, 6))))
    frame = spark.createDataFrame([p for p in pairs if abs(len(p[0]) - len(p[1])) <= threshold], "a string, b string")
    for r in frame.withColumn("d", L.edit_distance(F.col("a"), F.col("b"), threshold)).collect():
        assert min(r["d"], threshold + 1) == min(distance(r["a"], r["b"]), threshold + 1)


def test_no_python_runs_on_the_main_path(docs):
    frame = docs((1, "x" * 50), (2, "y" * 50))
    for part in (L.lines_of(frame), L.repeated_lines(frame), L.without_repeated_lines(frame)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_repeats_of_any_length_go_and_blank_lines_stay(docs):
    line = "a line that is long enough to count here"
    passage = f"One.\n{line}\n\nTwo.\nThree."
    rows = [
        (1, passage),
        (2, f"Own.\n{passage}\n\nEnd."),
        (3, "Two.\nmine\nThree."),
        (4, passage),
        (5, "Alone"),
        (6, "\nAlone\n"),
        (None, passage),
        (7, "\n \t\n"),
        (8, None),
        (5, "Alone"),
        (9, "Twp."),  # near a short line, which is not compared
    ]
    found = L.without_repeated_lines(docs(*rows), drop_emptied=True)
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in found.collect()), key=str) == sorted(
        [(1, passage), (2, "Own.\n\n\nEnd."), (3, "mine"), (5, "Alone"), (5, "Alone"), (7, "\n \t\n"), (8, None), (9, "Twp.")], key=str
    )


def test_a_line_that_very_many_documents_share_meets_others_once(docs):
    line = "a line that is long enough to count here"
    frame = docs(*((k, f"{line}\nown line of document number {k} and no other") for k in range(300)))
    keyed = L.lines_of(frame).withColumn("size", F.char_length("line"))
    places = keyed.select(*L.line_hashes(), *(k.alias(f"k{n}") for n, k in enumerate(L.all_keys(2))))
    firsts = places.groupBy("h1", "h2").agg(*(F.first(f"k{n}").alias(f"k{n}") for n in range(len(L.all_keys(2)))))
    assert firsts.count() == 301 and len(L.all_keys(2)) == 12
    shared = frame.select(F.xxhash64(F.lit(line)).bitwiseAND(F.lit(~1))).first()[0]
    met = {r[0] for r in L.lines_that_meet(firsts, 2).collect()}
    assert len(met) > 200 and shared not in met


def test_the_pipeline_drops_copies_with_short_lines(spark, docs):
    from corpus_pipeline import fresh_lines

    text = "Les.\na line that is long enough to count here\nOf, it.\n"
    frame = docs((1, text), (2, text), (3, f"{text}New.")).withColumn("n_chars", F.length("text"))
    found = {r["doc_id"]: r["text"] for r in fresh_lines(spark, frame, "").collect()}
    assert found == {1: text, 3: "New."}


def test_no_table_has_a_row_per_occurrence_with_its_keys(docs, monkeypatch):
    kept, write = [], L.written
    monkeypatch.setattr(L, "written", lambda frame, label: kept.append(frame.columns) or write(frame, label))
    line = "a line that is long enough to count here"
    found = L.repeated_lines(docs((1, line), (2, f"{line}\nother"), (3, line.replace("long", "lung")))).collect()
    assert sorted((r["doc_id"], r["dropped"]) for r in found) == [(2, [0]), (3, [0])]
    assert kept and not any("place" in columns for columns in kept)
    assert [c for c in kept if "keys" in c] == [["h1", "h2", "first", "keys"]]
