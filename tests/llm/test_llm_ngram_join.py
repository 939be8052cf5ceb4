import random
from collections import defaultdict

import numpy as np
import pytest

from tallyrock.llm import ngram_join as N
from tallyrock.llm.common import may_be_among
from tallyrock.llm.components import components
from tallyrock.llm.shingles import shingle_sets


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def brute_force(rows):
    """Component of each row's place: the smallest id that links reach."""
    sets, parent = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        members[root(k)].append(doc_id)
    return [
        (doc_id, len(sets[k]), min((m for m in members[root(k)] if m is not None), default=None)) for k, (doc_id, _) in enumerate(rows)
    ]


def changed(words, share):
    return " ".join(f"w{random.randrange(10**6)}" if random.random() < share else w for w in words)


@pytest.fixture(scope="module")
def rows():
    random.seed(4)
    common = [f"c{k}" for k in range(40)]
    found, doc_id = [], 0
    for _ in range(25):
        base = [f"w{random.randrange(2000)}" for _ in range(random.choice([3, 5, 6, 30, 120, 400]))]
        for _ in range(random.choice([1, 2, 6])):
            text = changed(base, random.choice([0, 0.01, 0.02, 0.04, 0.1]))
            found.append((doc_id, text + random.choice(["", "", " " + " ".join(common)])))
            doc_id += 1
    random.shuffle(found)
    return [*found, (900, None), (901, ""), (902, " \n\t"), (None, "one two three"), (903, "ONE two\nthree"), (904, "Ä b c d e f"),
            (905, "ä b c d e f"), (906, " ".join(["same"] * 50_000)), (907, "same " * 5), (907, "same " * 5), (None, found[0][1])]


def test_components_are_those_of_brute_force(spark, rows, rows_of):
    documents = spark.createDataFrame(rows, "id long, text string")
    found = rows_of(N.near_duplicates(documents), "id", "n_shingles", "component_id")
    assert found == sorted(brute_force(rows), key=lambda r: [(v is not None, v) for v in r])


def test_one_of_each_stays(docs, rows, rows_of):
    kept = N.one_of_each(docs(*rows))
    assert kept.columns == docs().columns
    empty = [(i, t) for i, t in rows if not plain_set(t)]
    found = rows_of(kept, "doc_id", "text")
    names = {c for _, n, c in brute_force(rows) if n}
    assert {i for i, t in found if plain_set(t)} == names and len(found) == len(names) + len(empty)


def test_an_empty_table(spark, docs):
    assert N.near_duplicates(spark.createDataFrame([], "id long, text string")).count() == 0
    assert N.one_of_each(docs()).count() == 0


def test_shingles_match_plain_sets(rows):
    texts = [t for _, t in rows]
    assert [len(s) for s in shingle_sets(texts)] == [len(plain_set(t)) for t in texts]
    assert shingle_sets(["A b c d e f"])[0].tolist() == shingle_sets(["x", "a\tB  c\nd e F"])[1].tolist()


def test_the_tree_finds_what_the_bound_allows():
    draw = np.random.default_rng(3)
    points, sizes = draw.integers(0, 6, (700, 16)), None
    sizes = points.sum(axis=1)
    tree = N.RTree(points, sizes)
    for k in range(0, 700, 23):
        near = np.minimum(points, points[k]).sum(axis=1) >= N.least_overlap(sizes + sizes[k])
        assert sorted(tree.search(points[k], int(sizes[k])).tolist()) == np.flatnonzero(near).tolist()


@pytest.mark.parametrize("hot, block", [(0, 4096), (0, 2), (3, 3)])
def test_large_buckets_and_blocks_give_the_same(spark, rows, rows_of, monkeypatch, hot, block):
    monkeypatch.setattr(N, "HOT", hot)
    monkeypatch.setattr(N, "BLOCK", block)
    documents = spark.createDataFrame(rows, "id long, text string")
    found = rows_of(N.near_duplicates(documents), "id", "n_shingles", "component_id")
    assert found == sorted(brute_force(rows), key=lambda r: [(v is not None, v) for v in r])


def test_components_of_a_long_chain(spark, rows_of):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert rows_of(components(links), "node", "component") == [(k, 0) for k in range(61)] + [(100, 100), (101, 100)]


def test_the_bitmap_keeps_every_wanted_key_and_drops_most_others(spark):
    frame = spark.range(20_000).selectExpr("CASE WHEN id = 5 THEN NULL ELSE id END AS id", "id AS bitmap_part", "id * 2 AS other")
    wanted = frame.where("id % 50 = 0 OR id IS NULL").selectExpr("id AS w")
    kept = may_be_among(frame, "id", wanted, "w")
    assert kept.columns == frame.columns
    found = {r["id"] for r in kept.collect()}
    assert {r["w"] for r in wanted.collect()} <= found and len(found) < 450
    assert may_be_among(frame, "id", wanted.limit(0), "w").count() == 0


def test_sets_are_packed_in_order():
    sets = shingle_sets(["a b c d e f g h " * 3 + "x y z", "one", ""])
    for own in sets:
        assert N.unpack_set(N.pack_set(own)).tolist() == (own >> np.uint64(16)).tolist()
    assert N.overlap(*(N.unpack_set(N.pack_set(x)) for x in (sets[0], sets[0][3:]))) == len(sets[0]) - 3


def test_classes_that_their_sizes_keep_apart_are_no_pairs(spark):
    found = spark.createDataFrame([(1, 100, [7, 8]), (2, 76, [7]), (3, 74, [7, 8]), (4, 40, [9])], "cid long, n long, prefix array<long>")
    rows = N.buckets(found)
    assert {(r["token"], r["cid"], r["leader"], r["leader_n"], r["members"]) for r in rows.collect()} == {
        (7, 1, 1, 100, 3), (7, 2, 1, 100, 3), (7, 3, 1, 100, 3), (8, 1, 1, 100, 2), (8, 3, 1, 100, 2)}
    assert [tuple(r) for r in N.star_pairs(rows).collect()] == [(1, 2, 100, 76)]


def test_prefixes_and_points_come_back_as_they_were_packed():
    for values in ([5], [0, 1, 300], [1 << 40, (1 << 47) + 3], list(range(7, 90_000, 70))):
        assert N.unpack_order(N.pack_order(np.array(values, np.uint64))).tolist() == values
    assert len(N.pack_order(np.arange(1, 100, dtype=np.uint64) << np.uint64(36))) == 1 + 99 * 5
    draw = np.random.default_rng(4)
    for n, bytes_of_count in ((40, 0.5), (1000, 0.5), (16 * N.MOST_GROUPS, 1)):
        raw = N.point(draw.integers(0, 1 << 63, n).astype(np.uint64))
        counts = N.unpack(raw)
        assert counts.sum() == n and len(raw) == 1 + len(counts) * bytes_of_count
    for n in (200, 60_000):
        assert N.unpack(N.point(np.full(n, 1 << 9, np.uint64)))[2] == n


def test_a_class_meets_larger_ones_only_near_the_front_of_its_prefix(spark):
    front = list(range(26))  # of 100 shingles: 15 are near the front, of 120 all 18 of the first
    found = spark.createDataFrame([(1, 100, front), (2, 100, front), (3, 120, front[20:] + front[:12])], "cid long, n long, prefix array<long>")
    rows = N.buckets(found).collect()
    met = {(r["token"], r["cid"]) for r in rows}
    assert met == {(t, c) for t in range(15) for c in (1, 2)} | {(t, 3) for t in range(12)} | {(t, 3) for t in range(20, 26)}
    assert all(r["leader"] == (3 if r["token"] >= 20 else 1) for r in rows)
