import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyrock.llm import packing


@pytest.fixture(scope="module")
def reference_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


TEXTS = ["river mill water", "", None, "a  b\n\n c\t ", "don't 123 ünï 漢字 \U0001f600", "<|endoftext|>", "word " * 5000,
         "river water boat", "river mill water"]


def test_the_encoder_is_that_of_the_tokenizer_file(reference_ids):
    encoder = packing.load_encoder(public_tokenizers.path(packing.VOCABULARY))
    for text in TEXTS:
        assert encoder.encode_ordinary(text or "") == reference_ids(text)[:-1]


def test_every_id_lies_in_one_piece_and_windows_are_full(docs, reference_ids):
    rows = [*enumerate(TEXTS), (None, "no id"), (0, "river mill water")]
    found = packing.pack(docs(*rows), window=64, shard_docs=4).collect()
    whole, windows = defaultdict(list), defaultdict(list)
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["length"] == len(r["ids"]) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert sum(p["length"] for p in windows[r["sequence_id"]]) == r["offset"]
        windows[r["sequence_id"]].append(r)
        whole[r["doc_id"]].append(r)
    expected = Counter()
    for doc_id, text in rows:
        expected[doc_id] += len(reference_ids(text))
    assert {k: sum(p["length"] for p in v) for k, v in whole.items()} == expected
    long = sorted(whole[6], key=lambda r: r["start"])
    assert [i for r in long for i in r["ids"]] == reference_ids("word " * 5000)
    sizes = [sum(p["length"] for p in w) for w in windows.values()]
    assert max(sizes) <= 64 and sum(s < 64 for s in sizes) <= 3 + 1


def test_an_empty_table_gives_no_rows(docs):
    assert packing.pack(docs()).count() == 0


def test_scores_are_those_of_bm25():
    draw = np.random.default_rng(2)
    documents = [draw.integers(0, 60, draw.integers(0, 90)).astype(np.uint32) for _ in range(50)]
    idf = draw.random(60)
    scores = packing.similarities(documents, idf, 40.0)

    def bm25(query, document):
        tf = Counter(document.tolist())
        norm = packing.K1 * (1 - packing.B + packing.B * len(document) / 40.0)
        return sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in set(query.tolist()) if tf[t])

    for i in range(50):
        for j in range(50):
            if i != j:
                assert scores[i, j] == pytest.approx(bm25(documents[i], documents[j]), rel=1e-4, abs=1e-4)


def test_the_best_unused_neighbour_fills_the_window():
    scores = np.array([[0, 1, 5, 2], [1, 0, 1, 9], [5, 1, 0, 3], [2, 9, 3, 0]], np.float32)
    pieces = list(packing.fill_windows([6, 5, 7, 4], scores, 10))
    # 0 begins a window, 2 is nearest and goes on in the next window, whose nearest unused is 3.
    assert [p[0] for p in pieces] == [0, 2, 2, 3, 1, 1]
    assert pieces[1] == (2, 0, 4, 0, 6) and pieces[2] == (2, 4, 3, 1, 0)


def test_documents_of_like_content_share_a_shard(docs):
    draw = np.random.default_rng(4)
    topics = ["river mill water boat fish shore bridge stream".split(), "music song piano drum voice choir dance opera".split()]
    rows = [(k, " ".join(draw.choice(topics[k % 2], 80))) for k in range(160)]
    shards = defaultdict(set)
    for r in packing.pack(docs(*rows), window=64, shard_docs=80).collect():
        shards[r["sequence_id"] >> packing.LEAF_BITS].add(r["doc_id"])
    assert sorted(map(sorted, shards.values())) == [list(range(0, 160, 2)), list(range(1, 160, 2))]


def test_copies_of_one_document_are_spread_over_shards(docs):
    shards = defaultdict(set)
    for r in packing.pack(docs(*((k, "river mill water") for k in range(200))), window=64, shard_docs=32).collect():
        shards[r["sequence_id"] >> packing.LEAF_BITS].add(r["doc_id"])
    assert len(shards) == 8 and max(map(len, shards.values())) <= 64


def whole_and_full(found, rows, window):
    """Every document lies whole in its pieces, and sequences are gapless from 0; returns the sizes of the sequences."""
    tokens, windows = Counter(), defaultdict(list)
    for r in found:
        tokens[r["doc_id"]] += r["length"]
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(tokens) == {i for i, _ in rows}
    for pieces in windows.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
    return [sum(length for _, length in pieces) for pieces in windows.values()]


def test_very_many_equal_rows_are_packed_in_bounded_shards(docs):
    rows = [(7, "river mill water")] * 20_000
    found = packing.pack(docs(*rows), keep_ids=False).collect()
    sizes = whole_and_full(found, rows, packing.WINDOW)
    tokens = found[0]["doc_tokens"]
    assert sum(sizes) == 20_000 * tokens and len(sizes) <= 20_000 * tokens / packing.WINDOW + 32
    parts = [pa_batch(k) for k in range(5)]
    found = list(packing.shards(iter(parts), 30))
    assert [len(held) for _, _, held in found] == [30] * 15 + [50] and [begins for _, begins, _ in found] == [True] + [False] * 15


def pa_batch(number):
    columns = [[3] * 100, [0] * 100, list(range(100)), [number] * 100, [b""] * 100]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["leaf", "place", "key", "doc_id", "ids"])


def test_below_the_tree_the_signs_of_the_sketch_deal_on(docs, monkeypatch):
    draw = np.random.default_rng(9)
    rows = [(k, " ".join(draw.choice([f"w{x}" for x in range(300)], 60))) for k in range(400)]
    monkeypatch.setattr(packing, "TREE_DEPTH", 2)
    found = packing.pack(docs(*rows), window=64, shard_docs=16, keep_ids=False).collect()
    sizes = whole_and_full(found, rows, 64)
    leaves = {r["sequence_id"] >> packing.LEAF_BITS for r in found}
    # Four leaves of the tree, each dealt to up to eight by three signs.
    assert 8 < len(leaves) <= 32 and len({leaf >> 3 for leaf in leaves}) == 4
    assert sum(s < 64 for s in sizes) <= 2 * len(rows) / 16


def test_scores_of_a_shard_do_not_depend_on_the_rows_scored_at_a_time(monkeypatch):
    random = np.random.default_rng(3)
    documents = [random.integers(0, 300, size).astype(np.uint32) for size in random.integers(0, 80, 150)]
    whole = packing.similarities(documents, np.ones(300), 40.0)
    monkeypatch.setattr(packing, "ROWS", 7)
    assert np.allclose(packing.similarities(documents, np.ones(300), 40.0), whole, rtol=1e-5)
