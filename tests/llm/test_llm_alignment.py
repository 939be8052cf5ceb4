import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyrock.llm import alignment as A

LIBRARY = Tokenizer.from_file(public_tokenizers.path(A.A_VOCABULARY))
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.B_VOCABULARY))
BOTH = A.load(public_tokenizers.path(A.A_VOCABULARY), public_tokenizers.path(A.B_VOCABULARY))


def brute(texts):
    """Every pair of tokens compared by its bytes, one document at a time."""
    found = []
    for text in texts:
        a, b = (LIBRARY.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if b"".join(BOTH.b_bytes[i] for i in b) != raw or b"".join(BOTH.a_bytes[i] for i in a) != raw:
            a, b = [], []
        a_ends, b_ends = np.cumsum([len(BOTH.a_bytes[i]) for i in a]), np.cumsum([len(BOTH.b_bytes[i]) for i in b])
        spans = lambda ids, ends: [(i, e - s, e) for i, e, s in zip(ids, ends, np.diff(ends, prepend=0))]
        a_spans, b_spans = spans(a, a_ends), spans(b, b_ends)
        links = [(x[0], y[0]) for x in a_spans for y in b_spans if x[1] < y[2] and y[1] < x[2]]
        groups, start = [], 0
        for cut in sorted({*a_ends.tolist()} & {*b_ends.tolist()}):
            groups.append("|".join(",".join(str(i) for i, _, e in side if start < e <= cut) for side in (a_spans, b_spans)))
            start = cut
        found.append((len(a), len(b), groups, links))
    counts = Counter(link for *_, links in found for link in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, groups, links in found
    ]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "  two  spaces ", "river mill water", "river mill water", "<s>x</s><|endoftext|><unk>", "<0x41>", "a▁b",
    "漢字 \U0001f600é́ ünï", "line\nline\r\n\t x", "a\x00b", "1234567 don't", "x" * 3000, "  ", "\n",
]


def test_rows_are_those_of_comparing_all_tokens(docs, rows_of):
    rows = [*enumerate(TEXTS), (4, TEXTS[4]), (None, TEXTS[10])]
    found = rows_of(A.align(docs(*rows)), "doc_id", *NAMES)
    assert found == sorted(((i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]))), key=lambda r: [(v is not None, v) for v in r])


def test_groups_give_back_the_texts(docs):
    for r in A.align(docs(*enumerate(TEXTS))).collect():
        assert len(r["group_a"]) == len(r["group_b"]) == r["n_groups"]
        if r["n_a"]:
            a, b = 0, 0
            for next_a, next_b in zip(r["group_a"], r["group_b"]):
                left = b"".join(BOTH.a_bytes[i] for i in r["a_ids"][a:next_a])
                assert left == b"".join(BOTH.b_bytes[i] for i in r["b_ids"][b:next_b]) != b""
                a, b = next_a, next_b
            assert (a, b) == (r["n_a"], r["n_b"]) and r["a_ids"] == LIBRARY.encode(" " + TEXTS[r["doc_id"]], add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=0, max_size=40), min_size=1, max_size=6), st.integers(1, 9), st.randoms())
def test_lockstep_links_what_overlaps(documents, lane, draw):
    a_sizes = [list(d) for d in documents]
    b_sizes = []
    for d in documents:
        left, own = sum(d), []
        while left:
            own.append(min(left, draw.randint(1, 5)))
            left -= own[-1]
        b_sizes.append(own)
    flat = lambda x: np.cumsum(np.array([s for d in x for s in d], np.int64))
    a_ends, b_ends = flat(a_sizes), flat(b_sizes)
    bounds = np.append(0, np.cumsum([len(d) for d in a_sizes])).astype(np.int64)
    found = A.lockstep(a_ends, b_ends, bounds, lane)
    a_starts, b_starts = np.append(0, a_ends)[:-1], np.append(0, b_ends)[:-1]
    expected = [(i, j) for i in range(len(a_ends)) for j in range(len(b_ends)) if a_starts[i] < b_ends[j] and b_starts[j] < a_ends[i]]
    assert list(zip(found.a.tolist(), found.b.tolist())) == expected
    assert found.cut.tolist() == [a_ends[i] == b_ends[j] for i, j in expected]


def test_other_partitions_and_batches_change_nothing(docs, rows_of):
    frame = docs(*enumerate(TEXTS * 3))
    assert rows_of(A.align(frame.coalesce(1)), "doc_id", *NAMES) == rows_of(A.align(frame.repartition(7)), "doc_id", *NAMES)


def test_every_character_has_the_ids_of_the_library():
    for start in range(0, 0x40000, 256):
        text = "".join(f"a{chr(c)}b {chr(c)}1" for c in range(start, start + 256) if not 0xD800 <= c < 0xE000)
        if text:
            assert BOTH.encode_a(text) == LIBRARY.encode(" " + text, add_special_tokens=False).ids


def test_the_query(spark, small):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = {r["doc_id"]: r for r in A.op12_lockstep_alignment(spark, small).collect()}
    assert len(found) == len(texts)
    # Comparing all tokens of long texts takes too long: those are checked by their parts.
    assert all(found[i]["n_a"] == len(LIBRARY.encode(" " + t, add_special_tokens=False).ids) for i, t in texts if t)
    assert all(found[i]["n_links"] == found[i]["n_a"] + found[i]["n_b"] - found[i]["n_groups"] for i, _ in texts)


def test_an_empty_table_gives_no_rows(docs):
    assert A.align(docs()).count() == 0
