import hashlib
import json

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyrock.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def encoded(texts, **options):
    encoder = bpe.Encoder(bpe.load(PATH), **options)
    ids, ends = encoder(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


TEXTS = [
    None, "", " \n\t ", "The quick brown fox doesn't, WE'LL and I'm", "aaaaaaaaaaaaaaaaaaaa aaaa aaa", "ΑΣ Σ ΣΑΣ İstanbul ǅ",
    "é é Å ẛ̣", "a<|endoftext|>b <|startoftext|><|startoftext|> <|END", "e<|endoftext|>́",
    "漢字かな \U0001f600\U0001f600 ‍", "1234 ½ ² ٣", "a\x00b\x1cc\x85d\xa0e f​g_h", "x" * 5000, "ab" * 3000 + " " + "é" * 2000,
    "<|endoftext|>",
]


def test_ids_and_decoded_texts_are_those_of_the_library(docs):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id")]
    found = sorted(map(tuple, bpe.round_trip(docs(*rows)).collect()), key=str)
    assert found == sorted([(i, *expected(t)) for i, t in rows], key=str)


def test_every_character_gives_the_ids_of_the_library():
    lines = [f"a{chr(c)}B 1{chr(c)}" for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(lines), 8192):
        some = lines[start : start + 8192]
        assert encoded(some) == [e.ids for e in LIBRARY.encode_batch(some, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcdeinrsth'  1.é") | st.characters(blacklist_categories=["Cs"]), max_size=60), max_size=8))
def test_any_texts(texts):
    assert encoded(texts) == [expected(t)[0] for t in texts]


def test_forgetting_words_and_small_groups_change_nothing(monkeypatch):
    whole = encoded(TEXTS)
    monkeypatch.setattr(bpe, "GROUP", 8)
    encoder = bpe.Encoder(bpe.load(PATH), kept_words=0)
    for text, ids in zip(TEXTS, whole):
        assert encoder([text])[0].tolist() == ids


def test_the_query_gives_the_digests_of_the_library(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = bpe.op11_pair_index_bpe(spark, small).collect()
    assert len(found) == len(texts)
    for row in found:
        ids, text = expected(texts[row["doc_id"]])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), digest)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_an_empty_table_gives_no_rows(docs):
    assert bpe.round_trip(docs()).count() == 0


def test_other_layouts_are_refused(tmp_path):
    with pytest.raises((ValueError, TypeError, KeyError)):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as file:
        content = json.load(file)
    content["model"]["merges"] = content["model"]["merges"][::-1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(path))


def test_a_worker_keeps_its_merged_words_from_task_to_task():
    encoder = bpe.encoder_of(PATH)
    assert encoder(["river mill river"])[0].tolist() == expected("river mill river")[0]
    known = len(encoder.numbers)
    assert bpe.encoder_of(PATH) is encoder and bpe.encoder_of(PATH)(["mill river"])[0].tolist() == expected("mill river")[0]
    assert len(encoder.numbers) == known
