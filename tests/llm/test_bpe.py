import hashlib
import random

import pytest

from starwise.llm import bpe
from starwise.llm.queries import QUERIES, VOCABULARY

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe(bpe.vocabulary(VOCABULARY))


def random_text(rng):
    parts = [
        lambda: chr(rng.randint(0, 0x2FF)),
        lambda: chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])),
        lambda: rng.choice(" \n\t'sdlremt019_.ñéß"),
        lambda: rng.choice(["<|endoftext|>", " the", "'ll", "  ", "\r\n", "ing", " an"]),
    ]
    return "".join(rng.choice(parts)() for _ in range(rng.randint(0, 40)))


def test_ids_and_texts_are_those_of_the_library(ours, theirs):
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(1500)] + ["", " ", "the", "'s", "\u0085  x", "\x1c\x1d"]
    for text, ids in zip(texts, ours.encode_batch(texts)):
        expected = theirs.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert ours.decode(ids) == theirs.decode(expected, skip_special_tokens=False) == text


def test_long_words_take_the_heap_and_agree(ours, theirs):
    rng = random.Random(2)
    for size in (bpe.SHORT - 1, bpe.SHORT, bpe.SHORT + 1, 500, 3000):
        for letters in ("ab", "thehe", "abcdefghinot"):
            word = "".join(rng.choice(letters) for _ in range(size))
            expected = theirs.encode(word).ids
            assert ours.encode(word) == expected
            assert ours.merge_equal([word.encode()])[0].tolist() == ours.merge_long(word.encode()).tolist() == expected


def test_broken_ids_decode_with_replacement(ours, theirs):
    ids = ours.encode("é二")[:-1]
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    small = bpe.Bpe(bpe.vocabulary(VOCABULARY))
    texts = ["one two three four", "five six <|endoftext|> one", "two seven"]
    for _ in range(2):
        assert [x.tolist() for x in small.encode_batch(texts)] == [theirs.encode(t).ids for t in texts]


def test_rows(odd, none, theirs):
    found = [tuple(r) for r in bpe.encode_texts(odd, VOCABULARY).collect()]
    expected = [(r.doc_id, theirs.encode(r.text or "").ids, r.text or "") for r in odd.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert bpe.encode_texts(none, VOCABULARY).count() == 0
    back = bpe.decode_ids(bpe.encode_texts(odd, VOCABULARY, decode=False), VOCABULARY)
    assert sorted(r.text for r in back.collect()) == sorted(t for _, _, t in expected)


def test_query(spark, theirs, tmp_path):
    texts = ["The quick fox.", None, "", "naïve <|endoftext|> 二"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in QUERIES["op1_bpe"](spark, str(tmp_path)).collect():
        text = texts[row.doc_id] or ""
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
