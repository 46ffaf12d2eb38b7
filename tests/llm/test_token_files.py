import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starwise.llm import token_files
from starwise.llm.queries import END_ID, QUERIES, WORD_VOCABULARY
from starwise.runtime import scratch_folder

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def theirs():
    return tokenizers.Tokenizer.from_file(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def ours():
    with open(WORD_VOCABULARY, "rb") as file:
        return token_files.WordCoder(file.read())


def random_text(rng):
    parts = [
        lambda: chr(rng.randint(0, 0x2FF)),
        lambda: chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])),
        lambda: rng.choice(" \n\t'sdlremt019_.ñéßİΣ²½"),
        lambda: rng.choice(["<|endoftext|>", " THE", "'ll", "  ", "\r\n", "ing", " an", "it's", "é", "#", "\x1c"]),
    ]
    plain = rng.random() < 0.7
    return "".join(rng.choice([parts[0], *parts[2:]] if plain else parts)() for _ in range(rng.randint(0, 40)))


def test_ids_are_those_of_the_library(ours, theirs):
    rng = random.Random(1)
    each = [f"a{chr(code)}B {chr(code)}'s{chr(code)} x" for code in [*range(0x300), 0x1680, 0x2003, 0x2028, 0x3000, 0x200B]]
    texts = [None, "", " ", "the", *each, *(random_text(rng) for _ in range(1500))]
    assert ours.encode_batch(pa.array([], pa.string())) == [] == ours.encode_batch(pa.array(texts).slice(4, 0))
    assert [x.tolist() for x in ours.encode_batch(pa.array(texts[:9]).slice(3, 3))] == [theirs.encode(t).ids for t in texts[3:6]]
    assert [len(x) for x in ours.encode_batch(pa.array(["二"]))] == [len(theirs.encode("二").ids)]
    for text, ids in zip(texts, ours.encode_batch(pa.array(texts, pa.string()))):
        assert ids.tolist() == theirs.encode(text or "", add_special_tokens=False).ids, text


def test_forgetting_changes_nothing(theirs, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_BYTES", 10)
    with open(WORD_VOCABULARY, "rb") as file:
        small = token_files.WordCoder(file.read())
    for texts in (["one two, three", "four"], ["two three five's"], ["one"]):
        assert [x.tolist() for x in small.encode_batch(pa.array(texts))] == [theirs.encode(t).ids for t in texts]


@pytest.mark.parametrize("size", [0, 1, 63, 64, 511, 512, 513, 5000])
@pytest.mark.parametrize("width", [1, 4, 16, 20])
def test_wavelet_matrix(size, width):
    rng = np.random.default_rng(size * 31 + width)
    ids = rng.integers(0, 1 << width, size) if size % 2 else np.minimum(rng.geometric(0.2, size), (1 << width) - 1)
    matrix = token_files.WaveletMatrix.build(ids, width)
    assert matrix.numbers().tolist() == ids.tolist() == matrix.access(np.arange(size)).tolist()
    for number in {0, 1, 3, (1 << width) - 1, 1 << width, *ids[:5].tolist()}:
        assert matrix.occurrences(number).tolist() == np.flatnonzero(ids == number).tolist()
        assert matrix.count(number) == int((ids == number).sum())
        start, end = size // 3, size - size // 4
        assert matrix.count(number, start, end) == int((ids[start:end] == number).sum())


TEXTS = ["The quick # fox.", None, "", "naïve <|endoftext|> 二", "# # #", "long " * 5000]


def rows_of(theirs, rows):
    """Expected (doc_id, start, ids) in the order of the file; equal keys in any order."""
    return [(d, theirs.encode(t or "", add_special_tokens=False).ids + [END_ID]) for d, t in rows]


def test_query(spark, theirs, tmp_path):
    rows = [(7 * k % 40 - 3, text) for k, text in enumerate(TEXTS * 5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    frame.withColumns({"part": F.lit("x"), "start": F.lit(1), "hash": F.lit(2)}).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op12_token_files"](spark, str(tmp_path)).collect()}
    at, wanted = 0, {}
    for doc_id, ids in sorted(rows_of(theirs, rows)):
        wanted[doc_id] = (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert found == wanted and len(found) == len(rows)


@pytest.fixture(scope="module")
def folder(spark, theirs):
    rng = random.Random(3)
    rows = [(k, random_text(rng) * 20) for k in range(300)]
    place = scratch_folder(spark)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    frame.write.parquet(f"{place}/docs")
    token_files.SHARD_BYTES, before = 20_000, token_files.SHARD_BYTES  # several parts of several shards
    token_files.write_token_files(spark.read.parquet(f"{place}/docs"), place, WORD_VOCABULARY, END_ID, shard_tokens=2000)
    token_files.SHARD_BYTES = before
    return place, rows_of(theirs, rows)


def test_lookups_from_the_files(spark, folder):
    place, rows = folder
    all_ids = np.concatenate([ids for _, ids in rows])
    starts = np.cumsum([0, *(len(ids) for _, ids in rows)])
    shards = token_files.shards_of(spark, place)
    assert shards.select("part").distinct().count() > 1 and shards.count() > shards.select("part").distinct().count()
    read = {r.doc_id: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_texts(spark, place).collect()}
    assert read == {d: (int(starts[n]), ids) for n, (d, ids) in enumerate(rows)}
    for token in (END_ID, int(all_ids[10]), 49_000):
        n = token_files.count_token(spark, place, token).agg(F.sum("n")).first()[0]
        assert n == int((all_ids == token).sum())
        found = sorted((r.doc_id, r.at, r.position) for r in token_files.find_token(spark, place, token).collect())
        wanted = [(d, k, int(starts[n]) + k) for n, (d, ids) in enumerate(rows) for k, x in enumerate(ids) if x == token]
        assert found == sorted(wanted)
    ask = [0, 1, 2000, len(all_ids) - 1, len(all_ids), 17, 17]
    found = {r.position: r.token for r in token_files.tokens_at(spark, place, ask).collect()}
    assert found == {p: int(all_ids[p]) for p in ask if p < len(all_ids)}


def test_one_file_per_shard(spark, folder):
    shards = spark.read.parquet(f"{folder[0]}/shards")
    assert shards.select(F.input_file_name()).distinct().count() == shards.count()


def test_equal_keys_and_null_keys(spark, odd, none, theirs):
    for frame in (odd, none):
        place = scratch_folder(spark)
        frame.write.parquet(f"{place}/docs")
        token_files.write_token_files(spark.read.parquet(f"{place}/docs"), place, WORD_VOCABULARY)
        rows = [(r.doc_id, theirs.encode(r.text or "").ids) for r in frame.collect()]
        read = token_files.read_texts(spark, place).orderBy("start", "n_tokens").collect()
        assert sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in read) == sorted((repr(d), i) for d, i in rows)
        order = [-1 if r.doc_id is None else r.doc_id for r in read if r.n_tokens]
        assert order == sorted(order)
        assert [r.start for r in read] == [sum(x.n_tokens for x in read[:k]) for k in range(len(read))]
