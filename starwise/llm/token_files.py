"""Token ids in files of shards, each a wavelet matrix: bit planes with rank and select."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from starwise.llm.text import SLICE, keep, map_batches
from starwise.operators.prefix import block_starts

BLOCK = 512  # bits between two stored ranks
SHARD_TOKENS = 4_000_000
SHARD_BYTES = 10_000_000  # of text for one task, as long as there are fewer tasks than MOST_TASKS
MOST_TASKS = 20_000
KEPT_BYTES = 100_000_000  # of a worker's memory for words met before, roughly
SLICE_BYTES = 8_000_000  # of text encoded at a time


# ---------------------------------------------------------------- words to ids


@cache
def _plain_class(kind: str) -> str:
    """Inside of a character class with the letters (L) or numbers (N) below U+0300."""
    marked = groupby(range(0x300), lambda code: unicodedata.category(chr(code))[0] == kind)
    runs = [(codes[0], codes[-1]) for wanted, codes in ((w, list(g)) for w, g in marked) if wanted]
    return "".join(f"\\u{first:04x}-\\u{last:04x}" for first, last in runs)


@cache
def plain_words() -> re.Pattern:
    """The vocabulary's own way to cut lower-cased text into words, for code points below U+0300.

    A line feed, which is no part of a word, is found too: it parts the pieces.
    """
    letters, numbers = _plain_class("L"), _plain_class("N")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+|\n")


# Beyond U+02FF texts may be recomposed; U+001C to U+001F part words for Python but not for the
# library; a few letters have a lower case beyond U+02FF.
_RISING = "".join(f"\\x{{{code:x}}}" for code in range(0x300) if max(map(ord, chr(code).lower())) >= 0x300)
ODD = rf"[\x1c-\x1f\x{{300}}-\x{{10ffff}}{_RISING}]"


def runs(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[first : first + count]``, one after another."""
    ends = np.cumsum(count)
    return values[np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


class WordCoder:
    """The tokenizers library, asked once per word met.

    A batch of texts is lower-cased and split at white space in Arrow; each different piece is cut
    into words by the vocabulary's pattern. All words new to a worker go through the library in one
    string, where each ends with a token that closes a word. Texts with code points beyond U+02FF, odd
    separators or special tokens are encoded by the library as they are. Ids are the library's own
    in either case.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        self.whole, self.bare = Tokenizer.from_str(file.decode()), Tokenizer.from_str(file.decode())
        for tokenizer in (self.whole, self.bare):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        # the words it gets are normal and cut already
        self.bare.normalizer = normalizers.Sequence([])
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), letters])
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.wide = 1 + max(vocab.values())
        self.closing = np.zeros(self.wide, bool)
        self.closing[[n for token, n in vocab.items() if token.endswith("</w>")]] = True
        self.special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        """Forget the words met. ``words`` has a number per word, its ids are a run of ``flat``.

        The line feed has number 0 and no ids.
        """
        self.words: dict[str, int] = {"\n": 0}
        self.flat, self.first, self.count = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.held = 0

    def learn(self, found: set[str]) -> None:
        words = list(found.difference(self.words))
        if not words:
            return
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("a word does not end with one closing token in this vocabulary")
        starts = np.append(0, ends[:-1])
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.first = np.append(self.first, len(self.flat) + starts)
        self.count = np.append(self.count, ends - starts)
        self.flat = np.concatenate([self.flat, ids])
        self.held += 170 * len(words) + sum(map(len, words))  # a string, its entry and its ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after another, and how many each has."""
        if self.held > KEPT_BYTES:
            self.forget()
        found = plain_words().findall("\n".join(pieces))
        self.learn(set(found))
        word = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        count = self.count[word]
        ends = np.append(0, np.cumsum(count))[np.append(np.flatnonzero(word == 0), len(word))]
        return runs(self.flat, self.first[word], count), np.diff(ends, prepend=0)

    def encode_batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids per text, as the library gives them without added special tokens. Null: none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        plain = pc.utf8_split_whitespace(pc.utf8_lower(texts.filter(pc.invert(odd))))
        split = plain.flatten().dictionary_encode()
        ids, count = self.encode_pieces(split.dictionary.to_pylist()) if len(split.dictionary) else (self.flat[:0], np.empty(0, np.int64))
        piece = split.indices.to_numpy()
        each = count[piece]
        flat = runs(ids, (np.cumsum(count) - count)[piece], each)
        offsets = plain.offsets.to_numpy()
        cuts = iter(np.append(0, np.cumsum(each))[offsets - offsets[0]].tolist())
        start, out = next(cuts, 0), []
        for n, whole in enumerate(odd.to_pylist()):
            if whole:
                out.append(np.array(self.whole.encode(texts[n].as_py(), add_special_tokens=False).ids, np.int32))
            else:
                end = next(cuts)
                out.append(flat[start:end])
                start = end
        return out


@cache
def coder(file: bytes) -> WordCoder:
    """One per worker and vocabulary, with the words it has met."""
    return WordCoder(file)


keep(__name__, coder.cache_clear)


# ---------------------------------------------------------------- wavelet matrix


class WaveletMatrix:
    """A sequence of numbers as bit planes, from the highest bit down.

    Plane ``p`` holds bit ``p`` of every number, in the order that puts the numbers with a 0 in the
    plane above before those with a 1, each group in its former order. ``zeros`` counts the zeros
    of a plane, ``ranks`` the ones before every 512 bits. All lookups take arrays of positions.
    """

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.size, self.zeros, self.ranks = size, zeros, ranks
        self.planes = [plane.view(np.uint64).reshape(-1, BLOCK // 64) for plane in planes]

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        sequence = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for bit in range(width - 1, -1, -1):
            ones = (sequence & sequence.dtype.type(1 << bit)) != 0
            packed = np.packbits(ones, bitorder="little")
            plane = np.zeros(-(-len(sequence) // BLOCK) * (BLOCK // 8), np.uint8)
            plane[: len(packed)] = packed
            inside = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
            planes.append(plane)
            ranks.append((np.cumsum(inside) - inside).astype(np.uint32))
            zeros.append(len(sequence) - int(inside.sum()))
            sequence = np.concatenate([np.compress(~ones, sequence), np.compress(ones, sequence)])
        return cls(len(ids), planes, zeros, ranks)

    def _ones_before(self, plane: int, at: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(at), np.int64)
        block = np.minimum(at // BLOCK, len(self.ranks[plane]) - 1)
        bits = np.clip((at - block * BLOCK)[:, None] - 64 * np.arange(BLOCK // 64), 0, 64)
        full = np.uint64(2**64 - 1)
        mask = np.where(bits > 0, full >> (64 - np.maximum(bits, 1)).astype(np.uint64), np.uint64(0))
        return self.ranks[plane][block] + np.bitwise_count(self.planes[plane][block] & mask).sum(1, dtype=np.int64)

    def _bit(self, plane: int, at: np.ndarray) -> np.ndarray:
        words = self.planes[plane].reshape(-1)[at >> 6]
        return (words >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def _select(self, plane: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th (from 0) set or unset bit of a plane."""
        ranks = self.ranks[plane].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = np.searchsorted(before, k, "right") - 1
        words = self.planes[plane][block] if bit else ~self.planes[plane][block]
        left = k - before[block]
        ends = np.bitwise_count(words).cumsum(1, dtype=np.int64)
        word = (ends <= left[:, None]).sum(1)
        each = np.arange(len(k))
        left = left - np.where(word > 0, ends[each, np.maximum(word, 1) - 1], 0)
        bits = np.unpackbits(np.ascontiguousarray(words[each, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = (bits.cumsum(1, dtype=np.int64) <= left[:, None]).sum(1)
        return block * BLOCK + word * 64 + inside

    def access(self, at: np.ndarray) -> np.ndarray:
        """The numbers at the given positions."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for plane in range(len(self.planes)):
            ones = self._bit(plane, at)
            before = self._ones_before(plane, at)
            out = out << 1 | ones
            at = np.where(ones, self.zeros[plane] + before, at - before)
        return out

    def _range(self, number: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a number within ``start`` to ``end`` lie below the last plane."""
        at = np.array([start, end], np.int64)
        if number >> len(self.planes):
            return 0, 0
        for plane in range(len(self.planes)):
            before = self._ones_before(plane, at)
            at = self.zeros[plane] + before if number >> (len(self.planes) - 1 - plane) & 1 else at - before
        return int(at[0]), int(at[1])

    def count(self, number: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a number within ``start`` (in) to ``end`` (out)."""
        first, last = self._range(number, start, self.size if end is None else end)
        return last - first

    def occurrences(self, number: int) -> np.ndarray:
        """All positions of a number, ascending: its range below the last plane, selected upwards."""
        at = np.arange(*self._range(number, 0, self.size), dtype=np.int64)
        for plane in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            one = number >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at

    def numbers(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last to the first, without random access."""
        out = np.zeros(self.size, np.uint32)
        for plane in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[plane].view(np.uint8).reshape(-1), count=self.size, bitorder="little").view(bool)
            above = np.empty_like(out)
            zeros = self.zeros[plane]
            above[np.flatnonzero(~ones)] = out[:zeros]
            above[np.flatnonzero(ones)] = out[zeros:] | np.uint32(1 << (len(self.planes) - 1 - plane))
            out = above
        return out


# ---------------------------------------------------------------- files

SHARD_COLUMNS = "part int, shard int, before bigint, n_tokens bigint, planes array<binary>, ranks array<binary>, zeros array<bigint>"


def shard_schema(docs: DataFrame, key: str) -> StructType:
    fields = StructType.fromDDL(f"{SHARD_COLUMNS}, counts array<bigint>")
    return fields.add("keys", ArrayType(docs.schema[key].dataType))


def _shard_row(schema: pa.Schema, part: int, shard: int, before: int, ids: list[np.ndarray], keys: list[pa.Array], width: int) -> pa.RecordBatch:
    counts = [len(x) for x in ids]
    matrix = WaveletMatrix.build(np.concatenate(ids), width)
    row = {
        "part": part, "shard": shard, "before": before, "n_tokens": matrix.size,
        "planes": [plane.tobytes() for plane in matrix.planes], "ranks": [rank.tobytes() for rank in matrix.ranks],
        "zeros": matrix.zeros, "counts": counts, "keys": pa.concat_arrays(keys).to_pylist(),
    }
    return pa.RecordBatch.from_arrays([pa.array([row[field.name]], field.type) for field in schema], schema=schema)


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = None, key: str = "doc_id", shard_tokens: int = SHARD_TOKENS
) -> None:
    """Write the ids of all texts below ``folder``, in ascending order of their keys.

    ``folder/shards`` has one Parquet file per shard, compressed: the planes of a wavelet matrix
    over the ids of whole texts (about ``shard_tokens``, one text at least), ranks, and per text its
    key and number of ids. ``folder/starts`` tells how many ids lie before each of the at most
    20,000 parts; a shard knows how many lie before it in its part. ``end_id`` is appended to
    every text.

    Texts are dealt out by range of (key, hash of the text, row), so equal keys and even equal rows
    are spread over parts; null keys come first, a null or empty text has no ids but the end id.
    An empty table gives a folder without shards. ``docs`` must come from files or a checkpoint: a
    retried task then numbers its rows as before. Columns beside ``key`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    file = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())
    schema = shard_schema(docs, key)
    texts = docs.select(F.col(key).alias("key"), F.col("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = min(MOST_TASKS, 1 + size // SHARD_BYTES)
    order = ["key", "hash", "row"]
    placed = (
        texts.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
    )
    arrow = _arrow_schema(schema)
    end = [] if end_id is None else [end_id]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = coder(file.value), TaskContext.get().partitionId()
        width = max(1, (max([model.wide - 1, *end])).bit_length())
        ids: list[np.ndarray] = []
        keys: list[pa.Array] = []
        shard = before = size = 0
        for whole in batches:
            rows = max(1, int(whole.num_rows * SLICE_BYTES / max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                found = [np.append(x, end).astype(np.int32) for x in model.encode_batch(batch.column("text"))]
                first = 0
                for n, x in enumerate(found):
                    if size and size + len(x) > shard_tokens:
                        keys.append(batch.column("key").slice(first, n - first))
                        yield _shard_row(arrow, part, shard, before, ids, keys, width)
                        shard, before, size, ids, keys, first = shard + 1, before + size, 0, [], [], n
                    ids.append(x)
                    size += len(x)
                keys.append(batch.column("key").slice(first))
        if ids:
            yield _shard_row(arrow, part, shard, before, ids, keys, width)

    shards = map_batches(placed.select("key", "text"), work, schema)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(f"{folder}/shards")
    file.unpersist()
    sizes = spark.read.schema(schema).parquet(f"{folder}/shards").groupBy("part").agg(F.sum("n_tokens").alias("size"))
    parts = sizes.agg(F.coalesce(F.max("part"), F.lit(-1))).first()[0] + 1
    block_starts(sizes, parts, "part").coalesce(1).write.parquet(f"{folder}/starts")




def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def shards_of(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder, with the number of ids before each as ``start``.

    The starts are at most 20,000 rows, written with the shards; they are broadcast.
    """
    starts = spark.read.parquet(f"{folder}/starts")
    shards = spark.read.parquet(f"{folder}/shards")
    return shards.join(F.broadcast(starts), "part").withColumn("start", F.col("start") + F.col("before"))


def _matrix(row: dict) -> WaveletMatrix:
    planes = [np.frombuffer(plane, np.uint8) for plane in row["planes"]]
    ranks = [np.frombuffer(rank, np.uint32) for rank in row["ranks"]]
    return WaveletMatrix(row["n_tokens"], planes, row["zeros"], ranks)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield {name: batch.column(name)[n].as_py() for name in batch.schema.names if name not in ("keys", "counts")} | {
                name: batch.column(name)[n].values for name in batch.schema.names if name in ("keys", "counts")
            }


def read_texts(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` (ids before it), ``n_tokens`` and ``ids`` for every text of a folder.

    ``ids`` are little-endian unsigned 32-bit integers; the end id is among them.
    """
    shards = shards_of(spark, folder)
    schema = StructType().add(key, shards.schema["keys"].dataType.elementType)
    schema = schema.add("start", LongType()).add("n_tokens", LongType()).add("ids", BinaryType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            counts = row["counts"].to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            raw = _matrix(row).numbers().astype("<u4", copy=False)
            for first in range(0, len(counts), 4 * SLICE):
                some = slice(first, first + 4 * SLICE)
                starts = ends[some] - counts[some]
                ids = pa.array([raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends[some].tolist())], pa.binary())
                columns = [row["keys"].slice(first, 4 * SLICE), pa.array(row["start"] + starts), pa.array(counts[some]), ids]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_batches(shards, work, schema)


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(part, shard, n): how often each shard holds a token, by two ranks per plane."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            place = [pa.array([row[name]], pa.int32()) for name in ("part", "shard")]
            yield pa.RecordBatch.from_arrays([*place, pa.array([_matrix(row).count(token)])], ["part", "shard", "n"])

    return map_batches(shards_of(spark, folder).drop("keys", "counts"), work, "part int, shard int, n bigint")


def find_token(spark: SparkSession, folder: str, token: int, key: str = "doc_id") -> DataFrame:
    """(key, at, position): every occurrence of a token, as offset in its text and among all ids."""
    shards = shards_of(spark, folder)
    schema = StructType().add(key, shards.schema["keys"].dataType.elementType).add("at", LongType()).add("position", LongType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ends = np.cumsum(row["counts"].to_numpy(zero_copy_only=False))
            found = _matrix(row).occurrences(token)
            text = np.searchsorted(ends, found, "right")
            at = found - np.where(text > 0, ends[np.maximum(text, 1) - 1], 0)
            columns = [row["keys"].take(pa.array(text)), pa.array(at), pa.array(row["start"] + found)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_batches(shards, work, schema)


def tokens_at(spark: SparkSession, folder: str, positions: Sequence[int]) -> DataFrame:
    """(position, token) for a given list of positions among all ids; those beyond the end are left out."""
    asked = np.unique(np.asarray(positions, np.int64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            here = asked[(asked >= row["start"]) & (asked < row["start"] + row["n_tokens"])]
            found = _matrix(row).access(here - row["start"])
            yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(found)], ["position", "token"])

    return map_batches(shards_of(spark, folder).drop("keys", "counts"), work, "position bigint, token bigint")
