"""Byte-level BPE encoding and decoding by a contiguous rank array."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from functools import cache
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starwise.llm.text import keep, map_slices, row_schema

NEVER = 2**31 - 1
SHORT = 64  # bytes; longer words go through a heap, where a scan per merge would be quadratic
KEPT_WORDS = 600_000

# Unicode's White_Space code points.
WHITE_SPACE = r"\t-\r\x20\x85\xa0  -     　"

# Letters and numbers new in Unicode 16, which the vocabulary's library knows and
# Python's unicodedata (15.1) does not.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

BEYOND_BMP = re.compile("[\U00010000-\U0010ffff]")


@cache
def _class_of(kind: str, stop: int) -> str:
    """Inside of a character class with the code points below ``stop`` of a category (L or N)."""
    marked = groupby(range(stop), lambda code: unicodedata.category(chr(code))[0] == kind)
    runs = [(codes[0], codes[-1]) for wanted, codes in ((w, list(g)) for w, g in marked) if wanted]
    runs += [run for run in (NEW_LETTERS if kind == "L" else NEW_NUMBERS) if run[1] < stop]
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in runs)


@cache
def word_pattern(stop: int = sys.maxunicode + 1) -> re.Pattern:
    """The pattern that cuts a text, all of it below ``stop``, into words before any merge.

    Python's ``re`` looks a class below U+10000 up in a bitmap, and is fast there.
    """
    letters, numbers = _class_of("L", stop), _class_of("N", stop)
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{WHITE_SPACE}{letters}{numbers}]+"
        rf"|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
    )


@cache
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Bpe:
    """Encoder and decoder for a vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, file: bytes):
        data = json.loads(file)
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        vocab = {t: n for t, n in data["model"]["vocab"].items() if t not in self.special}
        self.wide = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens = [b""] * self.wide
        for token, number in vocab.items():
            self.tokens[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.tokens[number] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        keys = np.array([vocab[a] * self.wide + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.int64(2**62))
        self.pair_ranks = np.append(order, 0).astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs] + [0], np.int32)
        self.byte_ids = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.lengths = np.array([len(token) for token in self.tokens])
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Forget the words met so far. ``kept`` has a number per word; its ids lie in ``flat``."""
        self.kept: dict[str, int] = {}
        self.flat, self.first, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of joining the tokens ``left`` and ``right``, NEVER where no merge does."""
        keys = left.astype(np.int64) * self.wide + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge_equal(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of words of equal length, all of them merged in step.

        A word is a row of ``starts`` (its part boundaries), ``ids`` (the part from boundary
        ``i`` to ``i + 1``) and ``ranks`` (of joining parts ``i`` and ``i + 1``). Each step scans
        every row for its lowest rank (leftmost of equals), deletes the boundary there and looks
        up the ranks of the new part with both neighbours. One boundary goes per row and step,
        so the rows that are left always have the same number of parts.
        """
        out: list[np.ndarray] = [self.byte_ids[:0]] * len(words)
        size = len(words[0])
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)]
        starts = np.tile(np.arange(size + 1), (len(words), 1))
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(words))
        while len(rows):
            if ids.shape[1] == 1:
                ended = np.ones(len(rows), bool)
            else:
                at = ranks.argmin(1)
                low = ranks[np.arange(len(rows)), at]
                ended = low == NEVER
            if ended.any():
                for row, found in zip(rows[ended].tolist(), ids[ended]):
                    out[row] = found
                going = ~ended
                rows, ids, starts = rows[going], ids[going], starts[going]
                if not len(rows):
                    break
                ranks, at, low = ranks[going], at[going], low[going]
            each, gone = np.arange(len(rows)), at[:, None]
            starts = _without(starts, gone + 1)
            ids = _without(ids, gone + 1)
            ids[each, at] = self.merged[low]
            ranks = _without(ranks, gone)
            parts = ids.shape[1]
            for near, first in ((at > 0, at - 1), (at < parts - 1, at)):
                r, c = each[near], first[near]
                ranks[r, c] = self.ranks(ids[r, c], ids[r, c + 1])
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for a word of any length: a heap of ranks over linked parts."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        first = self.ranks(ids[:-1], ids[1:])
        ids, size = ids.tolist(), len(word)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != NEVER).tolist()]
        heapq.heapify(heap)

        def offer(left: int, right: int) -> None:
            rank = int(self.ranks(np.int64(ids[left]), np.int64(ids[right])))
            if rank != NEVER:
                heapq.heappush(heap, (rank, left, ids[left], ids[right]))

        while heap:
            rank, left, left_id, right_id = heapq.heappop(heap)
            right = after[left]
            if ids[left] != left_id or right >= size or ids[right] != right_id:
                continue
            ids[left], ids[right], after[left] = int(self.merged[rank]), -1, after[right]
            if after[left] < size:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, pieces: set[str]) -> None:
        """Merge words that were not met before and keep their ids."""
        if len(self.kept) > KEPT_WORDS:
            self.forget()
        if not self.kept:
            self._keep(list(self.special), [np.array([n], np.int32) for n in self.special.values()])
        lengths = defaultdict(list)
        for piece in pieces.difference(self.kept):
            raw = piece.encode()
            lengths[len(raw)].append((piece, raw))
        new, ids = [], []
        for size, found in lengths.items():
            raws = [raw for _, raw in found]
            new += [piece for piece, _ in found]
            ids += self.merge_equal(raws) if size <= SHORT else map(self.merge_long, raws)
        if new:
            self._keep(new, ids)

    def _keep(self, pieces: list[str], ids: list[np.ndarray]) -> None:
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        self.kept.update(zip(pieces, range(len(self.kept), len(self.kept) + len(pieces))))
        self.first = np.append(self.first, len(self.flat) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.flat = np.concatenate([self.flat, *ids])

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids per text; special tokens written in a text become their ids. Null: none."""
        cut: list[list[str]] = []
        for text in texts:
            text = text or ""
            pattern = word_pattern() if BEYOND_BMP.search(text) else word_pattern(0x10000)
            if not any(token in text for token in self.special):
                cut.append(pattern.findall(text))
                continue
            parts = self.cut.split(text)
            cut.append([w for n, part in enumerate(parts) for w in ([part] if n % 2 else pattern.findall(part))])
        self.learn(set().union(*cut))
        out = []
        for pieces in cut:
            at = np.fromiter(map(self.kept.__getitem__, pieces), np.int64, len(pieces))
            out.append(_runs(self.flat, self.first[at], self.count[at]))
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        return _runs(self.bytes, self.firsts[ids], self.lengths[ids]).tobytes().decode("utf-8", "replace")


def _runs(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs ``values[first : first + count]``, one after another."""
    ends = np.cumsum(count)
    return values[np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


def _without(rows: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Each row without the element at its ``gone``."""
    columns = np.arange(rows.shape[1] - 1)[None, :]
    return np.take_along_axis(rows, columns + (columns >= gone), 1)


@cache
def load(file: bytes) -> Bpe:
    """One encoder per worker and vocabulary, with the words it has met."""
    return Bpe(file)


keep(__name__, load.cache_clear)


def vocabulary(path: str) -> bytes:
    """The vocabulary file, read on the driver and sent along: executors need no copy of it."""
    return Path(path).read_bytes()


def encode_texts(df: DataFrame, path: str, key: str = "doc_id", decode: bool = True) -> DataFrame:
    """``key``, ``ids`` and (unless ``decode`` is off) ``decoded`` for every row of ``df``.

    Reads ``key`` and ``text`` only, so further columns may have any name. A null or empty text
    has no ids and decodes to an empty text; repeated rows and null keys come back as they are.
    A word of more than 64 bytes is merged through a heap, with the same result.
    """
    file = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = load(file.value)
        ids = model.encode_batch(batch.column("text").to_pylist())
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))
        columns = [batch.column(key), lists]
        if decode:
            columns.append(pa.array([model.decode(x) for x in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"][: len(columns)])

    schema = row_schema(df, key, "ids array<int>" + ", decoded string" * decode)
    return map_slices(df.select(key, "text"), work, schema)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` for rows of token ids; null ids give an empty text."""
    file = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = load(file.value)
        out = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.string())], [key, "text"])

    return map_slices(df.select(key, "ids"), work, row_schema(df, key, "text string"))
