"""Fill-in-the-middle: texts cut at token boundaries that a Roaring-style set holds."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwise.llm.text import map_slices, row_schema

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
ARRAY_MOST = 4096  # values of 2 bytes, beyond which a bitmap of 8 KB is smaller


class ArrayContainer:
    """Sorted low halves."""

    def __init__(self, lows: np.ndarray):
        self.lows = lows.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.lows[k])


class BitmapContainer:
    """One bit per low half, with the number of bits before each 64-bit word."""

    def __init__(self, lows: np.ndarray):
        bits = np.zeros(CHUNK, bool)
        bits[lows] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.ends = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.ends, k, "right"))
        left = k - (int(self.ends[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[left])


class RunContainer:
    """First low half and length of every run, with the number of values up to each run's end."""

    def __init__(self, firsts: np.ndarray, lengths: np.ndarray):
        self.firsts = firsts.astype(np.uint16)
        self.ends = np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.ends, k, "right"))
        return int(self.firsts[run]) + k - (int(self.ends[run - 1]) if run else 0)


def container(lows: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted low halves."""
    breaks = np.flatnonzero(np.diff(lows) != 1) + 1
    if 4 * (len(breaks) + 1) < min(2 * len(lows), CHUNK // 8):
        starts = np.concatenate([[0], breaks])
        return RunContainer(lows[starts], np.diff(np.append(starts, len(lows))))
    return ArrayContainer(lows) if len(lows) <= ARRAY_MOST else BitmapContainer(lows)


class BoundarySet:
    """A set of offsets: containers by their high halves, and the values up to each container's end."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` are sorted and differ."""
        high = offsets >> CHUNK_BITS
        cuts = np.flatnonzero(np.diff(high)) + 1
        runs = np.split(offsets, cuts) if len(offsets) else []
        self.highs = [int(run[0]) >> CHUNK_BITS for run in runs]
        self.containers = [container(run & (CHUNK - 1)) for run in runs]
        self.ends = np.cumsum([len(run) for run in runs], dtype=np.int64)

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def select(self, k: int) -> int:
        """The ``k``-th smallest offset, from 0: search for its container, then select inside."""
        at = int(np.searchsorted(self.ends, k, "right"))
        local = k - (int(self.ends[at - 1]) if at else 0)
        return (self.highs[at] << CHUNK_BITS) + self.containers[at].select(local)


def token_ends(text: str) -> np.ndarray:
    """Code-point offsets at which the tokens ``[A-Za-z]+|[^A-Za-z]`` of a text end."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    inside = letter[:-1] & letter[1:]
    return np.append(np.flatnonzero(~inside) + 1, len(codes)) if len(codes) else np.empty(0, np.int64)


# The marks of the three parts, and the shares in per cent.
@dataclass(frozen=True)
class FillConfig:
    """Marks of prefix, suffix and middle; what is drawn from the key decides form and cuts."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 1
    rate: int = 90
    suffix_first: int = 20


DEFAULT = FillConfig()


def draws(seed: int, key: str) -> list[int]:
    """Four 32-bit numbers from the digest of seed and key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[at : at + 4], "big") for at in (0, 4, 8, 12)]


def rearrange(text: str, key: str, config: FillConfig = DEFAULT) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, length of prefix and middle, and the output for one text."""
    ends = token_ends(text)
    n = len(ends)
    one, two, keep, kind = draws(config.seed, key)
    marked = any(mark in text for mark in (config.prefix, config.suffix, config.middle))
    if not text or marked or keep % 100 >= config.rate:
        return n, "plain", None, None, text
    bounds = BoundarySet(np.append(0, ends))
    first, second = (bounds.select(units) for units in sorted((one % (n + 1), two % (n + 1))))
    prefix = config.prefix + text[:first]
    suffix = config.suffix + text[second:]
    middle = config.middle + text[first:second]
    if kind % 100 < config.suffix_first:
        return n, "spm", first, second - first, suffix + prefix + middle
    return n, "psm", first, second - first, prefix + suffix + middle


def fill_middle(docs: DataFrame, key: str = "doc_id", config: FillConfig = DEFAULT) -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` for every row.

    A text is cut after two drawn numbers of its tokens; the offsets are selected in the set of the
    token boundaries. The same key and text always give the same output. Reads ``key`` and ``text``
    only, so further columns may have any name. A null text is empty and stays plain, a null key
    draws as an empty one; repeated rows come back as often as they are there.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, texts = batch.column("told").to_pylist(), batch.column("text").to_pylist()
        n, form, before, middle, output = map(list, zip(*(rearrange(text or "", told, config) for told, text in zip(keys, texts))))
        columns = [pa.array(n, pa.int64()), pa.array(form, pa.string())]
        columns += [pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
        return pa.RecordBatch.from_arrays([batch.column(key), *columns], schema.names)

    schema = row_schema(docs, key, "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    told = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("told")
    return map_slices(docs.select(F.col(key), told, F.col("text")), work, schema)


def restored(output: Column, form: Column, config: FillConfig = DEFAULT) -> Column:
    """The text again. A rearranged text holds no mark of its own, so each mark is there once."""
    marks = "|".join(f"\\Q{mark}\\E" for mark in (config.prefix, config.suffix, config.middle))
    parts = F.split(output, marks)
    order = F.when(form == "psm", F.array(parts[1], parts[3], parts[2])).otherwise(F.array(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(F.array_join(order, ""))
