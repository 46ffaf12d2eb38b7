"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.llm.text import map_slices, row_schema, texts, words
from starwise.runtime import scratch_folder

WINDOW = 13
BLOCK = 2
BLOCK_BYTES = 1_000_000  # benchmark text per block of patterns: a task holds BLOCKS_AT_ONCE
BLOCKS_AT_ONCE = 4  # searched for in one pass, before the rows are written and the next are loaded

Window = tuple[bytes, ...]


def windows(found: list[bytes], size: int = WINDOW) -> list[Window]:
    """All runs of ``size`` words; a shorter text is one window, a text without words has none."""
    if not found:
        return []
    return [tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]


@dataclass
class Search:
    """Wu-Manber tables for patterns of ``shortest`` words and more.

    ``shift`` says how far the search may jump when the block of words at the end of the
    frame is the key; a block that no pattern has in its first ``shortest`` words jumps
    farthest. ``buckets`` has, per block that ends a frame, the patterns with their ids by
    length; a look-up there compares all words of the pattern with the text.
    """

    shortest: int
    shift: dict[Window, int] = field(default_factory=dict)
    buckets: dict[Window, dict[int, dict[Window, list[int]]]] = field(default_factory=dict)

    @property
    def block(self) -> int:
        return min(BLOCK, self.shortest)

    def add(self, pattern: Window, number: int) -> None:
        size, block = self.shortest, self.block
        for end in range(block, size + 1):
            key = pattern[end - block : end]
            self.shift[key] = min(self.shift.get(key, size), size - end)
        last = pattern[size - block : size]
        self.buckets.setdefault(last, {}).setdefault(len(pattern), {}).setdefault(pattern, []).append(number)

    def find(self, text: list[bytes]) -> list[tuple[int, int, list[int]]]:
        """(start, end, pattern ids) of every occurrence."""
        size, block, far = self.shortest, self.block, self.shortest - self.block + 1
        get, found, at, stop = self.shift.get, [], size, len(text)
        while at <= stop:
            key = tuple(text[at - block : at])
            jump = get(key, far)
            if jump:
                at += jump
                continue
            start = at - size
            for length, patterns in self.buckets[key].items():
                numbers = patterns.get(tuple(text[start : start + length]))
                if numbers is not None:
                    found.append((start, start + length, numbers))
            at += 1
        return found


class Matcher:
    """Searches for all windows of a block of benchmark items.

    Patterns are grouped by their length's power of two, so that a one-word item does not
    shorten the jumps made for the full windows.
    """

    def __init__(self, items: list[tuple[str, bytes | None]]):
        owners: dict[Window, set[int]] = defaultdict(set)
        self.items = sorted({item for item, _ in items})
        number = {item: n for n, item in enumerate(self.items)}
        for item, text in items:
            for window in windows(words(text)):
                owners[window].add(number[item])
        groups: dict[int, list[Window]] = defaultdict(list)
        for window in owners:
            groups[WINDOW if len(window) == WINDOW else len(window).bit_length()].append(window)
        self.searches = []
        for patterns in groups.values():
            search = Search(min(map(len, patterns)))
            for pattern in patterns:
                for owner in sorted(owners[pattern]):
                    search.add(pattern, owner)
            self.searches.append(search)

    def find(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit ranges of word positions, and the items found."""
        hits, found = [], set()
        for search in self.searches:
            for start, end, numbers in search.find(text):
                hits.append((start, end))
                found.update(numbers)
        return merge(hits), {self.items[n] for n in found}


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple[str, bytes | None]], bool]]:
    """Benchmark items in blocks of bounded size, and whether another follows; one is read at a time.

    More than one block are dealt to folders by a single pass over the benchmark.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    count = -(-total // BLOCK_BYTES) or 1
    if count > 1:
        spark, folder = benchmark.sparkSession, scratch_folder(benchmark.sparkSession)
        number = F.pmod(F.xxhash64("item", "text"), F.lit(count)).alias("number")
        items.distinct().select("*", number).repartition("number").write.partitionBy("number").parquet(folder)
        items = spark.read.schema("item string, text binary, number bigint").parquet(folder)
    for number in range(count):
        rows = items if count == 1 else items.where(F.col("number") == number)
        yield [("null" if r.item is None else r.item, r.text) for r in rows.select("item", "text").collect()], number + 1 < count


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_words``, ``hits`` (ranges of word positions) and ``items`` for every row.

    A word is hit when it lies in an occurrence of a benchmark window (13 words, or a whole
    shorter item). The benchmark is searched for in blocks of at most about 1 MB of its text, one
    after the other over the rows; after every ``BLOCKS_AT_ONCE`` blocks the rows are written to the
    checkpoint folder, so the benchmark may have any size; no row is shuffled. Null and empty
    texts have no words and no hits; a null item id is reported as ``null``; repeated rows come
    back as often as they are there, equal items count once. Only the columns named here are read.
    """
    spark = docs.sparkSession
    found = docs.select(
        key, "text", F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<array<int>>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    held, folders = [], []
    for block, goes_on in _blocks(benchmark):  # the text is handed on to the next block's search
        matcher = spark.sparkContext.broadcast(Matcher(block))
        held.append(matcher)
        names = [key, "n_words", "hits", "items", *["text"] * goes_on]
        schema = "n_words bigint, hits array<array<int>>, items array<string>" + ", text string" * goes_on

        def work(batch: pa.RecordBatch, matcher=matcher, goes_on=goes_on, names=names) -> pa.RecordBatch:
            sizes, hits, items = [], [], []
            earlier = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for text, (old_hits, old_items) in zip(texts(batch), earlier):
                cut = words(text)
                ranges, new = matcher.value.find(cut)
                sizes.append(len(cut))
                hits.append(merge([*ranges, *map(tuple, old_hits)]) if old_hits else ranges)
                items.append(sorted(new.union(old_items)))
            columns = [
                batch.column(key), pa.array(sizes, pa.int64()),
                pa.array(hits, pa.list_(pa.list_(pa.int32()))), pa.array(items, pa.list_(pa.string())),
                *[batch.column("text")] * goes_on,
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        found = map_slices(found, work, row_schema(docs, key, schema))
        if goes_on and len(held) == BLOCKS_AT_ONCE:
            folders.append(scratch_folder(spark))
            found.write.parquet(folders[-1])
            found = spark.read.schema(found.schema).parquet(folders[-1])
            for used in held:
                used.destroy()
            held = []
            if len(folders) > 1:  # the rows before these have been read for the last time
                path = spark._jvm.org.apache.hadoop.fs.Path(folders.pop(0))
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return found


def judge(found: DataFrame) -> DataFrame:
    """``n_hit``, ``n_items`` and ``contaminated``: hit at all, and in a twentieth of the words."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, r: total + (r[1] - r[0]))
    counted = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("bigint"))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with all their columns.

    The columns travel as one struct beside the text, so any names are possible.
    """
    keyed = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "text")
    judged = judge(find_contamination(keyed, benchmark, "row"))
    return judged.where(~F.col("contaminated")).select(*(F.col("row").getField(n).alias(n) for n in docs.columns))
