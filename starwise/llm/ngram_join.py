"""Similarity join of texts on the Jaccard index of their word n-grams, by MinHash banding."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwise.llm.components import components
from starwise.llm.text import WORD_HASHES, map_batches, map_slices, row_schema, texts, words
from starwise.runtime import materialize

BLOCK_TEXTS = 1024  # texts and n-grams that a block of a bucket holds on average at most
BLOCK_GRAMS = 1 << 19
CHUNK = 4096
MATRIX_GRAMS = 1024  # n-grams per 0/1 matrix


@dataclass(frozen=True)
class JoinConfig:
    """Texts are linked when their sets of ``size``-word n-grams have at least this Jaccard index.

    Bands and rows follow from ``recall``, the chance that a pair just at the threshold shares a
    band, with the most rows per band (the fewest false candidates) that ``hashes`` allow.
    """

    size: int = 5
    threshold: float = 0.8
    recall: float = 0.9995
    hashes: int = 128
    seed: int = 20

    @cached_property
    def shape(self) -> tuple[int, int]:
        """(bands, rows)"""
        best = (1, 1)
        for rows in range(1, self.hashes + 1):
            missed = math.log1p(-(self.threshold**rows)) if self.threshold < 1 else -math.inf
            bands = max(1, math.ceil(math.log(1 - self.recall) / missed)) if missed else self.hashes + 1
            if bands * rows <= self.hashes:
                best = (bands, rows)
        return best

    @cached_property
    def family(self) -> tuple[np.ndarray, np.ndarray]:
        """Odd factors and offsets of the hash family, one per row of each band."""
        rng = np.random.default_rng(self.seed)
        count = math.prod(self.shape)
        draw = rng.integers(0, 2**63, (2, count), np.uint64)
        return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


# The finalizer of a public 64-bit hash (MurmurHash3).
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))


def _mix(values: np.ndarray) -> np.ndarray:
    for factor in _MIX[:2]:
        values = (values ^ (values >> _MIX[2])) * factor
    return values ^ (values >> _MIX[2])


def _combine(parts: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each row of several 64-bit hashes, in their order."""
    total = np.zeros_like(parts[0])
    for part in parts:
        total = _mix(total * np.uint64(31) + part)
    return total


def grams(text: bytes | None, size: int) -> np.ndarray:
    """Distinct hashes of a text's n-grams, sorted.

    A text of fewer words is one n-gram of all its words; a text without words counts as one
    n-gram made of the text itself, so that such texts match only if they are equal.
    """
    found = words(text)
    if not found:
        return np.array([xxhash.xxh64_intdigest(text or b"", 1)], np.uint64)
    hashes = WORD_HASHES.array(found)
    WORD_HASHES.trim()
    size = min(size, len(hashes))
    last = len(hashes) - size + 1
    return np.unique(_combine([hashes[i : i + last] for i in range(size)]))


def band_hashes(found: np.ndarray, config: JoinConfig) -> np.ndarray:
    """One hash per band of the MinHash signature; n-grams are taken 4,096 at a time."""
    factors, offsets = config.family
    lowest = np.full(len(factors), np.uint64(2**64 - 1))
    for start in range(0, len(found), CHUNK):
        part = np.multiply.outer(factors, found[start : start + CHUNK])
        part += offsets[:, None]
        np.minimum(lowest, part.min(1), out=lowest)
    bands, rows = config.shape
    by_row = lowest.reshape(bands, rows)
    return _combine([by_row[:, i].copy() for i in range(rows)]).view(np.int64)


def signatures(docs: DataFrame, key: str, config: JoinConfig) -> DataFrame:
    """``key``, ``text_hash``, ``set_id`` (digest of the n-gram set), ``n_grams`` and ``bands`` per row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, bands = [], [], []
        for text in texts(batch):
            found = grams(text, config.size)
            ids.append(xxhash.xxh128_digest(found.tobytes()))
            sizes.append(len(found))
            bands.append(band_hashes(found, config))
        columns = [
            batch.column(key), batch.column("text_hash"), pa.array(ids, pa.binary()),
            pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, [key, "text_hash", "set_id", "n_grams", "bands"])

    rows = docs.select(key, "text", F.xxhash64("text").alias("text_hash"))
    schema = row_schema(docs, key, "text_hash bigint, set_id binary, n_grams bigint, bands array<bigint>")
    return map_slices(rows, work, schema)


def _buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (band, hash, set_id) and the buckets of two classes or more, with their blocks.

    Buckets with the same members, told by their count and digests, are kept once, at their
    lowest band: a group of near copies that share all bands is compared once.
    """
    banded = classes.select("set_id", "n_grams", F.posexplode("bands").alias("band", "hash"))
    member = F.xxhash64("set_id")
    buckets = banded.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n_grams").alias("size"),
        F.bit_xor(member).alias("digest"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("digest_2"),
    )
    same = buckets.where("members > 1").groupBy("members", "size", "digest", "digest_2")
    lowest = same.agg(F.min(F.struct("band", "hash")).alias("at"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_TEXTS), F.ceil(F.col("size") / BLOCK_GRAMS)).cast("int")
    return banded.select("band", "hash", "set_id"), lowest.select("at.band", "at.hash", blocks.alias("blocks"))


def _sets(docs: DataFrame, needed: DataFrame, key: str, config: JoinConfig) -> DataFrame:
    """N-gram sets of the texts that represent the ``needed`` classes, each with its buckets."""
    named = needed.select(
        F.col("first.row_key").alias("row_key"), F.col("first.text_hash").alias("text_hash"),
        "set_id", "copies", "bands", "buckets",
    )
    rows = docs.select(F.col(key).alias("doc_key"), F.xxhash64("text").alias("doc_hash"), "text")
    met = rows.join(named, F.expr("doc_key <=> row_key AND doc_hash = text_hash"))
    columns = ["set_id", "copies", "bands", "buckets"]
    fields = "set_id binary, copies bigint, bands array<bigint>, buckets array<struct<band:int,hash:bigint,blocks:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows may be repeated; a task sends each of its classes once
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                take, found = [], []
                for at, (text, set_id) in enumerate(zip(texts(batch), batch.column("set_id").to_pylist())):
                    if set_id in seen:
                        continue
                    values = grams(text, config.size).tobytes()
                    if xxhash.xxh128_digest(values) == set_id:
                        seen.add(set_id)
                        take.append(at)
                        found.append(values)
                chosen = batch.select(columns).take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays([*chosen.columns, pa.array(found, pa.binary())], [*columns, "grams"])

    return map_batches(met.select("text", *columns), run, f"{fields}, grams binary")


def _links(left: list, right: list | None, band: int, limit: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks (or of one block with itself) that are linked and meet here first.

    Intersections are counted by multiplying 0/1 matrices over the n-grams that two texts share.
    A pair belongs to its lowest common band; in later ones it is left out. That is decided band by
    band on the matrix of links, of one byte per pair: in a block of near copies all pairs are linked.
    """
    both = left if right is None else left + right
    sets = [np.frombuffer(row["grams"], np.uint64) for row in both]
    sizes = np.array([len(x) for x in sets])
    rows = np.repeat(np.arange(len(both)), sizes)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    rows, at = rows[shared], at[shared]
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    cut = len(left)
    common = np.zeros((cut, len(both) - cut if right is not None else cut), np.float32)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, MATRIX_GRAMS):
        low, high = np.searchsorted(at, (start, start + MATRIX_GRAMS))
        part = np.zeros((len(both), MATRIX_GRAMS), np.float32)
        part[rows[low:high], at[low:high] - start] = 1
        common += part[:cut] @ (part[cut:] if right is not None else part).T
    a, b = sizes[:cut], sizes[cut:] if right is not None else sizes
    top, bottom = limit.numerator, limit.denominator
    linked = common * (top + bottom) >= top * (a[:, None] + b[None, :])
    linked = np.triu(linked, 1) if right is None else linked
    bands = np.array([row["bands"][:band] for row in both], np.int64).reshape(len(both), band)
    _, ids = np.unique(np.array([row["set_id"] for row in both], object), return_inverse=True)
    for column in [ids, *bands.T]:
        linked &= column[:cut, None] != (column[cut:] if right is not None else column)[None, :]
    i, j = np.nonzero(linked)
    return i, j if right is None else j + cut


def _verify(group: list[dict], limit: Fraction) -> list[tuple[bytes, int, bytes]]:
    """(set_id, documents it is linked to, root of its links) for one pair of blocks."""
    band, one, other = group[0]["band"], group[0]["one"], group[0]["other"]
    unique = list({row["set_id"]: row for row in group}.values())
    if one == other:
        rows, right = unique, None
    else:
        left = [row for row in unique if row["block"] == one]
        right = [row for row in unique if row["block"] == other]
        if not left or not right:
            return []
        rows = left + right
    i, j = _links(rows if right is None else left, right, band, limit)
    copies = np.array([row["copies"] for row in rows])
    links = np.zeros(len(rows), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = np.arange(len(rows))
    while True:  # every text takes the lowest root among its links until none changes
        lower = root.copy()
        np.minimum.at(lower, i, root[j])
        np.minimum.at(lower, j, root[i])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    linked = np.flatnonzero(links)
    return [(rows[k]["set_id"], int(links[k]), rows[root[k]]["set_id"]) for k in linked]


def _compare(pieces: DataFrame, config: JoinConfig) -> DataFrame:
    """``set_id``, ``links`` and ``root`` from every pair of blocks; a group is one pair of blocks."""
    limit = Fraction(config.threshold).limit_denominator(1000)
    names = ["band", "hash", "one", "other"]

    def out(group: list[dict]) -> pa.RecordBatch:
        columns = list(zip(*_verify(group, limit))) or [(), (), ()]
        types = (pa.binary(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["set_id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = [], None
        for batch in batches:
            for row in (row for start in range(0, batch.num_rows, 256) for row in batch.slice(start, 256).to_pylist()):
                key = tuple(row[name] for name in names)
                if key != at and group:
                    yield out(group)
                    group = []
                at = key
                group.append(row)
        if group:
            yield out(group)

    dealt = pieces.repartition(*names).sortWithinPartitions(*names)
    return map_batches(dealt, run, "set_id binary, links bigint, root binary")


def similarity_classes(docs: DataFrame, key: str = "doc_id", config: JoinConfig = JoinConfig()) -> DataFrame:
    """``key``, ``text_hash``, ``class_id``, ``n_links`` and ``first`` for every row of ``docs``.

    Two texts are linked when the Jaccard index of their n-gram sets reaches the threshold.
    ``n_links`` is the number of other rows a row is linked to, equal texts included;
    ``class_id`` is the lowest key among all rows connected by links; ``first`` is the row
    (lowest key, then text hash) that stands for the class. Texts with equal sets are joined by
    a digest and compared once. Buckets are cut into blocks of bounded size and compared block
    by block, so neither a bucket nor its pairs are ever gathered; every pair is found in its
    lowest common band and verified on the full sets, and nothing is capped.

    Nulls: a null text is an empty text, a null key sorts first and stays null. Texts of fewer
    words than an n-gram, or of none, match equal word sequences (or equal texts). Repeated rows
    come back as often as they are there. Only ``key`` and ``text`` are read.
    """
    rows = materialize(signatures(docs, key, config))
    first = F.min(F.struct(F.col(key).alias("row_key"), "text_hash")).alias("first")
    classes = materialize(
        rows.groupBy("set_id", "n_grams", "bands").agg(F.count(F.lit(1)).alias("copies"), first)
    )
    banded, buckets = _buckets(classes)
    members = banded.join(buckets, ["band", "hash"]).groupBy("set_id")
    bucket_list = members.agg(F.collect_list(F.struct("band", "hash", "blocks")).alias("buckets"))
    needed = classes.join(bucket_list, "set_id")
    sets = _sets(docs, needed, key, config).withColumn("bucket", F.explode("buckets")).drop("buckets")
    block = F.pmod(F.xxhash64("set_id", "bucket.band"), F.col("bucket.blocks")).cast("int")
    met = F.sequence(F.lit(0), F.col("bucket.blocks") - 1)
    pieces = sets.withColumn("block", block).withColumn("with", F.explode(met)).select(
        "bucket.band", "bucket.hash", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
        "block", "set_id", "copies", "bands", "grams",
    )
    found = materialize(_compare(pieces, config))
    labels = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    known = classes.select("set_id", "copies", "first").join(links, "set_id", "left")
    known = known.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    known = known.withColumn("label", F.coalesce("label", "set_id"))
    known = materialize(known)
    heads = materialize(known.groupBy("label").agg(F.min("first").alias("head")))  # so that a hot label can be split
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    judged = known.join(heads, "label").select(
        "set_id", F.col("head.row_key").alias("class_id"), n_links, F.col("head").alias("first")
    )
    return rows.select(key, "text_hash", "set_id").join(judged, "set_id").drop("set_id")


def keep_one(docs: DataFrame, key: str = "doc_id", config: JoinConfig = JoinConfig()) -> DataFrame:
    """The rows of ``docs`` that stand for their class: one of each group stays, whole.

    Of repeated rows of the same key and text, one stays too.
    """
    judged = similarity_classes(docs, key, config)
    times = judged.where(F.expr(f"`{key}` <=> first.row_key AND text_hash = first.text_hash"))
    kept = times.groupBy("first").agg(F.count(F.lit(1)).alias("times"))
    kept = materialize(kept.select("first.row_key", F.col("first.text_hash").alias("kept_hash"), "times"))
    packed = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col(key).alias("doc_key"), F.xxhash64("text").alias("doc_hash"),
    )
    chosen = packed.join(kept, F.expr("doc_key <=> row_key AND doc_hash = kept_hash"))
    fields = [F.col("row").getField(name).alias(name) for name in docs.columns]
    result = chosen.where("times = 1").select(*fields)
    if kept.where("times > 1").isEmpty():
        return result
    return result.union(chosen.where("times > 1").dropDuplicates(["doc_key", "doc_hash"]).select(*fields))
