"""What each filter of a chain removes, in every order: min-plus products of masks and positions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from starwise.llm.text import map_batches

PASSES = 1 << 20  # cost of a filter that a document passes: later than any step


# What words are separated by, the marks and the capitals that are looked for.
SEPARATORS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that a text alone decides, by letter: true where it fails; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, SEPARATORS), "")
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)).cast("bigint") * 100 < F.size(words).cast("bigint") * 65,
        "C": capitals.cast("bigint") * 100 > chars.cast("bigint") * 5,
        "D": text.rlike(MARKS),
    }


def mask_counts(
    docs: DataFrame, failures: dict[str, Column], marks: DataFrame, names: Sequence[str],
    part: str = "source", key: str = "doc_id",
) -> DataFrame:
    """(part, mask, documents, *names): documents per part and set of failed filters, and their marks.

    Bit ``k`` of ``mask`` is the ``k``-th of ``failures``, the next bit the copies filter: an equal
    text under a smaller key in any part, removed or not. ``marks`` has boolean columns ``names``
    per key, each of which is counted on its own (several rows of a key: true if any is).

    A text is known by its SHA-256. Rows that agree in all that matters are counted before each
    shuffle, so a text or key with a third of all rows is a few rows per task; of every such group the
    lowest key and its rows are kept, and the rest are copies. Texts themselves are never shuffled.
    A null part is empty, a null text is the empty text; a row with a null key is neither smaller
    nor larger than others, so it is no copy and makes none, and has no marks. Rows of one key and
    text are all first or all copies. An empty table gives no rows. Columns other than those named
    here are not read, whatever they are called.
    """
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(failures.values())]
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    single = rows.groupBy("key", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    # null keys find no marks; the second column keeps them from meeting in one task
    spread = F.when(F.col("key").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(0)
    marked = marks.groupBy(F.col(key).alias("key")).agg(*[F.max(name).alias(f"mark_{name}") for name in names])
    known = single.withColumn("spread", spread).join(marked.withColumn("spread", F.lit(0).cast("bigint")), ["key", "spread"], "left")
    has = [F.coalesce(f"mark_{name}", F.lit(False)).alias(f"mark_{name}") for name in names]
    flags = [f"mark_{name}" for name in names]
    groups = (
        known.select("key", "part", "mask", "digest", "n", *has, F.col("key").isNotNull().alias("keyed"))
        .groupBy("digest", "part", "mask", *flags, "keyed")
        .agg(F.sum("n").alias("n"), F.min(F.struct("key", "n")).alias("head"))
    )
    lowest = F.min(F.when(F.col("keyed"), F.col("head.key"))).over(Window.partitionBy("digest"))
    first = F.when(~F.col("keyed"), F.col("n")).when(F.col("head.key") == lowest, F.col("head.n")).otherwise(0)
    copies = 1 << len(failures)
    split = F.array(
        F.struct("mask", first.alias("n")), F.struct((F.col("mask") + copies).alias("mask"), (F.col("n") - first).alias("n"))
    )
    rows = groups.select("part", *flags, split.alias("split")).select("part", *flags, F.inline("split"))
    counted = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("documents"), *[F.sum(F.when(F.col(f"mark_{name}"), F.col("n")).otherwise(0)).alias(name) for name in names]
    )
    return counted


def orders_of(letters: str) -> np.ndarray:
    """All orders of the filters, one row of filter numbers each."""
    return np.array(list(permutations(range(len(letters)))), np.int64).reshape(-1, len(letters))


def positions_of(orders: np.ndarray) -> np.ndarray:
    """The inverse permutations: the step (from 1) at which an order applies each filter."""
    found = np.empty_like(orders)
    np.put_along_axis(found, orders, np.arange(1, orders.shape[1] + 1)[None, :], 1)
    return found


def removal_steps(fails: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product of masks (documents x filters) and positions (orders x filters).

    A failed filter costs nothing and a passed one more than any step, so the lowest sum of cost and
    position is the step that removes the document in that order; one step too many if none does.
    """
    cost = np.where(fails, 0, PASSES)
    steps = np.full((len(fails), len(positions)), PASSES, np.int64)
    for k in range(fails.shape[1]):
        np.minimum(steps, cost[:, k, None] + positions[None, :, k], out=steps)
    return np.minimum(steps, fails.shape[1] + 1)


def tally(weights: np.ndarray, letters: str) -> dict[str, np.ndarray]:
    """Counts per part, order and step from ``weights`` (parts x masks x kinds of weight).

    The first weight counts documents, the others marks. All masks are removed by the same
    min-plus product; its steps say where each mask's weights are added.
    """
    parts, masks, kinds = weights.shape
    orders = orders_of(letters)
    positions = positions_of(orders)
    fails = (np.arange(masks)[:, None] >> np.arange(len(letters)) & 1).astype(bool)
    steps = removal_steps(fails, positions)
    each = np.arange(len(orders))
    removed = np.zeros((parts, len(orders), len(letters) + 2, kinds), np.int64)
    for mask in range(masks):  # an order is met once per mask, so nothing is added twice in one go
        removed[:, each, steps[mask]] += weights[:, mask, None]
    removed = removed[:, :, 1 : len(letters) + 1]
    failing = np.einsum("pmk,mf->pfk", weights, fails.astype(np.int64))[:, :, 0]
    alone = weights[:, 1 << np.arange(len(letters)), 0]
    total = weights[:, :, 0].sum(1)
    here = removed[..., 0]
    by_filter = np.take_along_axis(here, (positions - 1)[None], 2)  # parts x orders x filters
    shapley = by_filter.sum(1)
    at = (slice(None), orders)
    out = {
        "kept": total[:, None, None] - here.cumsum(2),
        "removed": here,
        "redundant": failing[at] - here,
        "unique_fails": alone[at],
        "shapley": shapley[at],
    }
    return out | {f"lost_{k}": removed[..., k] for k in range(1, kinds)}


def audit(counts: DataFrame, letters: str, names: Sequence[str] = ()) -> DataFrame:
    """One row per part, order of the filters and step, from the counts per part and mask.

    kept after the step, removed by it, redundant (failing its filter but removed before),
    unique_fails (failing its filter only), ``<name>_lost`` (removed here with that mark), and
    shapley (removed by the step's filter, summed over all orders). A part has at most one row per
    mask, so all of a part is a bounded row; parts are spread over the tasks. Orders grow as the
    factorial of the number of filters, so at most seven are taken.
    """
    if not 0 < len(letters) <= 7:
        raise ValueError("one to seven filters")
    kinds = ["documents", *names]
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *kinds)).alias("masks"))
    told = ["".join(letters[k] for k in order) for order in orders_of(letters).tolist()]
    size, masks = len(letters), 1 << len(letters)
    lost = [f"{name}_lost" for name in names]
    columns = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    schema = StructType(
        [*StructType.fromDDL("part string, filter_order string, step int").fields, *[StructField(c, LongType()) for c in columns]]
    )
    slice_rows = 16

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, slice_rows):
                batch = whole.slice(start, slice_rows)
                weights = np.zeros((batch.num_rows, masks, len(kinds)), np.int64)
                for n, entries in enumerate(batch.column("masks").to_pylist()):
                    for entry in entries:
                        weights[n, entry["mask"]] = [entry[kind] for kind in kinds]
                found = tally(weights, letters)
                found |= {name: found[f"lost_{k}"] for k, name in enumerate(lost, 1)}
                rows = len(told) * size
                part = batch.column("part").take(pa.array(np.repeat(np.arange(batch.num_rows), rows)))
                order = pa.array(told).take(pa.array(np.tile(np.repeat(np.arange(len(told)), size), batch.num_rows)))
                step = pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), batch.num_rows * len(told)))
                yield pa.RecordBatch.from_arrays(
                    [part, order, step, *[pa.array(found[c].reshape(-1)) for c in columns]], schema.names
                )

    return map_batches(per_part, work, schema)
