"""A Bloom filter of keys as a small table, to drop rows before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 6
SKETCH_BITS = 26  # 2**20 words of 64 bits: at most as many rows of 16 bytes are broadcast


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("sketch")), F.lit(1 << SKETCH_BITS))


def key_sketch(df: DataFrame, key: str) -> DataFrame:
    """(sketch_word, sketch_bits): the bits that the keys of ``df`` set; one row per word with any.

    There are at most 2**20 words whatever the number of keys, and partial words are combined
    before the shuffle. Null keys set none.
    """
    place = df.where(F.col(key).isNotNull()).select(_place(key).alias("place"))
    bit = F.expr(f"shiftleft(1L, cast(place & {(1 << WORD_BITS) - 1} AS INT))")
    return place.groupBy(F.shiftright("place", WORD_BITS).alias("sketch_word")).agg(F.bit_or(bit).alias("sketch_bits"))


def might_match(df: DataFrame, key: str, sketch: DataFrame) -> DataFrame:
    """``df`` without most of the rows whose key is not in the sketch; no row with such a key is lost.

    Of the other keys about (number of keys) / 2**26 stay. The sketch is broadcast, its size is
    bounded, and nothing of ``df`` is shuffled.
    """
    marked = df.withColumn("sketch_place", _place(key))
    found = marked.join(F.broadcast(sketch), F.shiftright("sketch_place", WORD_BITS) == F.col("sketch_word"))
    bit = F.expr(f"shiftright(sketch_bits, cast(sketch_place & {(1 << WORD_BITS) - 1} AS INT)) & 1L")
    return found.where(bit == 1).drop("sketch_place", "sketch_word", "sketch_bits")
