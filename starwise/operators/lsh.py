"""MinHash signatures and banded buckets of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwise.config import HASH_PRIME, WORDS, Config
from starwise.functions.scalars import id_words
from starwise.operators.stats import RatingFacts, popular_items
from starwise.skew import hot_keys, lookup, repeat_dim, split_fact


def signature_columns(config: Config) -> list[str]:
    return [f"h{k}" for k in range(config.lsh.rows)]


def _hash_table(config: Config) -> str:
    """The hash parameters as a SQL array with one struct (band, p0_0, p0_1 ... p1_0 ...) per band."""
    table, rows = config.lsh.hash_table(), config.lsh.rows
    bands = []
    for band in range(config.lsh.bands):
        used = table[band * rows : (band + 1) * rows]
        fields = [f"{value}L AS p{k}_{n}" for k, row in enumerate(used) for n, value in enumerate(row)]
        bands.append(f"struct({band} AS band, {', '.join(fields)})")
    return f"array({', '.join(bands)})"


def _hash(k: int) -> Column:
    """62-bit hash of the id words w0, w1 ... by the ``k``-th parameters of a band."""

    def half(first: int) -> Column:
        products = [F.col(f"p.p{k}_{first + n}") * F.col(f"w{n}") for n in range(WORDS)]
        return sum(products, F.col(f"p.p{k}_{first + WORDS}")) % HASH_PRIME

    return half(0) * (1 << 31) + half(WORDS + 1)


def band_signatures(facts: RatingFacts) -> DataFrame:
    """One row per popular item and band, with the band's MinHash values in ``h0``, ``h1`` ...

    The ratings are shuffled once, on the item (a hot item in several pieces). The blow-up by
    band happens after that shuffle and collapses again in the same stage, so what moves next is
    at most one row per item, piece and band.
    """
    config = facts.config
    names = signature_columns(config)
    words = [f"w{n}" for n in range(WORDS)]
    split_user = id_words(F.col("user"), facts.has_integer_users)
    raters = facts.ratings.select("item", *[word.alias(name) for word, name in zip(split_user, words)])
    popular = popular_items(facts.by_item, config).select("item")
    place = ["item"]
    if facts.hot_items is not None:
        place = ["item", "salt"]
        raters = split_fact(raters, facts.hot_items, ["item"], words)
        popular = repeat_dim(popular, facts.hot_items, ["item"])
    # a fixed number of partitions: 100 hashes per row want every core, however few the bytes
    partitions = int(raters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = (
        raters.repartition(partitions, *place)
        .join(popular, place)
        .select(*place, *words, F.expr(f"explode({_hash_table(config)})").alias("p"))
        .select(*place, "p.band", *[_hash(k).alias(name) for k, name in enumerate(names)])
    )
    lowest = [F.min(name).alias(name) for name in names]
    signatures = hashed.groupBy(*place, "band").agg(*lowest)
    return signatures if place == ["item"] else signatures.groupBy("item", "band").agg(*lowest)


def minhash_signatures(signatures: DataFrame, config: Config) -> DataFrame:
    """Long form: (item, hash_ix, h)."""
    rows = config.lsh.rows
    values = F.posexplode(F.array(*signature_columns(config))).alias("k", "h")
    return signatures.select("item", "band", values).select(
        "item", (F.col("band") * rows + F.col("k")).cast("bigint").alias("hash_ix"), "h"
    )


def band_keys(signatures: DataFrame, config: Config) -> DataFrame:
    """Readable bucket keys: (item, band, sig_key)."""
    return signatures.select(
        "item",
        F.col("band").cast("bigint").alias("band"),
        F.concat_ws("-", *signature_columns(config)).alias("sig_key"),
    )


def shared_buckets(signatures: DataFrame, config: Config) -> DataFrame:
    """(item, band, bucket) for the buckets an item shares with other items.

    A bucket is named by its smallest item, so (band, bucket) tells buckets apart. Items alike
    meet in many bands; buckets with the same members are kept once, under their lowest band,
    which leaves a group of copies a single bucket. Same members means the same size, ends and
    two 64-bit checksums. Members are never paired here, whatever the size of a bucket.
    """
    keys = ["band", *signature_columns(config)]
    buckets = signatures.groupBy(*keys).agg(
        F.min("item").alias("bucket"),
        F.max("item").alias("last"),
        F.count("item").alias("n"),
        F.bit_xor(F.xxhash64("item")).alias("check_a"),
        F.bit_xor(F.xxhash64("item", F.lit("b"))).alias("check_b"),
    )
    hot = hot_keys(buckets, keys, signatures.count(), config.skew)
    named = lookup(signatures, buckets.where(F.col("n") > 1), keys, hot, ["item"], how="inner")
    return (
        named.groupBy("item", "bucket", "last", "n", "check_a", "check_b")
        .agg(F.min("band").alias("band"))
        .select("item", "band", "bucket")
    )
