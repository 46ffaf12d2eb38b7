"""I-Match fingerprints over randomised lexicon subsets, in DataFrame operations only."""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starwise.runtime import materialize

WEIGHT = 10**8  # of a text without copies


@dataclass(frozen=True)
class ImatchConfig:
    """Terms in ``least`` to ``most`` of all texts are in the band of inverse document frequency.

    As a term in the band is in ``least`` of the texts or more, the lexicon has at most (mean
    distinct terms of a text) / ``least`` terms, however many texts there are. ``draws`` random
    subsets are made for each of ``levels`` rates 1/4, 1/32, 1/256, ...: a subset of few terms
    survives a large change of the text, one of many terms tells small changes.

    Copies and near copies of one text count as one text there: each text has ``sketches``
    sketches, the ``sketch_size`` lowest of its word pairs in as many orders, and one that shares
    a sketch with more than ``group_share`` of the texts weighs one over their number. A smaller
    group cannot move a term by more than that share, and there are at most
    ``sketches`` / ``group_share`` larger ones.
    """

    least: float = 0.001
    most: float = 0.125
    sketches: int = 4
    sketch_size: int = 5
    group_share: float = 0.0001
    draws: int = 16
    levels: int = 4
    broadcast_terms: int = 4_000_000
    rows_per_part: int = 512
    broadcast_parts: int = 1_000_000
    ranges: int = 1_000

    @property
    def subsets(self) -> list[tuple[int, int]]:
        return [(draw, level) for draw in range(self.draws) for level in range(1, self.levels + 1)]


def _hashes(text: Column) -> Column:
    """64-bit hashes of a text's terms (runs of letters and digits, lower-cased) as they follow."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda t: t != ""), lambda t: F.xxhash64(t))


def terms(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's terms."""
    return F.array_distinct(_hashes(text))


def sketched(docs: DataFrame, config: ImatchConfig) -> DataFrame:
    """``terms`` and ``sketch_0``, ``sketch_1``, ... of every row; near copies share most sketches."""
    rows = docs.select(_hashes(F.col("text")).alias("hashes"))
    following = F.slice("hashes", F.lit(2), F.greatest(F.size("hashes"), F.lit(1)))
    pairs = F.zip_with("hashes", following, lambda a, b: F.xxhash64(a, b))
    rows = rows.select(F.array_distinct("hashes").alias("terms"), F.array_distinct(pairs).alias("pairs"))
    masks = random.Random(4)

    def sketch() -> Column:
        mask = masks.getrandbits(64) - 2**63
        return F.xxhash64(F.slice(F.sort_array(F.transform("pairs", lambda p: p.bitwiseXOR(F.lit(mask)))), 1, config.sketch_size))

    return rows.select("terms", *(sketch().alias(f"sketch_{n}") for n in range(config.sketches)))


def lexicon(docs: DataFrame, config: ImatchConfig = ImatchConfig()) -> DataFrame:
    """(``term``): the hashes of the terms in the band, counted over all texts, groups of copies once."""
    rows, names = sketched(docs, config), [f"sketch_{n}" for n in range(config.sketches)]
    least = max(1, config.group_share * docs.count())
    each = rows.select(F.posexplode(F.array(*names)).alias("order", "sketch"))
    groups = each.groupBy("order", "sketch").agg(F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups.where(F.col("copies") > least))
    for n, name in enumerate(names):
        known = groups.where(F.col("order") == n).select(F.col("sketch").alias(name), F.col("copies").alias(f"copies_{n}"))
        rows = rows.join(F.broadcast(known), name, "left")  # at most 1 / group_share rows
    copies = F.greatest(F.lit(1), *(F.col(f"copies_{n}") for n in range(config.sketches)))
    # whole numbers, so that sums do not depend on the order; the null term counts the texts
    weight = F.ceil(F.lit(WEIGHT) / copies).alias("weight")
    met = F.explode(F.concat("terms", F.array(F.lit(None).cast("bigint")))).alias("term")
    n = F.round(F.sum("weight") / WEIGHT, 3).alias("n")
    counted = rows.select(weight, met).groupBy("term").agg(n)
    counted = materialize(counted.where("n >= 2 OR term IS NULL"))
    found = counted.where("term IS NULL").first()
    total = found.n if found else 0
    low, high = max(2, config.least * total), config.most * total
    return counted.where((F.col("n") >= low) & (F.col("n") <= max(high, 2)) & F.col("term").isNotNull()).select("term")


def _search(bounds: list, low: int, high: int, value: Column) -> Column:
    """Number of ``bounds`` below ``value``, by a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value > F.lit(bounds[middle]), _search(bounds, middle + 1, high, value)).otherwise(
        _search(bounds, low, middle, value)
    )


def in_order(docs: DataFrame, config: ImatchConfig) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with ``part``, ``at`` and ``text_hash``.

    Rows ordered by part, ``at`` and hash stand in descending ``doc_id``, null ids last. Parts are
    quantile ranges of the id, each cut into equal widths, of about ``rows_per_part`` rows.
    """
    at = F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    rows = docs.select("doc_id", "text", at.alias("at"), F.xxhash64("text").alias("text_hash"))
    total = docs.count()
    ranges = max(1, min(config.ranges, -(-total // config.rows_per_part)))
    cuts = F.percentile_approx("at", [n / ranges for n in range(1, ranges)] or [0.5], 20 * ranges)
    found = rows.agg(F.min("at").alias("low"), F.max("at").alias("high"), cuts.alias("cuts")).first()
    bounds = sorted(set(found.cuts or [])) if ranges > 1 else []
    top = _search(bounds, 0, len(bounds), F.col("at"))
    width = max(1, -(-total // (config.rows_per_part * (len(bounds) + 1))))
    if width == 1:
        return rows.withColumn("part", top.cast("bigint"))
    edges = [found.low, *bounds, found.high]
    spans = F.array(*(F.lit(edges[n + 1] - edges[n] + 1) for n in range(len(edges) - 1)))
    begins = F.array(*(F.lit(edge) for edge in edges[:-1]))
    rows = rows.withColumn("top", top)
    within = (F.col("at") - F.element_at(begins, F.col("top") + 1)) * width / F.element_at(spans, F.col("top") + 1)
    return rows.withColumn("part", (F.col("top") * (width + 1) + F.floor(within)).cast("bigint")).drop("top")


def _digest(name: str, config: ImatchConfig) -> list[Column]:
    """Xor of the hashes of the terms in each subset; a term's subsets follow from its hash.

    The xor is the same for any order of the terms, so it stands for the sorted list of distinct
    terms, and partial results combine.
    """
    per_lot = 64 // (3 * config.levels)
    out = []
    for draw, level in config.subsets:
        lot = F.shiftright(F.xxhash64(name, F.lit(10 + draw // per_lot)), 3 * config.levels * (draw % per_lot))
        inside = lot.bitwiseAND(F.lit(8**level // 2 - 1)) == 0
        out.append(F.bit_xor(F.when(inside, F.xxhash64(name, F.lit(1)))).alias(f"x{draw}_{level}"))
    return out


def _fingerprint(config: ImatchConfig) -> Column:
    """Hashes of all subsets, ``-`` for a subset without terms; a digest of the text if all are."""
    names = [f"x{draw}_{level}" for draw, level in config.subsets]
    one = [F.coalesce(F.lpad(F.lower(F.hex(F.shiftrightunsigned(F.col(x), 32))), 8, "0"), F.lit("-")) for x in names]
    none = F.coalesce(*names).isNull()
    return F.when(none, F.concat(F.lit("text:"), F.lower(F.hex("text_md5")))).otherwise(F.concat_ws(".", *one))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that have terms in either text, 0 to 1."""
    pairs = F.arrays_zip(F.split(a, r"\.").alias("l"), F.split(b, r"\.").alias("r"))
    used = F.filter(pairs, lambda p: (p["l"] != "-") | (p["r"] != "-"))
    same = F.size(F.filter(used, lambda p: p["l"] == p["r"])) / F.size(used)
    whole = a.startswith("text:") | b.startswith("text:")
    return F.when(whole, F.when(a == b, 1.0).otherwise(0.0)).otherwise(same)


def fingerprints(texts: DataFrame, keys: list[str], config: ImatchConfig, words: DataFrame) -> DataFrame:
    """``keys`` and ``fingerprint`` of rows with ``keys``, ``terms`` and ``text_md5``."""
    size = words.count()
    known = words.select(F.col("term").alias("known"))
    if size <= config.broadcast_terms:
        known = F.broadcast(known)
    rows = texts.select(*keys, "text_md5", F.explode_outer("terms").alias("term"))
    met = rows.join(known, F.col("term") == F.col("known"), "left")
    return met.groupBy(*keys, "text_md5").agg(*_digest("known", config)).select(*keys, _fingerprint(config).alias("fingerprint"))


def fingerprint_documents(docs: DataFrame, config: ImatchConfig = ImatchConfig()) -> DataFrame:
    """``doc_id`` and ``fingerprint`` per row; equal texts get equal fingerprints. Null is empty."""
    words = lexicon(docs, config)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), terms(F.col("text")).alias("terms"), F.unhex(F.md5(text)).alias("text_md5"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return fingerprints(rows, ["doc_id", "text_hash", "row"], config, words).select("doc_id", "fingerprint")


def compare_edited(docs: DataFrame, config: ImatchConfig = ImatchConfig()) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has the last half of the code points replaced by the first as many of the next
    document in descending ``doc_id`` (after the last, the first). Texts are shuffled once, by
    ranges of the id; the neighbour is read there. Equal ids are ordered by a hash of the text.
    Nulls: a null text is empty, null ids stand last. An empty table gives no rows. Only ``doc_id``
    and ``text`` are read.
    """
    words = lexicon(docs, config)
    ordered = in_order(docs.select("doc_id", "text"), config)
    names = ["at", "text_hash"]
    here = Window.partitionBy("part").orderBy(*names)
    parts = ordered.groupBy("part").agg(F.min(F.struct(*names)).alias("first"))
    # one row per part: a few thousandths of the documents
    following = F.lead("first").over(Window.orderBy("part"))
    lowest = F.first("first").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ring = materialize(parts.select("part", F.coalesce(following, lowest).alias("first")))
    firsts = ring.select(F.col("part").alias("of_part"), "first.*")
    if ring.count() <= config.broadcast_parts:  # else the texts are shuffled once more
        firsts = F.broadcast(firsts)
    text = F.coalesce("text", F.lit(""))
    heads = ordered.select(*names, text.alias("head_text")).join(firsts, names)
    heads = heads.groupBy("of_part").agg(F.min("head_text").alias("head_text"))
    rows = ordered.withColumn("text", text).withColumn("copy", F.row_number().over(here))
    rows = rows.withColumn("next_text", F.lead("text").over(here))
    rows = rows.join(heads, rows.part == heads.of_part, "left").drop("of_part")
    rows = rows.withColumn("next_text", F.coalesce("next_text", "head_text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("left(text, int(n_chars - floor(n_chars / 2)))"), F.left("next_text", half))
    rows = rows.withColumn("edited", edited)
    keys = ["part", "at", "text_hash", "copy", "doc_id", "n_chars", "edited_sha", "edited_text"]
    versions = F.array(
        *(
            F.struct(
                F.lit(name == "edited").alias("edited_text"),
                terms(F.col(name)).alias("terms"),
                F.unhex(F.md5(name)).alias("text_md5"),
            )
            for name in ("text", "edited")
        )
    )
    both = rows.select(*keys[:6], F.unhex(F.sha2("edited", 256)).alias("edited_sha"), F.explode(versions).alias("v"))
    both = both.select(*keys[:7], "v.edited_text", "v.terms", "v.text_md5")
    marked = fingerprints(both, keys, config, words)
    own = F.max(F.when(~F.col("edited_text"), F.col("fingerprint"))).alias("fingerprint")
    changed = F.max(F.when(F.col("edited_text"), F.col("fingerprint"))).alias("edited_fingerprint")
    result = materialize(marked.groupBy(*keys[:7]).agg(own, changed))
    order = Window.partitionBy("part").orderBy(*names, "copy")
    starts = result.where("copy = 1").select(*names, F.col("fingerprint").alias("head_fingerprint"))
    after = starts.join(firsts, names)
    after = after.groupBy("of_part").agg(F.min("head_fingerprint").alias("head_fingerprint"))
    result = result.withColumn("next", F.lead("fingerprint").over(order))
    result = result.join(after, result.part == after.of_part, "left")
    following = F.coalesce("next", "head_fingerprint")
    return result.select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), following).alias("near_next"),
    )
