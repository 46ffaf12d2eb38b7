"""Co-rated item pairs, their moments and the shrunken, mean-centred Pearson similarity."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starwise.config import Config
from starwise.operators.prefix import block_starts
from starwise.operators.stats import RatingFacts, active_users, without_heavy_users
from starwise.runtime import written
from starwise.skew import hot_keys, lookup, split_fact

BAND_BITS = 62  # of a BIGINT


def _parts(users: DataFrame, facts: RatingFacts) -> tuple[DataFrame, int]:
    """(user, part) of the active among ``users``, and the number of partitions for the parts.

    ``users`` has user, n and place; users alike have the same place, and a place is a part, so that
    a pair of items is summed up in few tasks whatever their number. A place with more than
    ``part_pairs`` pairs of items (or a share of them, if there are fewer than partitions need) is
    cut by user: the pairs that a task sums up do not grow with the ratings.
    """
    active = users.join(active_users(facts.by_user, facts.config).select("user"), "user").where("n > 1")
    placed = written(active.select("user", "place", F.expr("n * (n - 1) div 2").alias("n")))
    by_place = placed.groupBy("place").agg(F.sum("n").alias("n"))
    total = by_place.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    skew, least = facts.config.skew, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(least, -(-total // skew.part_pairs))
    hot = hot_keys(by_place, ["place"], total, replace(skew, min_rows=max(1, total // count)))
    cut = placed.withColumn("salt", F.lit(0)) if hot is None else split_fact(placed, hot, ["place"], ["user"])
    return cut.select("user", F.xxhash64("place", "salt").alias("part")), count


def _pairs(lists: DataFrame, *kept: str) -> DataFrame:
    """(x, y) and the kept columns: every two entries of the sorted list ``g``, in their order.

    A user here has fewer than 500 ratings, so a list of theirs is bounded; pairs leave it by two
    generators, in compiled code.
    """
    first = lists.where("size(g) > 1").select(*kept, "g", F.posexplode("g").alias("n", "x"))
    return first.select(*kept, "x", F.expr("explode(slice(g, n + 2, size(g)))").alias("y"))


def _item_groups(facts: RatingFacts, groups: int) -> DataFrame:
    """(item, group): the items in order, cut into about ``groups`` runs with as many ratings each.

    An item with more ratings than a run should have gets a number below 0 of its own. The ratings of
    the items before are added up within ranges of items, and the ranges' sums in levels.
    """
    share = max(1.0, facts.n_ratings / groups)
    items = facts.by_item.where("item IS NOT NULL").orderBy("item")
    ranged = written(items.select("item", "n", F.spark_partition_id().alias("range")))
    ranges = ranged.agg(F.coalesce(F.max("range"), F.lit(-1))).first()[0] + 1
    starts = block_starts(ranged.groupBy("range").agg(F.sum("n").alias("size")), ranges, "range", "size")
    before = F.sum("n").over(Window.partitionBy("range").orderBy("item").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.select("item", "n", "range", F.coalesce(before, F.lit(0)).alias("before")).join(starts, "range")
    number = F.floor((F.col("start") + F.col("before")) / share).cast("int")
    return written(placed.select("item", F.when(F.col("n") > share, -1 - number).otherwise(number).alias("group")))


def _runs(lists: DataFrame) -> DataFrame:
    """(group, width, items): the items of a list from the first of a group on; ``width`` of them are the group's.

    ``lists`` has a sorted list ``g`` of (group, item) per user, so the items of a group are neighbours.
    """
    split = lists.where("size(g) > 1").selectExpr("g.group AS groups", "g.item AS items")
    starts = F.expr("filter(sequence(0, size(groups) - 1), p -> p = 0 OR groups[p] <> groups[p - 1])").alias("starts")
    first = split.select("*", starts).select("*", F.posexplode("starts").alias("n", "first"))
    return first.selectExpr(
        "groups[first] AS group",
        "coalesce(get(starts, n + 1), size(groups)) - first AS width",
        "slice(items, first + 1, size(items)) AS items",
    ).where("size(items) > 1")


def corated_pairs(facts: RatingFacts) -> DataFrame:
    """(i, j, n): how many active users rated both items.

    A pair belongs to the group of the one of its items that comes first, and users' lists are sent
    to the groups they have items of: once per group, from the first item of it on. There the pairs
    are opened and counted where they are, so that no pair is shuffled. There are so many groups that
    one has about ``part_pairs`` pairs, met by all users together. Pairs that begin with an item too
    frequent for a group are counted by pair, before and after a shuffle.
    """
    active = active_users(facts.by_user, facts.config)
    session, pairs = active.sparkSession, F.expr("coalesce(sum(n * (n - 1) div 2), 0)")
    wanted = -(-active.agg(pairs).first()[0] // facts.config.skew.part_pairs)
    groups = max(2 * session.sparkContext.defaultParallelism, wanted)
    grouped = _item_groups(facts, groups)
    rated = without_heavy_users(facts).where("item IS NOT NULL").select("user", "item")
    marked = lookup(rated, grouped, "item", facts.hot_items, ["user"], how="inner").join(active.select("user"), "user")
    runs = _runs(marked.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("group", "item"))).alias("g")))

    def counted(found: DataFrame, *keys: str) -> DataFrame:
        first = found.select(*keys, "items", F.expr("posexplode(slice(items, 1, width)) AS (n, x)"))
        met = first.select(*keys, "x", F.expr("explode(slice(items, n + 2, size(items))) AS y")).where("x <> y")
        ordered = met.select(*keys, F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"))
        return ordered.groupBy(*keys, "i", "j").agg(F.count(F.lit(1)).alias("n")).select("i", "j", "n")

    count = max(groups, int(session.conf.get("spark.sql.shuffle.partitions")))
    together = counted(runs.where("group >= 0").repartition(count, "group"), "group")
    if grouped.where("group < 0").isEmpty():
        return together
    return together.unionAll(counted(runs.where("group < 0")))


def _met_pairs(facts: RatingFacts, buckets: DataFrame) -> DataFrame:
    """One row per active user, band and pair of items of theirs that share the band's bucket.

    Columns: band, i, j, stars_i, stars_j, avg_i, avg_j. An item's card holds its mean and all its
    buckets (at most one per band), so a rating stays one row up to the shuffle by part; items
    without a bucket drop out in that join. Buckets are opened where the user's rows are. The lowest
    code among the buckets of their items is a user's place.
    """
    coded = buckets.select("item", F.struct("band", F.xxhash64("band", "bucket").alias("code")).alias("code"))
    codes = written(coded.groupBy("item").agg(F.collect_list("code").alias("codes")))
    rated, hot = without_heavy_users(facts), facts.hot_items
    lowest = codes.select("item", F.expr("array_min(codes.code)").alias("lowest"))
    marked = lookup(rated.select("user", "item"), lowest, "item", hot, ["user"], how="inner")
    users = marked.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.min("lowest").alias("place"))
    parts, count = _parts(users, facts)
    card = facts.by_item.select("item", F.col("avg_stars").alias("avg")).join(codes, "item")
    carded = lookup(rated.join(parts, "user"), card, "item", hot, ["user"], how="inner")
    dealt = carded.repartition(count, "part")
    opened = dealt.select("part", "user", F.struct("item", "stars", "avg").alias("rated"), F.inline("codes"))
    lists = opened.groupBy("part", "user", "band", "code").agg(F.array_sort(F.collect_list("rated")).alias("g"))
    met = _pairs(lists, "band")
    names = {"item": "", "stars": "stars_", "avg": "avg_"}
    values = [F.col(f"{row}.{name}").alias(f"{to}{side}") for name, to in names.items() for row, side in ("xi", "yj")]
    return met.select("band", *values)


def candidate_pairs(facts: RatingFacts, buckets: DataFrame) -> DataFrame:
    """Pairs of items that share a bucket and at least one active co-rater.

    The active co-rater is part of the definition: without one a pair never gets a similarity.
    So pairs are found at the users, whose histories are bounded, instead of pairing up the
    members of a bucket, which may be a third of all items.
    """
    return _met_pairs(facts, buckets).select("i", "j").distinct()


def pair_moments(facts: RatingFacts, buckets: DataFrame) -> DataFrame:
    """Co-rater count and sums per pair, plus both item means carried along from the ratings.

    Two items meet at every co-rater in every band they share. Which bands those are is the same
    for all their co-raters, so the sums over all meetings are the wanted ones times the number of
    shared bands; that number comes out of the same sums, as the bits set over all meetings.
    """
    ri, rj = F.col("stars_i"), F.col("stars_j")
    sums = {"n": F.count(F.lit(1)), "sum_i": F.sum(ri), "sum_j": F.sum(rj)}
    sums |= {"sum_ii": F.sum(ri * ri), "sum_jj": F.sum(rj * rj), "sum_ij": F.sum(ri * rj)}
    words = range(-(-facts.config.lsh.bands // BAND_BITS))
    bits = [F.expr(f"bit_or(if(band div {BAND_BITS} = {w}, shiftleft(1L, band % {BAND_BITS}), 0L))") for w in words]
    met = _met_pairs(facts, buckets).groupBy("i", "j").agg(
        *[total.alias(name) for name, total in sums.items()],
        *[b.alias(f"bits_{w}") for w, b in zip(words, bits)],
        F.max("avg_i").alias("avg_i"),
        F.max("avg_j").alias("avg_j"),
    )
    shared = sum((F.bit_count(f"bits_{w}") for w in words), F.lit(0))
    once = [(F.col(name) / shared).cast("bigint" if name == "n" else "double").alias(name) for name in sums]
    return met.select("i", "j", *once, "avg_i", "avg_j")


def pair_similarity(moments: DataFrame, config: Config) -> DataFrame:
    """(i, j, n, sim) from the moments.

    Ratings are centred on each item's mean over all its raters, not over the co-raters, and the
    result is shrunk by min(n, 60) / 60.
    """
    n, ai, aj = F.col("n"), F.col("avg_i"), F.col("avg_j")
    cross = F.col("sum_ij") - aj * F.col("sum_i") - ai * F.col("sum_j") + n * ai * aj
    var_i = F.col("sum_ii") + n * (ai * ai) - 2 * ai * F.col("sum_i")
    var_j = F.col("sum_jj") + n * (aj * aj) - 2 * aj * F.col("sum_j")
    spread = (var_i > config.variance_floor) & (var_j > config.variance_floor)
    pearson = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cross / (F.sqrt(var_i) * F.sqrt(var_j))))
    shrink = F.least(n, F.lit(config.shrink_at)) / float(config.shrink_at)
    sim = F.when((n >= config.min_co_raters) & spread, pearson * shrink).otherwise(0.0)
    return moments.select("i", "j", "n", sim.alias("sim"))
