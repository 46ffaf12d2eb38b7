"""LSH, similarity and neighbours against brute force."""

import math
import random
from collections import defaultdict
from dataclasses import replace
from itertools import combinations

import pytest
from conftest import as_dict, row_set
from data import one_bucket, ratings

from starwise.config import HASH_PRIME, Config, LshConfig, SkewConfig
from starwise.operators import lsh, neighbors, similarity
from starwise.operators.stats import RatingFacts
from starwise.plans import predict

LONG = "user long, item long, stars double"
SMALL = Config(lsh=LshConfig(bands=8, rows=2, min_item_ratings=5))


def brute_signatures(rows, config):
    raters = defaultdict(set)
    for user, item, _ in rows:
        raters[item].add(user)
    def number(user, a0, a1, a2, b, c0, c1, c2, d):
        w0, w1, w2 = user & 0x3FFFFF, (user >> 22) & 0x3FFFFF, (user >> 44) & 0xFFFFF
        high, low = a0 * w0 + a1 * w1 + a2 * w2 + b, c0 * w0 + c1 * w1 + c2 * w2 + d
        return high % HASH_PRIME * 2**31 + low % HASH_PRIME

    return {
        item: [min(number(u, *row) for u in users) for row in config.lsh.hash_table()]
        for item, users in raters.items()
        if len(users) >= config.lsh.min_item_ratings
    }


def brute_candidates(rows, config):
    signatures, r = brute_signatures(rows, config), config.lsh.rows
    return {
        (i, j)
        for i, j in combinations(sorted(signatures), 2)
        if any(
            signatures[i][b * r : b * r + r] == signatures[j][b * r : b * r + r] for b in range(config.lsh.bands)
        )
    }


def brute_moments(rows, config):
    by_user = defaultdict(dict)
    for user, item, stars in rows:
        by_user[user][item] = stars
    found = defaultdict(lambda: [0, 0, 0, 0, 0, 0])
    for rated in by_user.values():
        if config.min_user_ratings <= len(rated) <= config.max_user_ratings:
            for i, j in combinations(sorted(rated), 2):
                a, b = rated[i], rated[j]
                found[i, j] = [x + y for x, y in zip(found[i, j], (1, a, b, a * a, b * b, a * b))]
    return found


@pytest.fixture(scope="module")
def rows():
    return ratings()


@pytest.fixture(scope="module")
def facts(spark, rows):
    return RatingFacts(spark.createDataFrame(rows, LONG), SMALL)


def test_hash_table_is_seeded_and_distinct():
    table = LshConfig().hash_table()
    assert len(set(table)) == 100 and table == LshConfig().hash_table()
    assert table[:99] == LshConfig(bands=33, rows=3).hash_table()
    assert all(len(row) == 8 and all(0 <= value < HASH_PRIME for value in row) for row in table)


def test_wide_ids_are_not_folded(spark):
    rows = [(5, 1), (2**31 + 4, 2), (-5, 3), (2**62 + 5, 4), (2**62 + 6, 5)]
    config = Config(lsh=LshConfig(bands=1, rows=3, min_item_ratings=1))
    facts = RatingFacts(spark.createDataFrame([(u, i, 3.0) for u, i in rows], LONG), config)
    found = {r.item: (r.h0, r.h1, r.h2) for r in lsh.band_signatures(facts).collect()}
    assert len(set(found.values())) == len(rows)
    expected = brute_signatures([(u, i, 3.0) for u, i in rows if u >= 0], config)
    assert all(found[item] == tuple(hashes) for item, hashes in expected.items())


def test_bucket_mates_need_an_active_co_rater(spark):
    rows = [(user, item, 3.0) for user in range(10) for item in range(4)]
    for most, pairs in ((499, 6), (3, 0)):
        facts = RatingFacts(spark.createDataFrame(rows, LONG), replace(SMALL, max_user_ratings=most))
        assert similarity.candidate_pairs(facts, predict.find_buckets(facts)).count() == pairs


def test_pairs_form_where_the_user_rows_lie(facts):
    """Between the shuffle by user and the sums by pair nothing is shuffled again."""
    plan = similarity.pair_moments(facts, predict.find_buckets(facts))._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("(i#" in line and "j#" in line for line in moves) == 1
    assert not any("code#" in line for line in moves)


def test_signatures(facts, rows):
    found = lsh.minhash_signatures(lsh.band_signatures(facts), SMALL).collect()
    expected = {(i, k, h) for i, hs in brute_signatures(rows, SMALL).items() for k, h in enumerate(hs)}
    assert {(r.item, r.hash_ix, r.h) for r in found} == expected and len(found) == len(expected)


@pytest.mark.parametrize("shape", [(8, 2), (20, 1), (70, 2), (4, 4)])
def test_candidates(spark, rows, shape):
    config = replace(SMALL, lsh=LshConfig(bands=shape[0], rows=shape[1], min_item_ratings=5))
    facts = RatingFacts(spark.createDataFrame(rows, LONG), config)
    found = similarity.candidate_pairs(facts, predict.find_buckets(facts)).collect()
    assert {(r.i, r.j) for r in found} == brute_candidates(rows, config)
    assert len(found) == len(brute_candidates(rows, config))


@pytest.mark.parametrize("bands", [8, 70])
def test_moments_do_not_depend_on_shared_buckets(spark, rows, bands):
    config = replace(SMALL, lsh=LshConfig(bands=bands, rows=2, min_item_ratings=5))
    facts = RatingFacts(spark.createDataFrame(rows, LONG), config)
    expected = brute_moments(rows, config)
    names = ("n", "sum_i", "sum_j", "sum_ii", "sum_jj", "sum_ij")
    found = as_dict(predict.find_moments(facts), "i", "j")
    assert found.keys() == brute_candidates(rows, config) & expected.keys()
    for pair, row in found.items():
        assert [row[name] for name in names] == expected[pair]


def test_more_bands_than_one_word_has_bits(spark, rows):
    config = replace(SMALL, lsh=LshConfig(bands=2 * similarity.BAND_BITS + 3, rows=1, min_item_ratings=5))
    facts = RatingFacts(spark.createDataFrame(rows, LONG), config)
    plain, wanted = brute_moments(rows, config), brute_candidates(rows, config)
    found = as_dict(similarity.pair_moments(facts, predict.find_buckets(facts)), "i", "j")
    assert found.keys() == {pair for pair in wanted if pair in plain}
    for pair, r in found.items():
        assert [r.n, r.sum_i, r.sum_j, r.sum_ii, r.sum_jj, r.sum_ij] == plain[pair]


def test_copies_share_one_bucket(spark):
    rows = [(user, item, 3.0) for user in range(10) for item in range(6)] + [(99, 50, 3.0), (99, 51, 1.0)]
    facts = RatingFacts(spark.createDataFrame(rows, LONG), SMALL)
    shared = predict.find_buckets(facts).collect()
    assert sorted(tuple(r) for r in shared) == [(item, 0, 0) for item in range(6)]


def test_corated_pairs(facts, rows):
    found = as_dict(similarity.corated_pairs(facts), "i", "j")
    assert {k: r.n for k, r in found.items()} == {k: m[0] for k, m in brute_moments(rows, SMALL).items()}


def test_corated_pairs_are_counted_where_they_are_met(facts):
    """Lists of users are sent to groups of items; no pair is shuffled, before or after it is counted."""
    plan = similarity.corated_pairs(facts)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("group#" in line for line in moves)
    assert not any("i#" in line and "j#" in line for line in moves)


@pytest.mark.parametrize(("most", "wide"), [(1 << 21, 0), (300, 3), (1, 14)])
def test_corated_pairs_of_frequent_items_and_odd_rows(spark, rows, most, wide):
    odd = [(None, 1, 3.0), (None, 2, 3.0), (7, None, 3.0), (300, None, 2.0), (300, 1, 2.0), (301, 2, None), (301, 3, 2.0)]
    given = rows + odd + [row for row in rows if row[0] % 3 == 0]
    config = replace(SMALL, max_user_ratings=20, skew=SkewConfig(part_pairs=most))
    facts = RatingFacts(spark.createDataFrame(given, LONG), config)
    by_user, expected = defaultdict(list), defaultdict(int)
    for user, item, stars in given:
        by_user[user].append((item, stars))
    for user, rated in by_user.items():
        if user is not None and 2 <= sum(stars is not None for _, stars in rated) <= 20:
            items = [item for item, _ in rated if item is not None]
            for i, j in combinations(sorted(items), 2):
                expected[i, j] += i < j
    found = as_dict(similarity.corated_pairs(facts), "i", "j")
    assert {k: r.n for k, r in found.items()} == {k: n for k, n in expected.items() if n}
    total = facts.by_user.where("n BETWEEN 2 AND 20").selectExpr("sum(n * (n - 1) div 2)").first()[0]
    numbers = [r.group for r in similarity._item_groups(facts, max(8, -(-total // most))).collect()]
    assert len(numbers) == 14 and sum(n < 0 for n in numbers) == wide


def test_parts_hold_users_alike_and_few_pairs(spark):
    """What a task sums up does not grow with the ratings; users alike lie together up to that bound."""
    rows = [(user, 10 * (user // 40) + item, float(1 + (user * item) % 5)) for user in range(200) for item in range(6)]
    found = []
    for most, parts in ((600, 5), (150, 20)):
        facts = RatingFacts(spark.createDataFrame(rows, LONG), replace(SMALL, skew=SkewConfig(part_pairs=most)))
        users = facts.by_user.selectExpr("user", "n", "user div 40 AS place")
        dealt, count = similarity._parts(users, facts)
        sizes = [15 * r["count"] for r in dealt.groupBy("part").count().collect()]
        assert count == parts and len(sizes) == parts and sum(sizes) == 3000 and max(sizes) <= 2 * most
        buckets = predict.find_buckets(facts)
        found.append([row_set(similarity.corated_pairs(facts)), row_set(similarity.pair_moments(facts, buckets))])
    assert found[0] == found[1] and len(found[0][0]) == 5 * 15


def test_golden_similarity(golden):
    facts = RatingFacts(golden, Config())
    moments = predict.find_moments(facts, one_bucket(facts))
    found = {k: (r.n, round(r.sim, 6)) for k, r in as_dict(similarity.pair_similarity(moments, Config()), "i", "j").items()}
    assert found == {
        ("A", "B"): (3, 0.041836), ("A", "C"): (3, -0.047485), ("A", "D"): (1, 0.0),
        ("B", "C"): (2, -0.031859), ("B", "D"): (1, 0.0), ("C", "D"): (1, 0.0),
    }


def test_similarity_is_bounded_and_edges_are_symmetric(facts):
    similar = similarity.pair_similarity(predict.find_moments(facts, one_bucket(facts)), SMALL)
    assert all(abs(r.sim) <= 1 and not math.isnan(r.sim) for r in similar.collect())
    edges = as_dict(neighbors.similarity_edges(similar), "item", "nbr")
    assert len(edges) == 2 * similar.count()
    assert all(edges[nbr, item].sim == r.sim for (item, nbr), r in edges.items())


def test_top_neighbors_breaks_ties_by_id(spark):
    edges = [("a", nbr, sim) for nbr, sim in (("d", 0.5), ("c", 0.5), ("b", 0.1), ("e", 0.9), ("f", -1.0))]
    config = replace(Config(), top_k=3)
    found = neighbors.top_neighbors(spark.createDataFrame(edges, "item string, nbr string, sim double"), config)
    assert [(r.nbr, r["rank"]) for r in sorted(found.collect(), key=lambda r: r["rank"])] == [("e", 1), ("c", 2), ("d", 3)]
    assert neighbors.neighbor_count(found).first().neighbor_cnt == 3
    assert neighbors.packed_neighbors(found).first().neighbor_cnt == 3


def test_order_and_partitions_do_not_matter(spark, facts, rows):
    shuffled = RatingFacts(spark.createDataFrame(rows[::-1], LONG).repartition(9), SMALL)
    assert row_set(predict.find_neighbors(facts)) == row_set(predict.find_neighbors(shuffled))


def test_text_ids_work_like_numbers(spark):
    rows = ratings(prefix="id")
    facts = RatingFacts(spark.createDataFrame(rows, "user string, item string, stars double"), SMALL)
    found = predict.find_moments(facts)
    expected = brute_moments(rows, SMALL)
    assert found.count() > 0
    for pair, row in as_dict(found, "i", "j").items():
        assert (row.n, row.sum_ij) == (expected[pair][0], expected[pair][5])


def test_recall_follows_the_banding_curve(spark):
    # items 2k and 2k + 1 share 30 of 50 raters each: Jaccard 30 / 70
    rows, rng = [], random.Random(1)
    for pair in range(150):
        users = rng.sample(range(2**40), 70)
        rows += [(u, 2 * pair, 3.0) for u in users[:50]]
        rows += [(u, 2 * pair + 1, 3.0) for u in users[20:]]
    config = Config(lsh=LshConfig(bands=20, rows=3, min_item_ratings=50))
    facts = RatingFacts(spark.createDataFrame(rows, LONG), config)
    found = similarity.candidate_pairs(facts, predict.find_buckets(facts)).count()
    expected = 1 - (1 - (30 / 70) ** 3) ** 20
    assert abs(found / 150 - expected) < 0.12
