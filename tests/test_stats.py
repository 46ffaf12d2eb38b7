import hashlib
from dataclasses import replace

import pytest
from conftest import as_dict, row_set
from data import ratings

from starwise.config import Config
from starwise.operators import stats
from starwise.operators.prefix import block_starts

LONG = "user long, item long, stars double"


def test_means(golden):
    items = as_dict(stats.item_stats(golden), "item")
    assert {k: (round(r.avg_stars, 6), r.n) for k, r in items.items()} == {
        "A": (3.25, 4), "B": (3.5, 4), "C": (2.666667, 3), "D": (3.0, 1),
    }
    users = as_dict(stats.user_stats(golden), "user")
    assert {k: round(r.avg_stars, 6) for k, r in users.items()} == {
        "u1": 3.333333, "u2": 4.5, "u3": 2.75, "u4": 3.0, "u5": 2.5,
    }
    assert round(stats.global_stats(golden).first().avg_stars, 6) == 3.166667


def test_dedupe_takes_the_highest(spark):
    rows = [(1, 1, 2.0), (1, 1, 5.0), (1, 1, 3.0), (2, 1, 1.0)]
    found = stats.dedupe_ratings(spark.createDataFrame(rows, LONG))
    assert row_set(found) == [(1, 1.0, 2), (1, 5.0, 1)]


def test_activity_bounds_are_2_to_499(spark):
    rows = [("u", n) for n in (1, 2, 499, 500)]
    counts = spark.createDataFrame(rows, "user string, n long")
    assert sorted(r.n for r in stats.active_users(counts, Config()).collect()) == [2, 499]


def test_popularity_starts_at_100(spark):
    counts = spark.createDataFrame([("a", 99), ("b", 100)], "item string, n long")
    assert [r.item for r in stats.popular_items(counts, Config()).collect()] == ["b"]


def test_history_and_raters(golden):
    history = as_dict(stats.user_history(golden), "user")
    assert tuple(history["u3"])[1:] == (4, 11.0, "A", "D")
    raters = as_dict(stats.item_raters(golden.union(golden)), "item")
    assert {k: r.n_users for k, r in raters.items()} == {"A": 4, "B": 4, "C": 3, "D": 1}


def test_user_index_is_dense_and_stable(spark):
    rows = spark.createDataFrame(ratings(users=300), LONG)
    found = as_dict(stats.user_index(rows, buckets=16), "user")
    assert sorted(r.ix for r in found.values()) == list(range(len(found)))
    again = as_dict(stats.user_index(rows.repartition(7), buckets=16), "user")
    assert found == again
    with pytest.raises(ValueError):
        stats.user_index(rows, buckets=10)


def test_baseline(spark, golden):
    requests = spark.createDataFrame([("u9", "B"), ("u1", "Z")], "user string, item string")
    found = as_dict(stats.baseline_predict(requests, stats.RatingFacts(golden, Config())), "item")
    assert (found["B"].prediction, found["B"].reason) == (3.5, "item_mean")
    assert (round(found["Z"].prediction, 6), found["Z"].reason) == (3.166667, "global_mean")


def test_heavy_users_are_dropped(spark):
    rows = [("heavy", f"i{k}", 3.0) for k in range(40)] + [("light", f"i{k}", 3.0) for k in range(5)]
    config = replace(Config(), max_user_ratings=20)
    config = replace(config, skew=replace(config.skew, min_rows=10, share=0.01))
    facts = stats.RatingFacts(spark.createDataFrame(rows, "user string, item string, stars double"), config)
    assert facts.hot_users is not None
    assert {r.user for r in stats.without_heavy_users(facts).collect()} == {"light"}
    assert stats.active_ratings(facts).count() == 5


def test_user_index_over_many_levels_of_starts(spark):
    rows = spark.createDataFrame(ratings(users=300), LONG)
    plain = as_dict(stats.user_index(rows, buckets=256), "user")
    assert as_dict(stats.user_index(rows, buckets=256, fan=4), "user") == plain  # 256, 64, 16 and 4 blocks
    users = sorted(plain, key=lambda u: (hashlib.md5(str(u).encode()).hexdigest()[:2], u))
    assert [plain[u].ix for u in users] == list(range(len(users)))


@pytest.mark.parametrize("fan", [2, 3, 1000])
def test_block_starts(spark, fan):
    sizes = {k: (7 * k) % 5 for k in range(23) if k % 6}  # with gaps
    rows = spark.createDataFrame(list(sizes.items()), "block long, size long").repartition(5)
    found = {r.block: r.start for r in block_starts(rows, 23, fan=fan).collect()}
    assert found == {k: sum(v for b, v in sizes.items() if b < k) for k in sizes}


def test_no_window_of_block_starts_sees_all(spark):
    sizes = spark.range(5000).selectExpr("id AS block", "1L AS size")
    plan = block_starts(sizes, 5000, fan=100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_run" in line for line in windows) == 2
    assert "broadcast" not in plan.lower()
