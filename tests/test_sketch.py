from dataclasses import replace

from conftest import row_set
from data import ratings

from starwise.config import Config
from starwise.operators import cf
from starwise.operators.stats import RatingFacts
from starwise.plans import predict
from starwise.sketch import key_sketch, might_match

LONG = "user long, item long, stars double"


def test_no_wanted_row_is_lost_and_few_others_stay(spark):
    rows = spark.range(200_000).selectExpr("id % 50000 AS user", "id AS item")
    keys = spark.range(0, 50_000, 100).selectExpr("id AS user").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS user"))
    kept = might_match(rows, "user", key_sketch(keys, "user"))
    assert kept.columns == ["user", "item"]
    wanted = kept.where("user % 100 = 0").count()
    assert wanted == rows.where("user % 100 = 0").count()
    assert kept.count() - wanted < 50
    assert might_match(rows, "user", key_sketch(keys.limit(0), "user")).count() == 0


def test_text_keys(spark):
    rows = spark.range(1000).selectExpr("concat('u', id) AS user")
    assert {r.user for r in might_match(rows, "user", key_sketch(rows.limit(3), "user")).collect()} == {r.user for r in rows.limit(3).collect()}


def test_requests_of_few_users_shuffle_few_ratings(spark):
    rows = ratings()
    facts = RatingFacts(spark.createDataFrame(rows, LONG), replace(Config()))
    few = spark.createDataFrame([(1, 2), (1, 5), (3, 4)], "user long, item long")
    assert cf.asked_ratings(few, facts).count() == sum(user in (1, 3) for user, _, _ in rows)
    plan = cf.asked_ratings(few, facts)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "broadcast" in plan
    everyone = spark.createDataFrame([(user, 2) for user in {user for user, _, _ in rows}], "user long, item long")
    assert cf.asked_ratings(everyone, facts) is facts.ratings


def test_predictions_are_the_same_either_way(spark, monkeypatch):
    rows = ratings(users=80)
    config = replace(Config(), lsh=replace(Config().lsh, bands=20, rows=1, min_item_ratings=5))
    facts = RatingFacts(spark.createDataFrame(rows, LONG), config)
    asked = spark.createDataFrame([(u, i) for u in (1, 2, 9, 999) for i in range(14)], "user long, item long")
    lists = predict.find_neighbors(facts)
    sketched = row_set(predict.cf_predict(asked, facts, lists))
    monkeypatch.setattr(cf, "ASKING_SHARE", -1.0)
    assert row_set(predict.cf_predict(asked, facts, lists)) == sketched
    assert any(row[1] > 0 for row in sketched)
