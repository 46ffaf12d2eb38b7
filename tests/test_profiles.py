"""Scalar rules and profile reading on edge cases."""

import json
import math

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from starwise.config import HASH_PRIME
from starwise.functions import scalars
from starwise.operators import features
from starwise.sources import profiles


def one(spark, rule, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(rule(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "count"), [(None, 0), ("", 0), ("None", 0), ("a", 1), ("a,b,c", 3), ("a,b,,", 4)]
)
def test_list_count(spark, text, count):
    assert one(spark, scalars.list_count, text, "string") == count


@pytest.mark.parametrize(
    ("text", "value"), [("x", 0), (None, 0), ("-2", 0), ("0", 0), ("3", 1.386294), (" 3 ", 1.386294)]
)
def test_safe_log1p(spark, text, value):
    assert round(one(spark, scalars.safe_log1p, text, "string"), 6) == value


@pytest.mark.parametrize(
    ("text", "value"), [("True", 1), (" yes ", 1), ("1", 1), ("YES", 1), ("no", 0), ("", 0), (None, 0)]
)
def test_flag(spark, text, value):
    assert one(spark, scalars.flag, text, "string") == value


@pytest.mark.parametrize(("text", "value"), [("3", 3), (" 3 ", 3), ("2.0", 2), ("x", 2), (None, 2)])
def test_price(spark, text, value):
    assert one(spark, scalars.price, text, "string") == value


@pytest.mark.parametrize(
    ("number", "value"), [(1.5, 1.5), (math.nan, 0), (math.inf, 0), (-math.inf, 0), (-3.0, -3.0)]
)
def test_finite(spark, number, value):
    assert one(spark, scalars.finite, number, "double") == value


@pytest.mark.parametrize(("number", "value"), [(0.2, 1), (7.0, 5), (3.3, 3.3), (math.nan, 5)])
def test_clip(spark, number, value):
    assert one(spark, lambda c: scalars.clip(c, 1.0, 5.0), number, "double") == value


def test_ids_become_words_of_all_their_bits(spark):
    words = lambda c: F.concat_ws(",", *scalars.id_words(c, True))
    assert one(spark, words, 5, "long") == "5,0,0"
    assert one(spark, words, HASH_PRIME + 3, "long") == "2,512,0"
    assert one(spark, words, -1, "long") == f"{2**22 - 1},{2**22 - 1},{2**20 - 1}"
    text = one(spark, lambda c: F.concat_ws(",", *scalars.id_words(c, False)), "abc", "string")
    number = int("900150983cd24fb0"[:15], 16)
    assert text == f"{number % 2**22},{(number >> 22) % 2**22},{number >> 44}"


def users(spark, *records):
    lines = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "line string")
    return as_dict(profiles.user_features(lines), "user")


def items(spark, *records):
    lines = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "line string")
    return as_dict(profiles.item_features(lines), "item")


def test_full_user(spark):
    record = {
        "user_id": "a", "average_stars": 3.5, "review_count": 10, "fans": 1, "useful": 2, "cool": 3, "funny": 4,
        "friends": "x,y,z", "elite": "2015,2016", "compliment_hot": 5, "compliment_cool": 6,
        "compliment_funny": 7, "compliment_photos": 8, "name": "ignored",
    }
    row = users(spark, record)["a"]
    assert [row[name] for name in profiles.USER_FEATURES] == [3.5, 10, 1, 2, 3, 4, 3, 2, 5, 6, 7, 8]
    assert row.record_ok


def test_absent_user_fields_take_defaults(spark):
    row = users(spark, {"user_id": "a", "fans": 2})["a"]
    assert math.isnan(row.u_avg_stars) and row.u_fans == 2 and row.u_useful == 0 and row.record_ok


@pytest.mark.parametrize("fans", [None, "x", "12.5", [1], {}])
def test_unreadable_number_spoils_the_user(spark, fans):
    row = users(spark, {"user_id": "a", "average_stars": 4.0, "fans": fans, "useful": 9})["a"]
    assert not row.record_ok and [row[name] for name in profiles.USER_FEATURES] == [0] * 12


@pytest.mark.parametrize(("fans", "read"), [("12", 12), (" 7 ", 7), (12.7, 12), (True, 1)])
def test_readable_numbers(spark, fans, read):
    assert users(spark, {"user_id": "a", "fans": fans})["a"].u_fans == read


@pytest.mark.parametrize("friends", [None, "", "None"])
def test_no_friends(spark, friends):
    row = users(spark, {"user_id": "a", "friends": friends})["a"]
    assert row.u_friends_cnt == 0 and row.record_ok


def test_broken_lines_are_dropped_and_counted(spark):
    lines = ["{", "", "[1]", "3", "null", '{"name": "no id"}', '{"user_id": "a"}']
    assert set(users(spark, *lines)) == {"a"}
    counted = profiles.count_unreadable(spark.createDataFrame([(x,) for x in lines], "line string")).first()
    assert (counted.lines, counted.unreadable) == (7, 5)


def test_duplicate_profiles_leave_one_row(spark):
    rows = [{"user_id": "a", "fans": 1}, {"user_id": "a", "fans": None}, {"user_id": "a", "fans": 3}]
    assert users(spark, *rows)["a"].record_ok


def test_full_item(spark):
    record = {
        "business_id": "b", "stars": 4.5, "review_count": 20, "latitude": 36.1, "longitude": -115.2,
        "categories": "Restaurants, Pizza",
        "attributes": {
            "RestaurantsPriceRange2": "3", "BusinessAcceptsCreditCards": "True", "RestaurantsReservations": True,
            "RestaurantsTableService": "False", "WheelchairAccessible": None,
        },
    }
    row = items(spark, record)["b"]
    assert [row[name] for name in profiles.ITEM_FEATURES] == [4.5, 20, 36.1, -115.2, 3, 1, 1, 0, 0, 1]


@pytest.mark.parametrize("attributes", [None, "text", {}, [1]])
def test_items_without_attributes(spark, attributes):
    row = items(spark, {"business_id": "b", "stars": 3, "attributes": attributes, "categories": "restaurants"})["b"]
    assert (row.b_price, row.b_credit_card, row.b_is_restaurant, row.record_ok) == (2, 0, 0, True)


def test_null_latitude_spoils_the_item(spark):
    row = items(spark, {"business_id": "b", "stars": 4.0, "latitude": None})["b"]
    assert not row.record_ok and row.b_price == 0 and row.b_avg_stars == 0


def test_feature_vectors(spark):
    user_lines = [{"user_id": "u", "review_count": 3, "average_stars": 4.0}, {"user_id": "bad", "fans": "x", "average_stars": 2.0}]
    item_lines = [{"business_id": "i", "stars": 2.0, "review_count": 0}, {"business_id": "nan", "review_count": 1}]
    to_lines = lambda rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    user_inputs = features.model_inputs(profiles.user_features(to_lines(user_lines)), "user")
    item_inputs = features.model_inputs(profiles.item_features(to_lines(item_lines)), "item")
    pairs = spark.createDataFrame([("u", "i"), ("bad", "nan"), ("new", "new")], "user string, item string")
    joined = features.with_profiles(pairs, user_inputs, item_inputs, None, None)
    found = as_dict(features.feature_vectors(joined, "user", "item_stars", "user_stars"), "user")
    row = found["u"]
    assert len(features.FEATURES) == 22 and round(row.u_review_cnt, 6) == 1.386294
    assert (row.b_avg_stars, row.b_price, row.u_avg_stars, row.item_stars) == (2.0, 2.0, 4.0, 2.0)
    row = found["bad"]
    assert (row.u_avg_stars, row.user_stars, row.b_avg_stars) == (0.0, None, 0.0) and math.isnan(row.item_stars)
    assert [found["new"][name] for name in features.FEATURES] == [0.0] * 22
