"""User and item profiles: JSON lines to feature columns.

Every field may be absent, null or of the wrong type, and the three differ: an absent field takes
its default, while a null or unreadable number spoils the whole record, whose features then all
are zero (``record_ok`` is false). Lines that are no JSON object at all are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starwise.functions.scalars import flag, list_count, price

# Feature column, profile field.
USER_COUNTS = {
    "u_review_cnt": "review_count",
    "u_fans": "fans",
    "u_useful": "useful",
    "u_cool": "cool",
    "u_funny": "funny",
    "u_cmp_hot": "compliment_hot",
    "u_cmp_cool": "compliment_cool",
    "u_cmp_funny": "compliment_funny",
    "u_cmp_photos": "compliment_photos",
}
USER_LISTS = {"u_friends_cnt": "friends", "u_elite_years": "elite"}
ITEM_FLAGS = {
    "b_credit_card": "BusinessAcceptsCreditCards",
    "b_reservation": "RestaurantsReservations",
    "b_table_service": "RestaurantsTableService",
    "b_wheelchair": "WheelchairAccessible",
}
PRICE_FIELD = "RestaurantsPriceRange2"
RESTAURANT_WORD = "Restaurant"

USER_FEATURES = (
    "u_avg_stars", "u_review_cnt", "u_fans", "u_useful", "u_cool", "u_funny",
    "u_friends_cnt", "u_elite_years", "u_cmp_hot", "u_cmp_cool", "u_cmp_funny", "u_cmp_photos",
)
ITEM_FEATURES = (
    "b_avg_stars", "b_review_cnt", "b_latitude", "b_longitude", "b_price",
    "b_credit_card", "b_reservation", "b_table_service", "b_wheelchair", "b_is_restaurant",
)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw profile lines in the column ``line``, blank ones skipped."""
    return spark.read.text(path).select(F.col("value").alias("line")).where(F.trim("line") != "")


def count_unreadable(lines: DataFrame) -> DataFrame:
    """One row: how many lines there are and how many are no JSON object."""
    return allow_repeated_fields(lines).agg(
        F.count("line").alias("lines"), F.count_if(_fields(()).isNull()).alias("unreadable")
    )


def observed(lines: DataFrame, seen: Observation) -> DataFrame:
    """``lines``, of which ``seen`` counts ``lines`` and those that are ``left_out``, while they are read."""
    left_out = F.count_if(_fields(()).isNull()).alias("left_out")
    return allow_repeated_fields(lines).observe(seen, F.count("line").alias("lines"), left_out)


def _fields(names: Iterable[str]) -> Column:
    """The named fields of a line in one pass; NULL for a line that is no JSON object.

    A field of the struct is NULL where it is absent and a variant null where it is null. Bare
    NaN and Infinity, which are no JSON but common, are read too.
    """
    kind = ", ".join(f"{name}: variant" for name in names) or "_: variant"
    quoted = F.regexp_replace("line", r"([:\[,]\s*)(-?(?:NaN|Infinity))(?=\s*[,}\]])", '$1"$2"')
    parsed = F.coalesce(F.try_parse_json("line"), F.try_parse_json(quoted))
    return F.try_variant_get(parsed, "$", f"struct<{kind}>")


def allow_repeated_fields(lines: DataFrame) -> DataFrame:
    """Let a line repeat a field; its last value counts. A setting of the session."""
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return lines


def _as(field: str, kind: str) -> Column:
    return F.try_variant_get(F.col(f"p.{field}"), "$", kind)


def _number(field: str, kind: str, default: float) -> Column:
    """The field as a number, its default where absent, NULL where it spoils the record."""
    return F.when(F.col(f"p.{field}").isNull(), F.lit(default).cast(kind)).otherwise(_as(field, kind))


def _attribute(name: str, kind: str) -> Column:
    return F.try_variant_get(F.col("p.attributes"), f"$.{name}", kind)


def _records(
    lines: DataFrame, fields: Iterable[str], id_field: str, key: str, key_type: str, columns: dict[str, Column]
) -> DataFrame:
    """Feature columns by id; spoiled records are zero, and of several records the highest stays."""
    ident = _as(id_field, "string").try_cast(key_type)
    parsed = allow_repeated_fields(lines).select(_fields([id_field, *fields]).alias("p"))
    read = parsed.select(ident.alias(key), *[column.alias(name) for name, column in columns.items()])
    ok = reduce(and_, [F.col(name).isNotNull() for name in columns])
    values = [F.when(F.col("record_ok"), F.col(name)).otherwise(0).alias(name) for name in columns]
    return (
        read.where(F.col(key).isNotNull())
        .withColumn("record_ok", ok)
        .groupBy(key)
        .agg(F.max(F.struct("record_ok", *values)).alias("r"))
        .select(key, *[f"r.{name}" for name in columns], "r.record_ok")
    )


def user_features(lines: DataFrame, key_type: str = "string") -> DataFrame:
    """(user, 12 features, record_ok) from user profile lines."""
    columns = {"u_avg_stars": _number("average_stars", "double", float("nan"))}
    columns |= {name: _number(field, "bigint", 0) for name, field in USER_COUNTS.items()}
    columns |= {name: list_count(_as(field, "string")) for name, field in USER_LISTS.items()}
    fields = ["average_stars", *USER_COUNTS.values(), *USER_LISTS.values()]
    ordered = {name: columns[name] for name in USER_FEATURES}
    return _records(lines, fields, "user_id", "user", key_type, ordered)


def item_features(lines: DataFrame, key_type: str = "string") -> DataFrame:
    """(item, 10 features, record_ok) from item profile lines."""
    dining = F.contains(_as("categories", "string"), F.lit(RESTAURANT_WORD))
    columns = {
        "b_avg_stars": _number("stars", "double", float("nan")),
        "b_review_cnt": _number("review_count", "bigint", 0),
        "b_latitude": _number("latitude", "double", 0.0),
        "b_longitude": _number("longitude", "double", 0.0),
        "b_price": price(_attribute(PRICE_FIELD, "int")).cast("double"),
        "b_is_restaurant": F.coalesce(dining, F.lit(False)).cast("double"),
    }
    columns |= {name: flag(_attribute(field, "string")).cast("double") for name, field in ITEM_FLAGS.items()}
    fields = ["stars", "review_count", "latitude", "longitude", "categories", "attributes"]
    ordered = {name: columns[name] for name in ITEM_FEATURES}
    return _records(lines, fields, "business_id", "item", key_type, ordered)
