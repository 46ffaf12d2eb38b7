"""The given tables read as ratings, requests and profiles.

Customers rate suppliers: the quantity of a line becomes 1 to 5 stars. Every tenth pair is held
out as a request; the ``cold`` split also holds out whole users and items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwise import runtime


# The columns of the given tables that are read here.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
    "events": "user_id BIGINT, event_type STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; with the schema stated, no file has to be opened to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The ``blocks`` split: customers that make up a user, users per block and items per block.
BLOCK_CUSTOMERS, BLOCK_USERS, BLOCK_ITEMS = 3, 500, 70


def order_lines(spark: SparkSession, sf_dir: str, blocks: bool = False) -> DataFrame:
    """(user, item, stars) per order line, duplicates of a pair included.

    Suppliers grow with the scale while the ratings of a customer do not, so overlap thins out.
    With ``blocks`` a few customers make up a user, and a block of users rates items of its own:
    items grow with the users and the overlap stays the same at every scale.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_suppkey").alias("item"),
        (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("stars"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    rated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("user", "item", "stars")
    if not blocks:
        return rated
    grouped = rated.withColumn("user", F.expr(f"(user - 1) div {BLOCK_CUSTOMERS}"))
    return grouped.withColumn("item", F.expr(f"{BLOCK_ITEMS} * (user div {BLOCK_USERS}) + item % {BLOCK_ITEMS}"))


def ratings(spark: SparkSession, sf_dir: str, blocks: bool = False) -> DataFrame:
    return order_lines(spark, sf_dir, blocks).groupBy("user", "item").agg(F.max("stars").alias("stars"))


def held_out(split: str) -> Column:
    plain = F.pmod(F.col("user") * 31 + F.col("item") * 17, F.lit(10)) == 0
    if split != "cold":
        return plain
    return plain | (F.col("user") % 50 == 0) | (F.col("item") % 33 == 32)


def train_and_requests(
    spark: SparkSession, sf_dir: str, split: str = "plain", written: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train ratings and held-out ratings; ``written`` computes the ratings once for many reads."""
    rated = ratings(spark, sf_dir, split == "blocks")
    if written:
        rated = runtime.written(rated)
    return rated.where(~held_out(split)), rated.where(held_out(split))


def _json_line(fields: dict[str, str]) -> Column:
    """A JSON object from SQL expressions for the raw field values; NULL leaves a field out."""
    parts = ", ".join(f"""'"{name}":' || ({value})""" for name, value in fields.items())
    return F.expr(f"'{{' || concat_ws(',', {parts}) || '}}'")


USER_LINE = {
    "user_id": "id",
    "average_stars": "if(id % 29 <> 0, avg_stars, NULL)",
    "review_count": "n",
    "fans": """CASE WHEN id % 37 = 0 THEN 'null' WHEN id % 41 = 0 THEN '"x"' WHEN id % 43 = 0 THEN '"12"'
               ELSE string(viewed) END""",
    "useful": "click",
    "cool": "purchase",
    "funny": "signup",
    "friends": """if(id % 3 <> 0, '"' || c_mktsegment || ',' || c_nationkey || '"', NULL)""",
    "elite": """CASE id % 4 WHEN 0 THEN '""' WHEN 1 THEN '"None"' WHEN 2 THEN '"2015,2016"' ELSE 'null' END""",
    "compliment_hot": "error",
    "compliment_cool": "c_nationkey",
    "compliment_funny": "id % 7",
    "compliment_photos": "if(id % 2 = 0, id % 11, NULL)",
}

ATTRIBUTES = {
    "RestaurantsPriceRange2": """CASE id % 5 WHEN 0 THEN '"3"' WHEN 1 THEN '"2.0"' WHEN 2 THEN '"x"' WHEN 3 THEN '4' END""",
    "BusinessAcceptsCreditCards": """CASE id % 3 WHEN 0 THEN '"True"' WHEN 1 THEN 'true' ELSE 'null' END""",
    "RestaurantsReservations": """CASE id % 4 WHEN 0 THEN '" yes "' WHEN 1 THEN '"no"' END""",
    "RestaurantsTableService": """if(id % 2 = 0, '"1"', '1')""",
    "WheelchairAccessible": """CASE id % 6 WHEN 0 THEN '"False"' WHEN 1 THEN '"TRUE"' END""",
}

ITEM_LINE = {
    "business_id": "id",
    "stars": "if(id % 23 <> 0, avg_stars, NULL)",
    "review_count": "n",
    "latitude": "if(id % 31 = 0, 'null', string(s_acctbal))",
    "longitude": "if(id % 13 <> 0, s_nationkey * -1.5D, NULL)",
    "categories": """CASE id % 3 WHEN 0 THEN '"Restaurants, Pizza"' WHEN 1 THEN '"restaurants"' ELSE 'null' END""",
    "attributes": "if(id % 10 = 9, 'null', attributes)",
}


def user_profile_lines(spark: SparkSession, sf_dir: str, train: DataFrame) -> DataFrame:
    """Customers as JSON profile lines, with nulls, texts and gaps where real profiles have them."""
    counts = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.expr("count_if(event_type = 'view') AS viewed"),
        *[F.expr(f"count_if(event_type = '{kind}') AS {kind}") for kind in ("click", "purchase", "signup", "error")],
    )
    means = train.groupBy(F.col("user").alias("id")).agg(F.expr("avg(stars) AS avg_stars"), F.expr("count(stars) AS n"))
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    known = customers.join(means, "id", "left").join(counts, "id", "left")
    return known.select(_json_line(USER_LINE).alias("line"))


def item_profile_lines(spark: SparkSession, sf_dir: str, train: DataFrame) -> DataFrame:
    """Suppliers as JSON profile lines, with nulls, odd texts and gaps."""
    means = train.groupBy(F.col("item").alias("id")).agg(F.expr("avg(stars) AS avg_stars"), F.expr("count(stars) AS n"))
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "id")
    known = suppliers.join(means, "id", "left").withColumn("attributes", _json_line(ATTRIBUTES))
    return known.select(_json_line(ITEM_LINE).alias("line"))
