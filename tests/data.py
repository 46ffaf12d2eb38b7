"""Small generated tables for the tests."""

import random

from pyspark.sql import functions as F


def one_bucket(facts):
    """All items in one bucket, so that every co-rated pair is a candidate."""
    first = facts.by_item.agg(F.min("item")).first()[0]
    return facts.by_item.select("item", F.lit(0).alias("band"), F.lit(first).alias("bucket"))


def ratings(seed=7, users=60, items=14, share=0.5, prefix=""):
    """Random ratings in which some items are copies of each other and taste is real."""
    rng = random.Random(seed)
    rows = []
    for user in range(users):
        mood = user % 2
        for item in range(items):
            if rng.random() < share or item % 5 == 0:
                base = 4 if item % 2 == mood else 2
                stars = float(min(5, max(1, base + rng.randint(-1, 1))))
                rows.append((f"{prefix}{user}" if prefix else user, f"{prefix}{item}" if prefix else item, stars))
    return rows
