import pytest

LONG = "the quick brown fox jumps over a lazy dog and runs away " * 3000

ODD_ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "x", 1),
    (1, "alpha beta gamma delta epsilon zeta eta theta", "x", 1),
    (2, None, None, None),
    (3, "", "y", 2),
    (4, LONG, "z", 3),
    (None, "a text under a null id", None, None),
    (5, "!!! ??? ...", "w", 5),
    (6, "éàü 二 \U0001f600 <|endoftext|>", "v", 6),
]
# extra columns under names that operators use themselves
ODD_SCHEMA = "doc_id bigint, text string, hits string, times int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and clashing column names."""
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return make
