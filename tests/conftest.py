import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# A small ratings table worked out by hand.
GOLDEN = [
    ("u1", "A", 5.0), ("u1", "B", 4.0), ("u1", "C", 1.0), ("u2", "A", 4.0), ("u2", "B", 5.0),
    ("u3", "A", 1.0), ("u3", "B", 2.0), ("u3", "C", 5.0), ("u3", "D", 3.0), ("u4", "B", 3.0),
    ("u5", "A", 3.0), ("u5", "C", 2.0),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="starwise-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    return spark.createDataFrame(GOLDEN, "user string, item string, stars double")


def as_dict(df, *keys):
    """Rows by key; single keys are unpacked."""
    rows = df.collect()
    found = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(found) == len(rows), "keys must be unique"
    return found


def row_set(df):
    columns = sorted(df.columns)
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect()
    )
