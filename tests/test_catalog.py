"""Registered queries next to their SQL twins on the smallest tables."""

from pathlib import Path

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracle import oracles
from catalog.queries import QUERIES

SMALL_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL = {"model_predict", "end_to_end_predict"}

pytestmark = pytest.mark.skipif(not Path(SMALL_DIR).exists(), reason="the given tables are not here")


def test_every_query_has_sql_unless_it_fits_a_model():
    assert set(QUERIES) - set(oracles()) == WITHOUT_SQL
    assert set(oracles()) <= set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(oracles())))
def test_query(spark, name):
    ok, note = check.compare(spark, SMALL_DIR, name)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() == 144


def test_model_queries(spark):
    found = queries()["end_to_end_predict"](spark, SMALL_DIR)
    assert found.columns == ["user", "item", "prediction"] and found.count() == 144
