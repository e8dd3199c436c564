"""Queries against their SQL on the smallest tables; LABWATCH_ALL=1 adds the slow summaries."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from labwatch.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SLOW = tuple(f"M{i:02d}" for i in range(5, 24)) + ("M25", "M26", "MCUBE", "C05_combined_f", "C07")
NAMES = [n for n in QUERIES if os.environ.get("LABWATCH_ALL") or not n.startswith(SLOW)]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare(df, connect(FOLDER), ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.queries()) >= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "pathogen", "Pos", "Neg", "totaltests", "posrate"] and not df.isEmpty()
