"""Feeds of one table, and columns made on the side of a join that owns them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from labwatch.catalog import QUERIES
from labwatch.catalog.base import Tables
from labwatch.catalog.bridge import LINES, OF_CUSTOMER, lab_lines, wide_lines
from labwatch.operators.merge import FeedsOfTable, union_feeds


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Customers, parts and orders with NULL and repeated keys, and the lines of their orders."""
    base = tmp_path_factory.mktemp("tables")
    day = dt.datetime(1995, 3, 4)
    customers = [(k, k % 25, "BUILDING" if k % 2 else "MACHINERY") for k in range(40)]
    customers += [(3, 7, "FURNITURE"), (None, 1, "BUILDING"), (41, None, "BUILDING"), (42, 4, None)]
    orders = [(o, o % 43) for o in range(80)] + [(None, 5), (81, None), (5, 6)]
    lines = [
        (o, (o + n) % 7, n, n, 3.0 + n, 0.0 if n == 2 else 0.04, "ANR"[(o + n) % 3], "OF"[o % 2], day)
        for o in range(82)
        for n in range(1, 4)
    ]
    lines += [lines[0], (None, 1, 1, 1, 1.0, 0.0, "A", "O", day)]
    parts = [(p, ["STANDARD", "MEDIUM", "OTHER", "SMALL", None, "PROMO", "ECONOMY"][p], p) for p in range(7)]
    tables = {
        "customer": (customers, "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long"),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "part": (parts, "p_partkey long, p_type string, p_size int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")
    return str(base)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_finals_of_one_table_are_made_once(spark, folder):
    combined = QUERIES["C01_combine_feeds"](spark, folder)
    assert optimized(combined).count("l_orderkey") > 0 and "Union" not in optimized(combined)
    assert combined.count() > 0


def test_feeds_of_a_table_unite_like_separate_feeds(spark):
    rows = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (1, 2), (None, 3), (9, 4)], "lab int, v int")
    feeds = FeedsOfTable(rows, {"a": F.col("lab") == 0, "b": F.col("lab") == 1, "odd": F.col("v") % 2 == 1, "none": F.lit(False)})
    assert list(feeds) == ["a", "b", "odd", "none"] and feeds["b"].count() == 2
    for distinct in (True, False):
        got, want = union_feeds(feeds, ["v"], distinct), union_feeds(dict(feeds), ["v"], distinct)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_customers_columns_are_made_before_their_lines(spark, folder):
    got = lab_lines(Tables(spark, folder))
    want = wide_lines(Tables(spark, folder)).select(*[F.expr(e).alias(n) for n, e in LINES.items()])
    assert got.columns == want.columns and got.count() > 200
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # What stands above the first join of the plan reads the columns only.
    top = optimized(got).split("Join")[0]
    assert not any(c in top for c in ("o_custkey", "c_mktsegment", "c_nationkey"))
    assert all(c in top for c in OF_CUSTOMER)
