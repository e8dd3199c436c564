"""Joins on ranges and patterns, two-level totals, tagged unions, checks of keys and mergeable distinct counts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labwatch import session, vocab
from labwatch.operators.aggregates import distinct_counts, distinct_states
from labwatch.catalog import QUERIES, feed_queries, file_queries
from labwatch.schema import LAB_COLUMNS
from labwatch.operators import joins
from labwatch.operators.joins import covering_join, pattern_join
from labwatch.operators.merge import split_feeds, union_feeds, upsert
from labwatch.operators.windows import running_total, running_total_by_range
from labwatch.plans import matrices
from labwatch.plans import quality as Q
from labwatch.plans.combine import guarded
from labwatch.streaming import ingest
from labwatch.sources import snapshots


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_ranges_of_any_width(spark):
    random = np.random.default_rng(3)
    bands = [(i, int(low), int(low + 10 ** random.integers(0, 7) * random.random())) for i, low in enumerate(random.integers(-500_000, 500_000, 120))]
    bands += [(900, -(2**63), 2**63 - 1), (901, 5, 4), (902, None, 3), (903, 7, None), (904, 7, 7), (905, 0, 2**62), (906, -1, 0)]
    points = [(i, float(v)) for i, v in enumerate(random.integers(-600_000, 600_000, 300))] + [(900, None), (901, 7.5), (902, 7.0), (903, -0.5), (904, 7.0)]
    df = spark.createDataFrame(points, "k int, v double")
    dim = spark.createDataFrame(bands, "b int, low long, high long")
    want = sorted((k, b) for k, v in points for b, low, high in bands if None not in (v, low, high) and low <= v <= high)
    inner = covering_join(df, dim, "v", "low", "high", "inner")
    assert sorted((r.k, r.b) for r in inner.collect()) == want
    left = covering_join(df, dim, "v", "low", "high")
    assert sum(r.b is None for r in left.collect()) == 1 and left.columns == ["k", "v", "b", "low", "high"]
    assert "NestedLoop" not in plan_of(inner) and "Cartesian" not in plan_of(inner)
    none = covering_join(df, dim.filter("b = 901"), "v", "low", "high")
    assert {r.b for r in none.collect()} == {None} and none.count() == len(points)


def test_customers_of_bands_are_counted_without_pairs(spark, tmp_path):
    random = np.random.default_rng(11)
    orders = [(i, int(c) if c else None, float(p) if p % 9 else None) for i, (c, p) in enumerate(zip(random.integers(0, 12, 400), random.integers(0, 4000, 400)))]
    orders += [(900, 3, 700.0), (901, 3, 700.0), (902, None, 700.0), (None, 4, 701.0)]
    suppliers = [(int(k),) for k in random.integers(0, 9, 12)] + [(None,), (6,), (6,)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(suppliers, "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    df = QUERIES["J02_bands_of_any_width"](spark, str(tmp_path))
    want = {}
    for (k,) in suppliers:
        if k is not None:
            held = [c for _, c, p in orders if p is not None and k * 700 <= p <= k * 700 + 10 ** (k % 7)]
            n, who = want.get(k, (0, set()))
            if held:
                want[k] = (n + len(held), who | {c for c in held if c is not None})
    assert {r.s_suppkey: (r.n, r.customers) for r in df.collect()} == {k: (n, len(who)) for k, (n, who) in want.items()}
    assert "Expand" not in plan_of(df) and "count(distinct" not in plan_of(df)


def test_ranges_beyond_all_values_are_not_cut(spark):
    df = spark.createDataFrame([(5.0,), (9.5,)], "v double")
    dim = spark.createDataFrame([(1, 0, 5), (2, 10, 10**15), (3, -9, 4), (4, 9, 10**15)], "b int, low long, high long")
    got = covering_join(df, dim, "v", "low", "high", "inner")
    assert sorted((r.v, r.b) for r in got.collect()) == [(5.0, 1), (9.5, 4)]
    assert plan_of(got).lower().count("subquery") > 0


def like(value, pattern):
    import re

    parts = ["." if c == "_" else ".*" if c == "%" else re.escape(c) for c in pattern]
    return re.fullmatch("".join(parts), value, re.S) is not None


@pytest.mark.parametrize("ignore_case", [True, False])
def test_patterns_that_begin_with_a_wildcard(spark, ignore_case):
    random = np.random.default_rng(5)
    text = lambda n: "".join(random.choice(list("abAB "), n))
    values = [(i, text(random.integers(0, 12))) for i in range(200)] + [(900, None), (901, "100% sure"), (902, "x_y")]
    patterns = [(i, "".join([str(random.choice(["%", "_", "%%", ""])), text(random.integers(0, 6)), str(random.choice(["%", "", "_"])), text(random.integers(0, 3)), "%"])) for i in range(150)]
    patterns += [(900, None), (901, "%"), (902, "_%"), (903, "%zzzzz%"), (904, "")]
    df = spark.createDataFrame(values, "k int, v string")
    dim = spark.createDataFrame(patterns, "p int, pattern string")
    fold = str.upper if ignore_case else str
    want = sorted((k, p) for k, v in values for p, x in patterns if v is not None and x is not None and like(fold(v), fold(x)))
    got = pattern_join(df, dim, {"v": "pattern"}, "inner", ignore_case)
    assert sorted((r.k, r.p) for r in got.collect()) == want
    escaped = spark.createDataFrame([(1, r"%0\% s%"), (2, r"%x\_y")], "p int, pattern string")
    found = pattern_join(df, escaped, {"v": "pattern"}, "inner", ignore_case).collect()
    assert sorted((r.k, r.p) for r in found) == [(901, 1), (902, 2)]


def test_short_stretches_are_looked_up(spark):
    """A stretch of one or two letters meets the values that hold it, not all of them; long ones meet by a part."""
    values = spark.createDataFrame([("abcdefghijkl",), ("bca",), ("xyz",), ("",)], "__v string")
    patterns = spark.createDataFrame(
        [("%ab%", "ab"), ("%c_", "c"), ("%abcdefghij%", "abcdefghij"), ("%zzzzzzzzzz%", "zzzzzzzzzz")], "pattern string, __literal string"
    )
    met = joins._by_runs(values, F.col("__v"), patterns).select("__v", "pattern").collect()
    assert sorted(map(tuple, met)) == [
        ("abcdefghijkl", "%ab%"), ("abcdefghijkl", "%abcdefghij%"), ("abcdefghijkl", "%c_"), ("bca", "%c_")
    ]
    sure = spark.createDataFrame([("%ab%", "ab"), ("%%ab%", "ab"), ("%ab", "ab"), ("%ab%_", "ab"), (r"%\\%ab%", "ab")], "p string, l string")
    assert [r[0] for r in sure.select(joins.only_holds(F.col("p"), F.col("l"))).collect()] == [True, True, False, False, False]


@pytest.mark.parametrize("copies, part_bytes, task_rows", [(1, 10**9, 10**6), (1, 3_000, 1), (9, 10**9, 10**6)])
def test_inner_patterns_come_to_the_rows(spark, monkeypatch, copies, part_bytes, task_rows):
    """Where values hardly repeat neither their runs nor the pairs are shuffled, in one broadcast or in several."""
    monkeypatch.setattr(joins, "PART_BYTES", part_bytes)
    monkeypatch.setattr(joins, "TASK_ROWS", task_rows)
    random = np.random.default_rng(11)
    text = lambda n: "".join(random.choice(list("abcd"), n))
    # The last letters of a text with a line break after them are not its end.
    values = [(i, text(random.integers(0, 16))) for i in range(100)] + [(900, None), (901, "ab\n"), (902, "çab𝄞d")]
    signs = ["%", "%_", "_%", "%_%_", "_", "", "%a", "%\n"]
    patterns = [f"{random.choice(['%', '%%', '%_', '_%'])}{text(random.integers(1, 6))}{random.choice(signs)}" for _ in range(120)]
    patterns += ["%ab%\n", "%ab%_", "%𝄞%_", "%𝄞%__", "%abcdabcdab%", f"%{values[0][1] * 2}%", None] + [f"%{v[2:12]}%" for _, v in values[:30] if len(v) > 11]
    dim = spark.createDataFrame([*enumerate(patterns)], "k int, pattern string")
    df = spark.createDataFrame(values * copies, "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = pattern_join(df, dim, {"v": "pattern"}, "inner", ignore_case=False)
        plan = plan_of(got)
        found = sorted(tuple(r) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pairs = [(k, v, p, x) for k, v in values for p, x in enumerate(patterns) if v is not None and x is not None and like(v, x)]
    assert found == sorted(pairs * copies)
    assert ("hashpartitioning(__run" in plan) == (copies > 1)


def test_two_level_totals(spark):
    random = np.random.default_rng(7)
    rows = [(str(random.integers(0, 2)), int(o), int(v) if v > 2 else None) for o, v in zip(random.integers(0, 60, 500), random.integers(0, 50, 500))]
    rows += [(None, 5, 1), ("0", None, 9), ("z", 1, None), ("z", 50, None), ("z", 51, 3)]
    df = spark.createDataFrame(rows, "e string, o int, v int")
    want = running_total(df, ["e"], "o", "v", "total")
    for ranges in (1, 2, 9, 64):
        got = running_total_by_range(df, ["e"], "o", "v", "total", ranges)
        assert got.exceptAll(want).isEmpty() and got.count() == len(rows)
    days = spark.range(400).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("day"), F.col("id").alias("n"))
    whole = running_total_by_range(days, [], "day", "n", "total", 8)
    assert [r.total for r in whole.orderBy("day").collect()] == np.cumsum(np.arange(400)).tolist()
    # No window without a partition over rows: only the few ranges' totals meet.
    assert running_total_by_range(df.limit(0), ["e"], "o", "v", "total").count() == 0


def test_feeds_of_one_table_take_one_scan(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 as lab", "id % 5 as v").write.parquet(str(tmp_path / "t"))
    lines = spark.read.parquet(str(tmp_path / "t"))
    feeds = {f"L{i}": F.col("lab") == i for i in range(8)} | {"few": F.col("lab") < 2}
    got = split_feeds(lines, feeds, ["v"])
    want = union_feeds({lab: lines.filter(c) for lab, c in feeds.items()}, ["v"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert plan_of(got).count("FileScan") == 1 and plan_of(want).count("FileScan") == 9


def test_conditions_of_feeds_are_compiled(spark):
    lines = spark.range(20).selectExpr("if(id % 3 = 0, null, concat('LAB', id % 4)) AS lab_id", "id % 2 AS v")
    got = split_feeds(lines, {f"L{i}": F.col("lab_id") == f"LAB{i}" for i in range(4)} | {"odd": F.col("v") == 1}, ["v"])
    assert sorted(map(tuple, got.collect())) == [("L0", 0), ("L1", 1), ("L2", 0), ("L3", 1), ("odd", 1)]
    assert "lambdafunction" not in plan_of(got)


def test_checks_of_keys_in_one_shuffle(spark, tmp_path):
    rows = [(1, "a", 1), (1, "a", 2), (2, None, 3), (None, None, 4), (None, None, 5), (None, "x", 6), (None, "x", 7), (3, "y", 8)]
    spark.createDataFrame(rows, "k int, s string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = [
        Q.Check("unique_k", keys=Q.Keys(("k",), unique=True)),
        Q.Check("unique_ks", keys=Q.Keys(("k", "s"), unique=True)),
        Q.Check("unique_n", keys=Q.Keys(("n",), unique=True)),
        Q.Check("share_ks", keys=Q.Keys(("k", "s"), share=(0.9, 1.0))),
        Q.Check("repeats_2", keys=Q.Keys(("k", "s"), at_most=2)),
        Q.Check("repeats_3", keys=Q.Keys(("k", "s"), at_most=3)),
        Q.Check("large", F.col("n") > 6),
        Q.Check("rows", total=(F.count(F.lit(1)) < 10).cast("long")),
    ]
    report = Q.run_checks(df, checks)
    got = {r["check"]: r["failures"] for r in report.collect()}
    assert got["unique_k"] == Q.repeated_values(df, "k").count() == 1
    assert got["unique_ks"] == Q.repeated_values(df, "k", "s").count() == 2
    assert (got["unique_n"], got["share_ks"], got["repeats_2"], got["repeats_3"]) == (0, 1, 1, 0)
    assert (got["large"], got["rows"]) == (2, 1)
    assert plan_of(report).count("FileScan") == 2
    empty = {r["check"]: r["failures"] for r in Q.run_checks(df.limit(0), checks).collect()}
    assert empty == dict.fromkeys(empty, 0) | {"rows": 1} and set(empty) == set(got)


def test_checks_of_one_set_count_it_once(spark):
    """Two checks of the same columns share their fingerprints."""
    df = spark.range(50).selectExpr("id % 7 as k", "id % 3 as s")
    checks = [
        Q.Check("a", keys=Q.Keys(("k",), unique=True)),
        Q.Check("b", keys=Q.Keys(("k",), share=(0.5, 1.0))),
        Q.Check("c", keys=Q.Keys(("k", "s"), at_most=3)),
    ]
    counted = Q.key_counts(df, checks)
    assert {r["check"]: r["failures"] for r in counted.collect()} == {"a": 7, "b": 1, "c": 1}
    assert Q.key_sets(checks) == [("k",), ("k", "s")]


def test_samples_are_made_once_for_an_upsert(spark, monkeypatch):
    """Both sides of the load and merge read stored samples, so the lines are not aggregated again for each."""
    days = ["2024-05-01", "2025-05-01", "2026-05-01"]
    rows = spark.createDataFrame([(f"s{i}", "denv_pcr", "FM"[i % 2], dt.date.fromisoformat(days[i % 3])) for i in range(9)], "sample_id string, test_kit string, sex string, date_testing date")
    rows = rows.groupBy("sample_id").agg(*[F.max(c).alias(c) for c in rows.columns[1:]])
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in LAB_COLUMNS if c not in [*rows.columns, "created_at", "updated_at"]})
    for module in (feed_queries, file_queries):
        monkeypatch.setattr(module, "samples", lambda t: rows)
    for name in ("L13_step_upsert", "S15_upsert_table"):
        got = QUERIES[name](spark, "/none")
        assert got.count() == 9 and "max(test_kit" not in plan_of(got) and "ExistingRDD" not in plan_of(got)


def test_rows_stored_by_a_key_are_not_shuffled_by_it(spark):
    """An upsert of both sides by the key they are stored by reads their buckets: no exchange, no table left behind."""
    rows = spark.range(60).selectExpr("if(id % 20 = 7, null, concat('s', id)) as k", "cast(id as int) as v", "'new' as created_at")
    kept, tables = spark.conf.get(session.CLEANUP, None), spark.catalog.listTables()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = session.stored_by(rows, "k", "made")
        target = made.where("v % 3 = 0").withColumn("created_at", F.lit("old"))
        got = upsert(target, made.where("v % 2 = 0"), ["k"])
        assert "Exchange" not in plan_of(got) and "Bucketed: true" in plan_of(got)
        found = sorted(((r.k, r.v, r.created_at) for r in got.collect()), key=str)
        none = session.stored_by(rows.limit(0), "k", "made")
        assert upsert(none, none, ["k"]).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = []
    for v in range(60):
        k = None if v % 20 == 7 else f"s{v}"
        want += [(k, v, "old")] if v % 3 == 0 and (k is None or v % 2) else []
        want += [(k, v, "old" if v % 3 == 0 and k else "new")] if v % 2 == 0 else []
    assert found == sorted(want, key=str)
    assert spark.conf.get(session.CLEANUP, None) == kept and spark.catalog.listTables() == tables


def test_upserted_samples_lie_by_their_key(spark, tmp_path):
    """The load, the check for repeated keys and the merge of the samples need no shuffle of them."""
    dt_of = "timestamp_ntz '1997-05-01 00:00:00'"
    tables = {
        "lineitem": f"id div 3 as l_orderkey; id % 5 as l_partkey; id % 7 as l_suppkey; cast(id % 3 as int) as l_linenumber; double(id % 50) as l_quantity; 0.02D as l_tax; 'A' as l_returnflag; 'F' as l_linestatus; {dt_of} as l_shipdate",
        "orders": "id as o_orderkey; id % 11 as o_custkey",
        "customer": "id as c_custkey; id % 4 as c_nationkey; 'BUILDING' as c_mktsegment",
        "part": "id as p_partkey; if(id % 2 = 0, 'PROMO', 'STANDARD') as p_type; cast(id as int) as p_size",
    }
    for name, columns in tables.items():
        spark.range(120).selectExpr(*columns.split("; ")).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES["L13_step_upsert"](spark, str(tmp_path))
        assert "Exchange" not in plan_of(got)
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == len({r.sample_id for r in rows}) == len({(i // 3, i % 5 % 2) for i in range(120)})
    early = {(r.sex, r.test_kit, r.created_at.month, r.updated_at.month) for r in rows}
    assert early == {("F", "denv_pcr", 1, 1), ("F", "arbo_pcr_3", 1, 12), *((s, k, 12, 12) for s in ("M", None) for k in ("denv_pcr", "arbo_pcr_3"))}


def test_quarters_and_bands_are_counted_once(spark):
    made = spark.createDataFrame(
        [
            ("zikv_pcr", "10-19", dt.date(2022, 2, 1), "Pos"),
            ("zikv_pcr", "10-19", dt.date(2022, 2, 2), "Pos"),
            ("igm_serum", "20-29", dt.date(2022, 5, 1), "Neg"),
            ("denv_pcr", "20-29", dt.date(2023, 5, 1), "Pos"),
        ],
        "test_kit string, age_group string, date_testing date, zikv_test_result string",
    )
    others = [c for c in vocab.RESULT_COLUMNS if c != "zikv_test_result"]
    rows = made.select("*", *[F.lit("NT").alias(c) for c in others])
    grid = matrices.quarter_by_age_others(matrices.Summary(rows))
    found = {(r.trimestre[:8], r.faixas_etarias): r.Zika for r in grid.collect()}
    assert found == {("2022 - 1", "10-19"): 2, ("2022 - 2", "10-19"): None, ("2022 - 1", "20-29"): None, ("2022 - 2", "20-29"): 0}
    assert "ExistingRDD" not in plan_of(grid)


def test_weeks_of_a_map_are_counted_once(spark):
    days = [dt.date(2026, 1, 3), dt.date(2026, 1, 10), dt.date(2026, 1, 17)]
    made = spark.createDataFrame(
        [
            (days[0], "AA", "denv_pcr", "Pos"),
            (days[0], "AA", "denv_pcr", "Neg"),
            (days[1], "AA", "chikv_pcr", "Pos"),
            (days[2], "AA", "denv_pcr", "Pos"),
            (days[2], "AA", None, "Pos"),
            (days[2], "BB", "denv_pcr", None),
            (dt.date(2020, 1, 4), "AA", "denv_pcr", "Pos"),
        ],
        "epiweek_enddate date, state_code string, test_kit string, denv_test_result string",
    )
    people = spark.createDataFrame([("BR11", "AA", 1000)], "ADM2_PCODE string, DS_UF_SIGLA string, Populacao int")
    summary = matrices.Summary(made.withColumn("state", F.lower("state_code")), macroregions=people)
    cells = matrices._cumulative(summary, "DENV", ["state_code", "state"], "state_code")
    got = [(r.epiweek_enddate, r.state_code, r.cases, r.total) for r in cells.collect()]
    # A week without tests by a kit that counts is a week of the axis; a place without any has no row.
    assert sorted(got) == [(days[0], "AA", 1, 1), (days[1], "AA", 0, 1), (days[2], "AA", 1, 2)]
    assert "ExistingRDD" not in plan_of(cells)


def test_events_in_order_are_dealt_by_time(spark):
    rows = spark.range(1000, numPartitions=3).selectExpr("id", "pmod(hash(id), 700) as ts")
    got = file_queries.in_order(rows, "ts")
    assert "rangepartitioning" in plan_of(got) and "Coalesce" not in plan_of(got)
    parts = got.select("ts", F.spark_partition_id().alias("p")).collect()
    assert [r.ts for r in parts] == sorted(r.ts for r in parts) and len(parts) == 1000


def test_distinct_counts_from_states(spark):
    rows = [(i % 3, i % 4, f"p{i % 37}") for i in range(300)] + [(0, 0, None), (9, 9, None), (None, 1, "p1")]
    df = spark.createDataFrame(rows, "a int, b int, v string")
    states = distinct_states(df, ["a", "b"], "v")
    for by in (["a"], ["b"], ["a", "b"]):
        got = {tuple(r)[:-1]: r[-1] for r in distinct_counts(states, by, "n").collect()}
        want = {tuple(r)[:-1]: r[-1] for r in df.groupBy(*by).agg(F.countDistinct("v").alias("n")).where("n > 0").collect()}
        assert got == want


def test_guards_read_a_dimension_once(spark):
    good = spark.createDataFrame([("a", "x"), ("b", "y"), (None, None), (None, None)], "k string, v string")
    rows = spark.createDataFrame([("a",), ("c",)], "k string")
    joined = rows.join(guarded(good, ["k"], "names", True), "k", "left")
    assert sorted((r.k, r.v) for r in joined.collect()) == [("a", "x"), ("c", None)]
    assert "Window" not in plan_of(joined)
    for bad, message in (([("a", "x"), ("a", "y")], "repeats"), ([("a%", "x")], "wildcards")):
        dim = spark.createDataFrame(bad, "k string, v string")
        with pytest.raises(PySparkException, match=message):
            rows.join(guarded(dim, ["k"], "names", True), "k", "left").collect()


def test_rejected_and_late_rows_are_kept(spark, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "aside")
    schema = "k int, v int, day date"
    day = lambda n: dt.date(2026, 1, n)
    batches = [
        [(1, 5, day(10)), (2, None, day(1)), (3, 7, day(2))],
        [(4, 1, day(4)), (5, 2, day(3)), (6, -1, day(1)), (7, 3, None)],
        [(8, 1, day(31))],
        [(9, 1, day(20)), (10, 1, day(30))],
    ]
    reasons = lambda _: {"missing": F.col("v").isNull(), "negative": F.col("v") < 0}
    step = ingest.sorted_step(table, ["k"], "feed one", kept, reasons, "day", 6)
    for n, batch in enumerate(batches):
        for _ in range(2):  # a replay changes nothing
            step(spark.createDataFrame(batch, schema), n)
    merged = {r.k for r in snapshots.read_snapshot(spark, table).collect()}
    held = {(r.k, r.reason, r.batch) for r in ingest.read_aside(spark, kept).collect()}
    assert merged == {1, 3, 4, 7, 8, 10}
    assert held == {(2, "missing", 0), (5, "late", 1), (6, "negative", 1), (9, "late", 3)}
    assert len(merged) + len(held) == sum(map(len, batches))
