import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.operators import aggregates as A
from labwatch.operators import joins as J
from labwatch.operators import merge as M
from labwatch.operators import windows as W
from labwatch.operators.shaping import one_hot, rejected_rows, result_text, unpivot_results
from labwatch.plans.combine import Dimensions, add_age_group, add_epiweek, enrich, fix_place
from labwatch.sources.dims import age_groups

RESULTS = vocab.RESULT_COLUMNS


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def lines(spark, rows):
    """(sample, analyte, result, note) -> coded lines."""
    df = spark.createDataFrame(rows, "sample_id string, analyte string, result int, note string")
    return df.select("*", *one_hot("analyte", "result", {p: [p] for p in vocab.PATHOGENS}))


def plan(df):
    return df._jdf.queryExecution().toString()


def test_propagation_rules(spark):
    rows = [
        ("a", "DENV", 1, "x"),
        ("a", "DENV", 0, "y"),
        ("a", "ZIKV", 0, "z"),
        ("b", "DENV", 0, "x"),
        ("c", "DENV", -2, "x"),
        ("d", "DENV", None, "x"),
        ("d", "ZIKV", 1, "x"),
        ("e", "DENV", None, "x"),
    ]
    out = {r.sample_id: r for r in W.collapse_samples(lines(spark, rows), "sample_id", ["note"]).collect()}
    assert (out["a"].denv_test_result, out["a"].zikv_test_result, out["a"].chikv_test_result) == ("Pos", "Neg", "NT")
    assert out["a"].qty_original_lines == 3 and out["a"].note == "x"
    assert out["b"].denv_test_result == "Neg"
    # Not recognised and missing results are no result at all, not "not tested".
    assert out["c"].denv_test_result is None
    assert out["d"].denv_test_result == "NT" and out["d"].zikv_test_result == "Pos"
    assert out["e"].denv_test_result is None


LINE = st.tuples(
    st.sampled_from("abcd"),
    st.sampled_from(vocab.PATHOGENS),
    st.sampled_from([1, 0, -2, None]),
    st.sampled_from(["p", "q", None]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(LINE, min_size=1, max_size=30))
def test_collapse_equals_stages(spark, rows):
    df = lines(spark, rows)
    fused = W.collapse_samples(df, "sample_id", ["note"])
    staged = W.dedupe(W.propagate(df.select("sample_id", "note", *RESULTS)), ["sample_id"], ["note"])
    assert rows_of(fused.select("sample_id", "note", *RESULTS)) == rows_of(staged.select("sample_id", "note", *RESULTS))


def test_hot_keys_take_the_broadcast_way(spark):
    # One key holds most of the rows, one is NULL.
    df = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2500, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("k"),
        "id",
    )
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    out = J.join_back(df, stats, ["k"], "n", floor=100).collect()
    assert len(out) == 3000
    by_key = {}
    for r in out:
        by_key.setdefault(r.k, []).append(r)
    for key, found in by_key.items():
        assert {r.n for r in found} == {len(found)} and {r.top for r in found} == {max(r.id for r in found)}


def test_redundant_analytes(spark):
    rows = [
        ("t1", "DENGIGG"), ("t1", "DENGUEGI"),
        ("t2", "DENGUEGI"),
        ("t3", "DENGIGG"), ("t3", "DENGUEGI"), ("t3", "DENGUEGI"),
        ("t4", None), ("t4", "NS1IMUNOCRO"), ("t4", "NS1ELISA"),
        (None, "DENGIGG"), (None, "DENGUEGI"),
    ]
    df = spark.createDataFrame(rows, "test string, code string")
    pairs = [("DENGIGG", "DENGUEGI"), ("NS1ELISA", "NS1IMUNOCRO")]
    for floor in (J.HOT_FLOOR, 0):
        out = rows_of(W.drop_redundant(df, "test", "code", pairs, floor))
        kept = [("t1", "DENGIGG"), ("t2", "DENGUEGI"), *rows[3:6], ("t4", None), ("t4", "NS1ELISA"), (None, "DENGIGG")]
        assert out == sorted(kept, key=str)


def test_dedupe_is_deterministic_and_limits_before_the_shuffle(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "x"), ("b", None, "z"), (None, 1, "n"), (None, 0, "n")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = W.dedupe(df, ["k"])
    assert rows_of(out) == sorted([("a", 1, "x"), ("b", None, "z"), (None, 0, "n")], key=str)
    assert plan(out).count("WindowGroupLimit") >= 2


def test_age_bands(spark):
    ages = [-1, 0, 4, 5, 79, 80, 1000, 1001, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    expected = ["00-04", "00-04", "00-04", "05-09", "70-79", "80+", "80+", None, None]
    joined = J.band_join(df, age_groups(spark), "age", "min_age", "max_age", width=10)
    assert dict(joined.select("age", "age_group").collect()) == dict(zip(ages, expected))
    assert dict(add_age_group(df).collect()) == dict(zip(ages, expected))
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)


def test_weeks_outside_the_calendar(spark):
    days = [dt.date(2017, 12, 30), dt.date(2017, 12, 31), dt.date(2028, 1, 1), dt.date(2028, 1, 2), None]
    df = spark.createDataFrame([(d,) for d in days], "date_testing date")
    out = [r.epiweek_number for r in add_epiweek(df).collect()]
    assert out == [None, 1, 52, None, None]


def test_pattern_join(spark):
    df = spark.createDataFrame([("São",), ("sao paulo",), ("x_y",), (None,)], "name string")
    literal = spark.createDataFrame([("SAO PAULO", 1), (None, 2)], "p string, v int")
    joined = J.pattern_join(df, literal, {"name": "p"})
    assert dict((r.name, r.v) for r in joined.collect()) == {"São": None, "sao paulo": 1, "x_y": None, None: None}
    assert "NestedLoop" not in plan(joined)
    wild = spark.createDataFrame([("%A%", 1), ("s_o%", 2)], "p string, v int")
    out = J.pattern_join(df, wild, {"name": "p"})
    assert rows_of(out.select("name", "v")) == sorted(
        [("sao paulo", 1), ("sao paulo", 2), ("São", 2), ("x_y", None), (None, None)], key=str
    )
    assert rows_of(J.pattern_join(df, wild, {"name": "p"}, how="inner").select("v")) == [(1,), (2,), (2,)]


def places(spark):
    names = ["NM_MUN_NORM", "NM_UF_NORM", "NM_MUN", "NM_UF", "REGIAO", "SIGLA_UF", "CD_UF", "CD_MUN", "lat", "long"]
    cities = spark.createDataFrame(
        [("NOVA", "GOIAS", "Nova", "Goiás", "CENTRO-OESTE", "GO", 52, 1, 0.5, 1.5), ("VELHA", "PARA", "Velha", "Pará", "NORTE", "PA", 15, 2, 2.5, 3.5)],
        names,
    )
    macro = spark.createDataFrame([(52, "BR1", "M", "5201", "GO", 10)], "CO_UF int, ADM2_PCODE string, DS_NOMEPAD_macsaud string, CO_MACSAUD string, DS_UF_SIGLA string, Populacao int")
    states = spark.createDataFrame([("CAPITAL", "GOIAS", "")], "source_state string, target_state string, description string")
    towns = spark.createDataFrame(
        [("NVA", "GOIAS", "NOVA", ""), ("BAIRRO", "CAPITAL", "NOVA", ""), (None, "PARA", "VELHA", "")],
        "source_location string, source_state string, target_location string, description string",
    )
    return Dimensions(cities, macro, states, towns)


PLACES = [("nvá", "capital"), ("Bairro", "Capital"), ("Velha", "pará"), ("nova", "para"), (None, "PARA"), ("longe", None)]


def test_place_repair(spark):
    dims = places(spark)
    df = spark.createDataFrame(PLACES, "location string, state string")
    fixed = rows_of(fix_place(df, dims.fix_state, dims.fix_location))
    assert fixed == sorted(
        [("NOVA", "GOIAS"), ("NOVA", "GOIAS"), ("VELHA", "PARA"), ("NOVA", "PARA"), (None, "PARA"), ("LONGE", None)], key=str
    )


def test_enrich_at_any_dimension_size(spark):
    dims = places(spark)
    df = spark.createDataFrame([(i, 30, dt.date(2024, 1, 1), *p) for i, p in enumerate(PLACES)], "id int, age int, date_testing date, location string, state string")
    small = enrich(df, dims)
    columns, rows = small.columns, rows_of(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich(df, dims)
        assert large.columns == columns and rows_of(large) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {r.id: (r.location, r.macroregion, r.region) for r in small.collect()}
    assert got[0] == ("Nova", "M", "Centro-Oeste") and got[2] == ("Velha", None, "Norte") and got[3] == (None, None, None)
    assert "NestedLoop" not in plan(small)


def test_repeated_dimension_key_stops(spark):
    dims = places(spark)
    df = spark.createDataFrame([(i, 30, dt.date(2024, 1, 1), *p) for i, p in enumerate(PLACES)], "id int, age int, date_testing date, location string, state string")
    doubled = Dimensions(dims.municipalities.unionAll(dims.municipalities), dims.macroregions, dims.fix_state, dims.fix_location)
    with pytest.raises(Exception, match="repeats"):
        enrich(df, doubled).collect()
    # A single wildcard in the last of many rows is found.
    schema = dims.fix_state.schema
    many = spark.range(120_000).select(F.concat(F.lit("Q"), F.col("id").cast("string")).alias("a"))
    rows = many.select(*[(F.col("a") if f.name == "source_state" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    wild = rows.unionByName(dims.fix_state.limit(1).withColumn("source_state", F.lit("CAP%")))
    with pytest.raises(Exception, match="wildcards"):
        enrich(df, Dimensions(dims.municipalities, dims.macroregions, wild, dims.fix_location)).collect()


def test_positivity_minimum(spark):
    rows = [(g, "Pos" if i < pos else "Neg") for g, n, pos in (("a", 49, 1), ("b", 50, 5), ("c", 51, 0)) for i in range(n)]
    rows += [("d", "NT")] * 60 + [("d", None)]
    out = {r.k: r for r in A.positivity(spark.createDataFrame(rows, "k string, result string"), ["k"]).collect()}
    assert out["a"].posrate is None and out["b"].posrate == 0.1 and out["c"].posrate == 0.0
    assert (out["d"].totaltests, out["d"].posrate) == (0, None)


def test_recency_edges(spark):
    newest = dt.date(2026, 1, 3)
    days = [newest - dt.timedelta(days=n) for n in (0, 363, 364, 365)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows_of(W.recent_days(df, "d", 364)) == sorted([(days[0],), (days[1],)], key=str)
    assert rows_of(W.last_period(df, "d")) == [(newest,)]
    months = spark.createDataFrame([(m,) for m in ["2024-01", "2024-02", "2024-02", "2024-03"]], "m string")
    assert rows_of(W.recent_periods(months, "m", 2)) == [("2024-02",), ("2024-02",), ("2024-03",)]
    assert W.recent_periods(months, "m", 12).count() == 4


def test_grid_and_running_total(spark):
    facts = spark.createDataFrame([(1, "x", 2), (3, "x", 1), (2, "y", 5)], "w int, p string, n long")
    grid = J.dense_grid(facts, "w", facts.select("w"), ["p"], ["n"])
    total = W.running_total(grid, ["p"], "w", "n", "t")
    got = {(r.p, r.w): (r.n, r.t) for r in total.collect()}
    assert got == {("x", 1): (2, 2), ("x", 2): (0, 2), ("x", 3): (1, 3), ("y", 1): (0, 0), ("y", 2): (5, 5), ("y", 3): (0, 5)}
    assert "NestedLoop" not in plan(grid) and "Cartesian" not in plan(grid)
    open_grid = J.dense_grid(facts, "w", facts.select("w"), ["p"], ["n"], fill=None)
    assert {r.n for r in open_grid.filter("p = 'y' and w = 1").collect()} == {None}


def test_completeness_edges(spark):
    days = [dt.date(2020, 1, 4) + dt.timedelta(days=7 * i) for i in range(100)]
    rows = [(d, "full", 1.0) for d in days]
    rows += [(d, "edge", 1.0 if i < 70 else None) for i, d in enumerate(days)]
    rows += [(d, "gone", 1.0) for d in days[:20]]
    df = spark.createDataFrame(rows, "w date, s string, v double")
    got = {r.s: r for r in A.completeness(df, "s", "w", "v").collect()}
    assert got["full"].final_class == "Alta qualidade"
    # Exactly 0.7 counts as good.
    assert got["edge"].h == 0.7 and got["edge"].history_class == "Bom Histórico" and got["edge"].final_class == "Apenas histórico"
    # A state without rows in the last year falls to the last class.
    assert got["gone"].y is None and got["gone"].final_class == "Apenas 12 meses"


def test_rate_without_population(spark):
    df = spark.createDataFrame([(5, 1000), (5, 0), (5, None)], "n long, p int")
    assert [r[0] for r in df.select(A.per_100k("n", "p")).collect()] == [500.0, None, None]


def test_pivots_keep_empty_keys_at_any_width(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "z", 2)], "k string, c string, v int")
    out = {r.k: (r.x, r.y) for r in A.pivot_fixed(df, ["k"], "c", {"x": "x", "y": "y"}, "v", fill=0).collect()}
    assert out == {"a": (1, 0), "b": (0, 0)}
    wide = spark.range(600).select(F.lit("a").alias("k"), F.concat(F.lit("c"), "id").alias("c"), F.col("id").alias("v"))
    assert len(A.pivot_observed(wide, ["k"], "c", "v").columns) == 601


def test_wildcards_in_any_number(spark):
    df = spark.createDataFrame([("abc1",), ("zzz",)], "name string")
    many = spark.range(6000).select(F.concat(F.lit("q"), F.col("id").cast("string"), F.lit("%")).alias("p"), "id")
    dim = many.unionByName(spark.createDataFrame([("AB_1", 7000), ("%1", 7001)], "p string, id long"))
    out = J.pattern_join(df, dim, {"name": "p"})
    assert rows_of(out.select("name", "id")) == sorted([("abc1", 7000), ("abc1", 7001), ("zzz", None)], key=str)


def stamped(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, v int, created_at string")


def test_upsert(spark):
    target = stamped(spark, [("k1", "x", 1, "old"), ("k2", "x", 2, "old"), (None, "x", 3, "old"), ("k4", "x", 4, None)])
    source = stamped(spark, [("k1", "x", 10, "new"), ("k3", "x", 30, "new"), (None, "x", 31, "new"), ("k4", "x", 40, "new")])
    once = M.upsert(target, source, ["a", "b"])
    assert rows_of(once) == sorted(
        [("k1", "x", 10, "old"), ("k2", "x", 2, "old"), ("k3", "x", 30, "new"), ("k4", "x", 40, None), (None, "x", 3, "old"), (None, "x", 31, "new")],
        key=str,
    )
    keyed = source.filter("a is not null")
    again = M.upsert(M.upsert(target, keyed, ["a", "b"]), keyed, ["a", "b"])
    assert rows_of(again) == rows_of(M.upsert(target, keyed, ["a", "b"]))
    with pytest.raises(ValueError, match="repeats"):
        M.upsert(target, keyed.unionAll(keyed), ["a", "b"])


def test_release_diff(spark):
    old = spark.createDataFrame([("0000012",), ("13",), (None,)], "id string")
    new = spark.createDataFrame([("12",), ("14",), ("14",)], "id string")
    assert dict(M.release_diff(old, new, "id", M.strip_zero_prefix).collect()) == {"12": "kept", "13": "removed", "14": "added", None: "removed"}


def test_rejected_rows(spark):
    df = spark.createDataFrame([("1", "x"), ("y", "2"), (None, None), ("5", "6")], "a string, b string")
    out = rejected_rows(df, {"a": ("a", "int"), "b": ("b", "int")})
    assert [tuple(r.rejected_columns) for r in out.collect()] == [("b",), ("a",)]


def test_unpivot_keeps_missing_results(spark):
    df = spark.createDataFrame([("s", "Pos", *[None] * 6)], "id string, " + ", ".join(f"{c} string" for c in RESULTS))
    out = unpivot_results(df, ["id"])
    assert out.count() == 7 and out.filter("result is null").count() == 6
    assert spark.range(1).select(result_text(F.lit(-2)).alias("x")).first().x is None
