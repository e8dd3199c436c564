import pytest
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import epi_calendar
from labwatch.plans import quality as Q

COLUMNS = "k string, test_kit string, age int, " + ", ".join(f"{c} string" for c in vocab.RESULT_COLUMNS)


def sample(spark, *rows):
    """(key, kit, age, {pathogen: result}); other pathogens are NT."""
    data = [(k, kit, age, *[results.get(p, "NT") for p in vocab.PATHOGENS]) for k, kit, age, results in rows]
    return spark.createDataFrame(data, COLUMNS)


TRIPLE = {"DENV": "Pos", "ZIKV": "Neg", "CHIKV": "Neg"}


def test_kit_agreement(spark):
    df = sample(
        spark,
        ("ok", "arbo_pcr_3", 1, TRIPLE),
        ("missing", "arbo_pcr_3", 1, {"DENV": "Pos", "ZIKV": "Neg"}),
        ("extra", "arbo_pcr_3", 1, {**TRIPLE, "YFV": "Neg"}),
        ("igm", "igm_serum", 1, {"OROV": "Neg"}),
        ("empty", "igm_serum", 1, {}),
        ("ns1", "ns1_antigen", 1, {"ZIKV": "Pos"}),
        ("wnv", "wnv_pcr", 1, {"WNV": "Pos"}),
        ("other", "UNKNOWN", 1, {}),
    )
    assert sorted(r.k for r in Q.failing(df, Q.kit_disagrees()).collect()) == ["empty", "extra", "missing", "ns1"]
    assert sorted(r.k for r in Q.failing(df, Q.no_result_text()).collect()) == ["empty", "other"]


def coded(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} int" for c in vocab.RESULT_COLUMNS))


def test_coded_results(spark):
    df = coded(spark, [1, -1, -1, -1, -1, -1, -1], [0, -1, -1, -1, -1, -1, -1], [1, 1, -1, -1, -1, -1, -1], [-1] * 7, [None, -1, -1, -1, -1, -1, -1])
    assert Q.failing(df, Q.not_exactly_one_result()).count() == 2
    assert Q.failing(df, Q.no_result_coded()).count() == 1


def test_table_checks_pass_and_fail(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3)], "k string, v int")
    ok = df.filter("v = 1")
    assert Q.repeated_values(df, "k").collect()[0].n == 2 and Q.repeated_values(ok, "k").isEmpty()
    assert Q.unexpected_values(df, "k", ["a"]).count() == 1 and Q.unexpected_values(ok, "k", ["a"]).isEmpty()
    assert [r.k for r in Q.orphans(df, "k", ok, "k").collect()] == ["b"]
    assert Q.not_null_share(df, "v", 0.8).first().share == 0.75 and Q.not_null_share(df, "v", 0.75).isEmpty()
    assert Q.unequal_counts(df, ok).first().rows_a == 4 and Q.unequal_counts(df, df).isEmpty()
    assert Q.missing_columns(df, ["k", "z"]) == ["z"]
    assert Q.wrong_length(df, "k", 1).isEmpty() and Q.wrong_length(df, "k", 2).count() == 3
    assert Q.too_many_repeats(df, ["k"], 0).first().repeated_sets == 1 and Q.too_many_repeats(df, ["k"], 1).isEmpty()
    assert Q.distinct_share_outside(df, ["k"], 0.8, 1).first().ratio == 0.75
    # An empty table passes.
    assert Q.distinct_share_outside(df.limit(0), ["k"], 0.8, 1).isEmpty()
    assert Q.fewer_rows_than(df, 5).count() == 1 and Q.fewer_rows_than(df.limit(0), 0).isEmpty()
    assert {r.k for r in Q.repetitions_outside(df, "k", 2, 3).collect()} == {"b", None}
    assert Q.failing(df, Q.outside("v", 2, 2)).count() == 2
    assert Q.failing(df, Q.violates("v > 1")).count() == 2
    assert Q.failing(df, Q.is_null("v"), "k = 'a'").isEmpty()
    assert Q.group_sizes_other_than(df, "k", [1]).first().count_lines == 2


def test_dates_and_volume(spark):
    df = spark.createDataFrame([("2026-01-02",)] * 3 + [("2025-12-20",)], "d string").select(F.col("d").cast("date").alias("date_testing"))
    assert Q.stale(df, "date_testing", "2026-01-08").count() == 1 and Q.stale(df, "date_testing", "2026-01-07").isEmpty()
    volume = Q.weekly_volume(df, epi_calendar(spark), "2026-01-10")
    counts = {r.epiweek_number: r.test_count for r in volume.collect()}
    # Weeks that started in the last 30 days, empty ones included.
    assert counts == {51: 1, 52: 0, 53: 3, 1: 0}
    assert Q.weekly_volume_outside(df, epi_calendar(spark), "2026-01-10", 1, 3).count() == 2


def test_line_counts(spark):
    lines = spark.range(5)
    assert Q.line_counts_exceed(spark.createDataFrame([(6,)], "qty_original_lines long"), lines).first().diff_qty_lines == 1
    assert Q.line_counts_exceed(spark.createDataFrame([(4,)], "qty_original_lines long"), lines).isEmpty()


def test_state_names(spark):
    df = spark.createDataFrame([("SAO PAULO",), ("NOT REPORTED",), ("Sao Paulo",), (None,)], "s string")
    assert [r.s for r in Q.failing(df, Q.unknown_state("s")).collect()] == ["Sao Paulo"]


def test_suite_levels(spark):
    df = sample(spark, ("a", "x", 200, {}), ("b", "x", 300, TRIPLE), ("b", "x", 5, TRIPLE))
    checks = [
        Q.Check("fine", Q.is_null("k")),
        Q.Check("tolerated", Q.outside("age", 0, 120), warn_above=2),
        Q.Check("warned", Q.outside("age", 0, 120), error_above=5),
        Q.Check("broken", Q.outside("age", 0, 120), where="k = 'b'"),
        Q.Check("soft", Q.outside("age", 0, 120), severity="warn"),
        Q.Check("unique", query=Q.repeated_values(df, "k")),
    ]
    report = Q.run_checks(df, checks)
    assert {r["check"]: (r.failures, r.status) for r in report.collect()} == {
        "fine": (0, "pass"),
        "tolerated": (2, "error"),
        "warned": (2, "warn"),
        "broken": (1, "error"),
        "soft": (2, "warn"),
        "unique": (1, "error"),
    }
    with pytest.raises(Q.ChecksFailed, match="broken"):
        Q.require(spark, report)
    assert Q.require(spark, Q.run_checks(df, checks[:1])).count() == 1
