import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labwatch.functions import dates as D
from labwatch.functions import results as R
from labwatch.functions import text as X


def values(spark, rows, column, dtype="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {dtype}")
    return [r[0] for r in df.select("i", column.alias("x")).orderBy("i").select("x").collect()]


def test_normalize_text(spark):
    rows = ["  São José ", "\\Ação\\", "a\tb", "straße", None, " d'água-x "]
    assert values(spark, rows, X.normalize_text("v")) == ["SAO JOSE", "ACAO", "A\tB", "STRASSE", None, "D'AGUA-X"]


def test_punctuation_and_place_key(spark):
    rows = ["Ji-Paraná", "D'Oeste, 1", None]
    assert values(spark, rows, X.drop_punctuation("v")) == ["JIPARANA", "DOESTE 1", None]
    assert values(spark, rows, X.place_key("v")) == ["JI PARANA", "DOESTE 1", None]


def test_key_skips_null_and_has_no_separator(spark):
    df = spark.createDataFrame([("ab", None, "c"), ("a", "bc", None), ("abc", "", "")], "a string, b string, c string")
    keys = [r[0] for r in df.select(X.sample_key("a", "b", "c")).collect()]
    assert len(set(keys)) == 1


def test_state_names(spark):
    rows = ["SP", "PA", "XX", None]
    assert values(spark, rows, X.state_name("v")) == ["SAO PAULO", "PARA", None, None]
    assert values(spark, rows, X.state_name("v", "missing"))[2:] == ["NOT REPORTED", "NOT REPORTED"]
    assert values(spark, rows, X.state_name("v", "keep"))[2:] == ["XX", None]


def test_numeric_results(spark):
    rows = ["0,79", "0,80", "1", ",5", ".99", "1:200", "1,2,3", "REAGENTE", None]
    assert values(spark, rows, R.cutoff_result("v")) == [0, 1, 1, 0, 1, -2, -2, None, None]


def test_bands(spark):
    rows = [0.79, 0.80, 1.00, 1.01, None]
    assert values(spark, rows, R.band_result(F.col("v"), 0.8, 1.0, -3, -2), "double") == [0, -3, -3, 1, -2]
    rows = [0.89, 0.90, 1.10, 1.11]
    assert values(spark, rows, R.band_result(F.col("v"), 0.9, 1.1, None), "double") == [0, None, None, 1]


def test_age_text(spark):
    rows = ["5", "10A", "20A10M", "10A5D", "11M", "30D", "5M", None, ""]
    assert values(spark, rows, R.age_days_years("v")) == [5, 10, 20, 0, None, 0, None, None, None]
    assert values(spark, rows, R.age_units("v")) == [5, 10, 20, 10, 0, 0, 0, None, None]


@pytest.mark.parametrize(
    "later, earlier, years",
    [
        ("2023-02-28", "2000-02-29", 22),
        ("2023-03-01", "2000-02-29", 23),
        ("2020-05-05", "2020-05-05", 0),
        ("2000-01-01", "2001-06-01", -1),
        ("2000-01-01", "2000-06-01", 0),
        ("2024-01-01", "1900-01-01", 124),
    ],
)
def test_completed_years(spark, later, earlier, years):
    row = spark.range(1).select(D.completed_years(F.lit(later).cast("date"), F.lit(earlier).cast("date"))).first()
    assert row[0] == years


def weeks_of(year):
    """Sundays of an epidemiological year: week 1 holds 4 January."""
    def first(y):
        day = dt.date(y, 1, 4)
        while day.isoweekday() != 7:
            day -= dt.timedelta(days=1)
        return day

    day, out = first(year), []
    while day < first(year + 1):
        out.append(day)
        day += dt.timedelta(days=7)
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 10), dt.date(2060, 1, 1)), min_size=20, max_size=60))
def test_epi_week_matches_counting(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for row in df.select("d", D.epi_week("d").alias("w")).collect():
        start = row.w.start
        assert start.isoweekday() == 7 and start <= row.d <= row.w.end
        assert weeks_of(row.w.year)[row.w.week - 1] == start


def test_epi_calendar(spark):
    rows = D.epi_calendar(spark).collect()
    assert len(rows) == 522
    per_year = {}
    for r in rows:
        per_year[r.year] = max(per_year.get(r.year, 0), r.week_num)
    assert {y for y, n in per_year.items() if n == 53} == {2020, 2025}


def test_epi_edges(spark):
    rows = [dt.date(2025, 12, 27), dt.date(2025, 12, 28), dt.date(2026, 1, 3), dt.date(2026, 1, 4), None]
    assert values(spark, rows, D.epi_label("v"), "date")[:4] == ["SE52.2025", "SE53.2025", "SE53.2025", "SE01.2026"]
    assert values(spark, rows, D.epi_week("v"), "date")[4] is None


def test_align_leap_day(spark):
    assert values(spark, [dt.date(2024, 2, 29), dt.date(2024, 3, 1)], D.align_year("v"), "date") == [
        dt.date(2022, 2, 28),
        dt.date(2022, 3, 1),
    ]


def test_dates_single_digits(spark):
    rows = ["5/3/2024", "05/03/2024", "2024-03-05 00:00:00", "x", None]
    day = dt.date(2024, 3, 5)
    out = values(spark, rows, D.try_date("v", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss"))
    assert out == [day, day, day, None, None]


def test_encoding_repair(spark):
    rows = ["SÃ£o Paulo", "São Paulo", "Ã", None]
    assert values(spark, rows, X.repair_encoding("v")) == ["São Paulo", "São Paulo", "Ã", None]


def test_local_stamp_is_without_zone(spark):
    df = spark.range(1).select(D.local_stamp().alias("now"), D.local_stamp("2026-01-02 03:04:05").alias("fixed"))
    assert dict(df.dtypes) == {"now": "timestamp_ntz", "fixed": "timestamp_ntz"}
    assert df.first().fixed == dt.datetime(2026, 1, 2, 3, 4, 5)
