"""Dates, ages and epidemiological weeks (Sunday to Saturday)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.text import col, label, two_digits


def try_date(c: Column | str, *formats: str) -> Column:
    """First format that parses, else NULL."""
    return F.coalesce(*[F.try_to_date(col(c), fmt) for fmt in formats])


def completed_years(later: Column | str, earlier: Column | str) -> Column:
    """Completed years between two dates, truncated toward zero when the order is reversed."""
    def number(d: Column) -> Column:
        return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)

    return ((number(col(later)) - number(col(earlier))) / 10000).cast("int")


def week_start(d: Column | str) -> Column:
    d = col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(d: Column | str) -> Column:
    return F.date_add(week_start(d), 6)


def epi_year(d: Column | str) -> Column:
    """Year of the Wednesday of the week."""
    return F.year(F.date_add(week_start(d), 3))


def epi_number(d: Column | str) -> Column:
    """Week number; week 1 holds 4 January."""
    first = week_start(F.make_date(epi_year(d), F.lit(1), F.lit(4)))
    return (F.datediff(week_start(d), first) / 7).cast("int") + 1


def epi_week(d: Column | str) -> Column:
    d = col(d)
    whole = F.struct(
        epi_year(d).alias("year"),
        epi_number(d).alias("week"),
        week_start(d).alias("start"),
        week_end(d).alias("end"),
    )
    return F.when(d.isNotNull(), whole)


def epi_label(d: Column | str, pad: int = 2) -> Column:
    """``SE{number}.{year}``."""
    return label("SE", F.lpad(epi_number(d).cast("string"), pad, "0"), ".", epi_year(d))


def epi_month_name(number: Column | str) -> Column:
    """Month abbreviation a week number is shown under; NULL below 1."""
    number = col(number)
    out = F.lit(None).cast("string")
    for name, first in reversed(list(zip(vocab.MONTHS, vocab.MONTH_FIRST_WEEK))):
        following = [w for w in vocab.MONTH_FIRST_WEEK if w > first]
        inside = number >= first
        if following:
            inside = inside & (number < following[0])
        out = F.when(inside, name).otherwise(out)
    return out


def month_name(d: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in vocab.MONTHS]), F.month(col(d)))


def year_month(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def quarter_label(d: Column | str) -> Column:
    d = col(d)
    return F.when(d.isNotNull(), label(F.year(d), " - ", F.quarter(d), "º Trimestre"))


def align_year(d: Column | str, year: int = 2022) -> Column:
    """The same month and day in ``year``; 29 February falls to 28 where ``year`` has none."""
    d = col(d)
    day = F.least(F.day(d), F.day(F.last_day(F.make_date(F.lit(year), F.month(d), F.lit(1)))))
    return F.make_date(F.lit(year), F.month(d), day)


def week_month_label(number: Column, end: Column | None = None) -> Column:
    """``SEnn - Mon``, or ``SEnn - MonYY`` when the week's last day is given."""
    parts = ["SE", two_digits(number), " - ", epi_month_name(number)]
    if end is not None:
        parts.append(F.date_format(end, "yy"))
    return label(*parts)


def local_stamp(as_of: str | None = None) -> Column:
    """Wall-clock time of the laboratories' zone, or a fixed stamp."""
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(vocab.LOCAL_ZONE), F.current_timestamp()).cast("timestamp_ntz")


def epi_calendar(spark: SparkSession, first_year: int = 2018, last_year: int = 2027) -> DataFrame:
    """One row per epidemiological week of the given years."""
    days = F.sequence(
        F.date_sub(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), 7),
        F.date_add(F.make_date(F.lit(last_year), F.lit(12), F.lit(31)), 7),
        F.expr("interval 1 day"),
    )
    day = F.col("day")
    return (
        spark.range(1)
        .select(F.explode(days).alias("day"))
        .filter(F.dayofweek(day) == 1)
        .select(
            epi_year(day).alias("year"),
            epi_number(day).alias("week_num"),
            F.date_add(day, 6).alias("end_date"),
            day.alias("start_date"),
        )
        .filter(F.col("year").between(first_year, last_year))
    )
