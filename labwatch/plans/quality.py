"""Data-quality checks. Each returns its failing rows (or one summary row); empty means pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwatch import vocab
from labwatch.functions.text import col, state_names
from labwatch.operators.aggregates import distinct_ratio
from labwatch.operators.shaping import tested

# Which pathogens a kit must report.
ALL_SEROLOGY = ["DENV", "ZIKV", "CHIKV", "MAYV", "OROV", "YFV", "WNV"]
SINGLE_TARGET = {
    "denv_serum": "DENV",
    "ns1_antigen": "DENV",
    "denv_pcr": "DENV",
    "zikv_pcr": "ZIKV",
    "chikv_pcr": "CHIKV",
    "mayv_pcr": "MAYV",
    "orov_pcr": "OROV",
    "wnv_pcr": "WNV",
    "yfv_pcr": "YFV",
}
TRIPLE = ["DENV", "ZIKV", "CHIKV"]
NOT_IN_TRIPLE = ["MAYV", "WNV", "OROV", "YFV"]


# --- conditions: a failing row satisfies them -----------------------------------------------


def is_null(c: str) -> Column:
    return F.col(c).isNull()


def outside(c: str, low=None, high=None) -> Column:
    """Inclusive range; NULL passes."""
    out = F.lit(False)
    if low is not None:
        out = out | (F.col(c) < low)
    if high is not None:
        out = out | (F.col(c) > high)
    return out


def not_in(c: str, values: Iterable) -> Column:
    return ~F.col(c).isin(*values)


def violates(expression: str | Column) -> Column:
    """The expression must be true; NULL counts as a violation."""
    value = F.expr(expression) if isinstance(expression, str) else expression
    return ~F.coalesce(value, F.lit(False))


def unknown_state(c: str) -> Column:
    return not_in(c, [*state_names(), vocab.MISSING])


def none_of(columns: Iterable[str], value) -> Column:
    """Every column holds ``value``, the mark of an untested pathogen."""
    return reduce(lambda a, b: a & b, [F.col(c) == F.lit(value) for c in columns])


def all_results(value) -> Column:
    return none_of(vocab.RESULT_COLUMNS, value)


def no_result_coded() -> Column:
    return all_results(vocab.NOT_TESTED)


def no_result_text() -> Column:
    return all_results("NT")


def not_exactly_one_result() -> Column:
    """Six untested pathogens and one 0 or 1 add up to -6 or -5."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in vocab.RESULT_COLUMNS])
    return ~total.isin(-6, -5)


def kit_disagrees() -> Column:
    """The tested pathogens do not fit the kit."""
    kit = F.col("test_kit")

    def has(p: str) -> Column:
        return tested(vocab.RESULT_OF[p])

    def absent(p: str) -> Column:
        return F.col(vocab.RESULT_OF[p]) == "NT"

    triple = reduce(lambda a, b: a & b, [has(p) for p in TRIPLE] + [absent(p) for p in NOT_IN_TRIPLE])
    serology = reduce(lambda a, b: a | b, [has(p) for p in ALL_SEROLOGY])
    out = ((kit == "arbo_pcr_3") & ~triple) | (kit.isin("igg_serum", "igm_serum") & ~serology)
    for name, pathogen in SINGLE_TARGET.items():
        out = out | ((kit == name) & ~has(pathogen))
    return out


# --- checks on whole tables -----------------------------------------------------------------


def failing(df: DataFrame, condition: Column, where: str | Column | None = None) -> DataFrame:
    if where is not None:
        df = df.filter(where)
    return df.filter(condition)


def repeated_values(df: DataFrame, *key: str | Column) -> DataFrame:
    """Non-NULL keys that occur more than once."""
    named = [col(k).alias(f"key{i}") for i, k in enumerate(key)]
    rows = df.select(*named).filter(F.coalesce(*[F.col(f"key{i}").cast("string") for i in range(len(key))]).isNotNull())
    names = [f"key{i}" for i in range(len(key))]
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unexpected_values(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter(not_in(c, values))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values without a parent. The distinct values are matched, not the rows."""
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return values.join(parent.select(F.col(key).alias("__key")), F.col(column) == F.col("__key"), "left_anti")


def not_null_share(df: DataFrame, c: str, at_least: float, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    share = F.try_divide(F.count(c).cast("double"), F.count(F.lit(1)))
    return rows.agg(share.alias("share")).filter(F.col("share") < at_least)


def unequal_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with both counts when they differ."""
    sides = a.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(b.select(F.lit(0), F.lit(1)))
    total = sides.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("rows_b"))
    return total.filter("rows_a <> rows_b")


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n not in df.columns]


def wrong_length(df: DataFrame, c: str, length: int) -> DataFrame:
    return df.filter(F.length(c) != length)


def too_many_repeats(df: DataFrame, columns: list[str], at_most: int) -> DataFrame:
    """Number of column sets that occur more than once, when it exceeds the limit."""
    sets = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return sets.agg(F.count(F.lit(1)).alias("repeated_sets")).filter(F.col("repeated_sets") > at_most)


def distinct_share_outside(df: DataFrame, columns: list[str], low: float, high: float) -> DataFrame:
    """Distinct share outside the range; an empty table passes."""
    return distinct_ratio(df, columns).filter((F.col("ratio") < low) | (F.col("ratio") > high))


def fewer_rows_than(df: DataFrame, n: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") < n)


def repetitions_outside(df: DataFrame, c: str, low: int, high: int) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter(~F.col("n").between(low, high))


def weekly_volume(df: DataFrame, calendar: DataFrame, as_of: str, date: str = "date_testing", days: int = 30) -> DataFrame:
    """Rows per epidemiological week that started in the last ``days``, empty weeks included.

    Rows are counted per day first; the few recent weeks are then spread over their days.
    """
    today = F.lit(as_of).cast("date")
    recent = calendar.filter(F.col("start_date").between(F.date_sub(today, days), today))
    spread = recent.withColumn("__day", F.explode(F.sequence("start_date", "end_date")))
    daily = df.groupBy(F.col(date).alias("__day")).agg(F.count(F.lit(1)).alias("__n"))
    return (
        spread.join(daily, "__day", "left")
        .groupBy(
            F.col("end_date").alias("epiweek_end_date"),
            F.col("start_date").alias("epiweek_start_date"),
            F.col("week_num").alias("epiweek_number"),
        )
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("test_count"))
    )


def weekly_volume_outside(df: DataFrame, calendar: DataFrame, as_of: str, low: int, high: int, **kw) -> DataFrame:
    return weekly_volume(df, calendar, as_of, **kw).filter(~F.col("test_count").between(low, high))


def line_counts_exceed(samples: DataFrame, lines: DataFrame, count: str = "qty_original_lines") -> DataFrame:
    """Sum of line counts above the number of upstream lines (fewer is allowed)."""
    sides = samples.select(F.col(count).cast("long").alias("n")).unionAll(lines.select(F.lit(-1).cast("long")))
    return sides.agg(F.sum("n").alias("diff_qty_lines")).filter("diff_qty_lines > 0")


def stale(df: DataFrame, date: str, as_of: str, days: int = 5) -> DataFrame:
    newest = df.agg(F.max(date).alias("newest"))
    return newest.filter(F.col("newest") < F.date_sub(F.lit(as_of).cast("date"), days))


def group_sizes_other_than(df: DataFrame, key: str, allowed: Iterable[int]) -> DataFrame:
    """Distinct group sizes that are not allowed."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("count_lines")).select("count_lines").distinct()
    return sizes.filter(~F.col("count_lines").isin(*allowed))


# --- suites ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Keys:
    """A check of how often the sets of some columns occur, failing in one of three ways."""

    columns: tuple[str, ...]
    # Every set with a value that occurs more than once is a failure (as ``repeated_values``),
    unique: bool = False
    # one failure where the share of distinct sets lies outside (as ``distinct_share_outside``),
    share: tuple[float, float] | None = None
    # or one where more sets than this occur more than once (as ``too_many_repeats``).
    at_most: int | None = None

    def failures(self) -> Column:
        sets, rows = F.col("sets"), F.col("rows")
        if self.unique:
            return F.col("repeated_values")
        if self.share is not None:
            return outside_share(sets / rows, *self.share)
        return (F.col("repeated") > self.at_most).cast("long")


def outside_share(ratio: Column, low: float, high: float) -> Column:
    return ((ratio < low) | (ratio > high)).cast("long")


@dataclass(frozen=True)
class Check:
    """What is counted as a failure; conditions and totals of a table run in one pass, and all keys in another."""

    name: str
    # A row fails that satisfies it.
    condition: Column | None = None
    # A query with its own plan, for what needs other tables.
    query: DataFrame | None = None
    where: str | Column | None = None
    # An aggregate over the table that gives the number of failures.
    total: Column | None = None
    keys: Keys | None = None
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0


REPORT = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


def key_sets(checks: list[Check]) -> list[tuple[str, ...]]:
    """The column lists of key checks, each once."""
    return list(dict.fromkeys(c.keys.columns for c in checks))


def key_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """``check, failures`` of all key checks: one scan and one shuffle of 128-bit fingerprints, one per list of columns.

    Tasks count fingerprints before they are shuffled, so a set that fills the table is a row per task. Fingerprints are
    numbers only, twice the list's place and whether any value is known.
    """
    lists = key_sets(checks)
    entries = []
    for place, columns in enumerate(lists):
        parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
        known = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
        prints = F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(place), *parts).alias("b")
        entries.append(F.struct((F.lit(2 * place) + known.cast("int")).alias("kind"), *prints))
    sets = df.select(F.inline(F.array(*entries))).groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    counted = sets.groupBy(F.shiftright("kind", 1).alias("place")).agg(
        F.count(F.lit(1)).alias("sets"),
        F.sum("n").alias("rows"),
        F.count_if(F.expr("n > 1")).alias("repeated"),
        F.count_if(F.expr("n > 1 and kind % 2 = 1")).alias("repeated_values"),
    )
    of_checks = [
        F.struct(F.lit(c.name).alias("check"), F.lit(lists.index(c.keys.columns)).alias("of"), c.keys.failures().alias("n"))
        for c in checks
    ]
    told = counted.select("place", F.inline(F.array(*of_checks))).where("place = of")
    # A table without rows has no sets, so all its checks pass.
    names = F.array(*[F.lit(c.name) for c in checks])
    found = told.agg(F.map_from_entries(F.collect_list(F.struct("check", "n"))).alias("found"))
    return found.select(F.explode(names).alias("check"), "found").select(
        "check", F.coalesce(F.try_element_at("found", F.col("check")), F.lit(0)).cast("long").alias("failures")
    )


def failure_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check with its number of failures."""
    parts = []
    totals = []
    for check in checks:
        if check.condition is not None:
            condition = check.condition
            if check.where is not None:
                condition = condition & (F.expr(check.where) if isinstance(check.where, str) else check.where)
            totals.append(F.count_if(condition).alias(check.name))
        elif check.total is not None:
            totals.append(F.coalesce(check.total.cast("long"), F.lit(0)).alias(check.name))
    if totals:
        names = [c.name for c in checks if c.condition is not None or c.total is not None]
        parts.append(df.agg(*totals).unpivot([], names, "check", "failures"))
    keyed = [c for c in checks if c.keys is not None]
    if keyed:
        parts.append(key_counts(df, keyed))
    for check in checks:
        if check.query is not None:
            parts.append(check.query.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(check.name).alias("check"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Report of a suite: pass, warn or error by severity and thresholds."""
    counted = failure_counts(df, checks)
    status = None
    for check in checks:
        own = F.col("check") == check.name
        n = F.col("failures")
        level = F.when(n > check.warn_above, "warn").otherwise("pass")
        if check.severity == "error":
            level = F.when(n > check.error_above, "error").otherwise(level)
        status = F.when(own, level) if status is None else status.when(own, level)
    return counted.select("check", "failures", status.alias("status"))


class ChecksFailed(ValueError):
    pass


def require(spark: SparkSession, report: DataFrame) -> DataFrame:
    """Stop the pipeline when any check ended in error. The report has one row per check."""
    rows = report.collect()
    failed = [f"{r['check']} ({r['failures']})" for r in rows if r["status"] == "error"]
    if failed:
        raise ChecksFailed(", ".join(failed))
    return spark.createDataFrame(rows, REPORT)
