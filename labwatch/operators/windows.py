"""Per-key operators: dedupe, propagate, collapse, running totals, recency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.operators.joins import HOT_FLOOR, join_back, same_key
from labwatch.operators.shaping import result_text


def dedupe(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """First row per key under a total order (all columns by default).

    The rank limit is pushed below the shuffle (WindowGroupLimit), so each map task sends at most
    one row per key and a hot key costs one row per task.
    """
    order = order_by or [c for c in df.columns if c not in keys]
    window = W.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order] or [F.lit(1)])
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")


def sample_stats(df: DataFrame, key: str, columns: list[str], count: str = "qty_original_lines") -> DataFrame:
    """Best code per pathogen and number of lines of each sample: one partial aggregation."""
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in columns], F.count(F.lit(1)).alias(count))


def propagate(
    df: DataFrame,
    key: str = "sample_id",
    columns: list[str] | None = None,
    count: str = "qty_original_lines",
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Every line gets its sample's Pos/Neg/NT per pathogen and the sample's line count."""
    columns = columns or vocab.RESULT_COLUMNS
    stats = sample_stats(df, key, columns, count)
    text = stats.select(key, *[result_text(c).alias(c) for c in columns], count)
    return join_back(df.drop(*columns), text, [key], count, floor)


def collapse_samples(
    df: DataFrame,
    key: str,
    carried: list[str],
    columns: list[str] | None = None,
    order_by: list[str] | None = None,
    count: str = "qty_original_lines",
) -> DataFrame:
    """Propagate and dedupe in one aggregation: one shuffle, one row per sample per map task.

    The carried columns come from the sample's first line under ``order_by`` (all carried columns
    by default).
    """
    columns = columns or vocab.RESULT_COLUMNS
    order = order_by or carried
    lead = [*order, *[c for c in carried if c not in order]]
    first = F.min(F.struct(*lead)).alias("__first")
    merged = df.groupBy(key).agg(
        *[F.max(c).alias(c) for c in columns], F.count(F.lit(1)).alias(count), first
    )
    return merged.select(
        key,
        *[F.col("__first")[c].alias(c) for c in carried],
        *[result_text(c).alias(c) for c in columns],
        count,
    )


def drop_redundant(
    df: DataFrame, key: str, code: str, pairs: list[tuple[str, str]], floor: int = HOT_FLOOR
) -> DataFrame:
    """For each pair (keep, drop): a ``drop`` line goes when its key has exactly two lines of the pair.

    Only the droppable lines look at their key's counts; all other lines pass without a shuffle.
    """
    droppable = F.coalesce(F.col(code).isin(*[drop for _, drop in pairs]), F.lit(False))
    members = sorted({c for pair in pairs for c in pair})
    counts = {f"__pair{i}": F.count_if(F.col(code).isin(*pair)) for i, pair in enumerate(pairs)}
    stats = (
        df.filter(F.col(code).isin(*members))
        .groupBy(key)
        .agg(*[c.alias(n) for n, c in counts.items()], F.count_if(droppable).alias("__lines"))
        .filter("__lines > 0")
    )
    checked = join_back(df.filter(droppable), stats, [key], "__lines", floor)
    redundant = F.lit(False)
    for i, (_, drop) in enumerate(pairs):
        redundant = redundant | ((F.col(code) == drop) & (F.col(f"__pair{i}") == 2))
    kept = checked.filter(~redundant).select(*df.columns)
    return df.filter(~droppable).unionByName(kept)


def running_total(df: DataFrame, partition: list[str], order: str, value: str, name: str) -> DataFrame:
    """Cumulative sum per partition; rows of the same period share the total.

    Meant for aggregated input (one row per entity and period).
    """
    window = (
        W.partitionBy(*partition).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    return df.withColumn(name, F.sum(value).over(window))


def range_bounds(df: DataFrame, order: str, ranges: int) -> list:
    """Values of ``order`` that cut its rows into about ``ranges`` equal ranges, fewer than that many."""
    shares = [i / ranges for i in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(order, shares, F.lit(100 * ranges)).alias("bounds")).first()["bounds"]
    return sorted(set(bounds or []))


def range_of(order: str, bounds: list) -> Column:
    """Number of the range a value lies in; rows of one value share a range, NULL lies in the first."""
    below = [F.coalesce((F.col(order) > F.lit(b)).cast("int"), F.lit(0)) for b in bounds]
    return reduce(lambda x, y: x + y, below, F.lit(0))


def running_total_by_range(
    df: DataFrame, partition: list[str], order: str, value: str, name: str, ranges: int = 64
) -> DataFrame:
    """As ``running_total`` for entities of any size: prefix sums in two levels.

    ``order`` is cut into ranges of about equal numbers of rows. Each range of an entity is summed up in a window of its
    own; the ranges' totals, at most ``ranges`` per entity, are summed up in turn and carried to their rows.
    """
    ranged = df.withColumn("__range", range_of(order, range_bounds(df, order, ranges)))
    carried_over = W.partitionBy(*partition).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = (
        ranged.groupBy(*partition, "__range")
        .agg(F.sum(value).alias("__sum"), F.count(value).alias("__seen"))
        .withColumns({"__before": F.sum("__sum").over(carried_over), "__any": F.sum("__seen").over(carried_over)})
        .drop("__sum", "__seen")
    )
    keys = [*partition, "__range"]
    inside = W.partitionBy(*keys).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    summed = ranged.withColumns({"__total": F.sum(value).over(inside), "__own": F.count(value).over(inside)})
    joined = summed.alias("l").join(before.alias("s"), same_key(summed, before, keys))
    zero = F.lit(0)
    total = F.coalesce("l.__total", zero) + F.coalesce("s.__before", zero)
    # A sum over nothing but NULL is NULL.
    known = F.col("l.__own") + F.coalesce("s.__any", zero) > 0
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], F.when(known, total).alias(name))


def recent_days(df: DataFrame, date: str, days: int) -> DataFrame:
    """Rows strictly later than the newest date minus ``days``."""
    newest = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date) > F.date_sub(newest, days))


def last_period(df: DataFrame, period: str) -> DataFrame:
    newest = df.agg(F.max(period)).scalar()
    return df.filter(F.col(period) >= newest)


def recent_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the ``n`` latest distinct periods: a bounded top-n list and a semi-join."""
    latest = df.select(period).distinct().orderBy(F.col(period).desc_nulls_first()).limit(n)
    return df.join(F.broadcast(latest), period, "left_semi")
