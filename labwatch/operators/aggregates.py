"""Positivity, pivots, rates and completeness; every aggregate combines on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.text import col
from labwatch.session import stored



def count_where(condition: Column, weight: Column | str | None = None) -> Column:
    """Number of rows (or their weights) under a condition; 0 when there are none."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, col(weight))), F.lit(0)).cast("long")


def positivity_metrics(
    result: Column | str = "result", min_tests: int = vocab.MIN_TESTS, weight: str | None = None
) -> list[Column]:
    """Pos, Neg, totaltests and posrate; the rate is NULL below ``min_tests``."""
    result = col(result)
    pos = count_where(result == "Pos", weight)
    total = count_where(result.isin("Pos", "Neg"), weight)
    return [
        pos.alias("Pos"),
        count_where(result == "Neg", weight).alias("Neg"),
        total.alias("totaltests"),
        F.when(total >= min_tests, pos.cast("double") / total).alias("posrate"),
    ]


def positivity(
    long: DataFrame,
    keys: list[str],
    min_tests: int = vocab.MIN_TESTS,
    result: str = "result",
    weight: str | None = None,
) -> DataFrame:
    return long.groupBy(*keys).agg(*positivity_metrics(result, min_tests, weight))


def pivot_fixed(
    df: DataFrame,
    keys: list[str],
    pivot: str,
    values: dict[object, str],
    value: str,
    agg: str = "max",
    fill: int | None = None,
) -> DataFrame:
    """Known pivot values ``{value: column name}``; keys without any of them still appear."""
    fn = {"max": F.max, "sum": F.sum}[agg]
    columns = []
    for item, name in values.items():
        out = fn(F.when(F.col(pivot) == F.lit(item), F.col(value)))
        columns.append((out if fill is None else F.coalesce(out, F.lit(fill))).alias(name))
    if not columns:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*columns)


def observed_values(df: DataFrame, column: str) -> list:
    """Sorted distinct non-NULL labels for a pivot.

    Each becomes a column; take the labels from a dimension where there is one, and keep the long form where there
    are too many to read.
    """
    return sorted(row[0] for row in df.filter(F.col(column).isNotNull()).select(column).distinct().collect())


def pivot_observed(
    df: DataFrame,
    keys: list[str],
    pivot: str,
    value: str,
    agg: str = "max",
    fill: int | None = None,
    labels: list | None = None,
    suffix: str = "",
) -> DataFrame:
    """Pivot on the values the data holds: one small query for the labels, then a fixed pivot."""
    labels = observed_values(df, pivot) if labels is None else labels
    return pivot_fixed(df, keys, pivot, {v: f"{v}{suffix}" for v in labels}, value, agg, fill)


def fill_rate(df: DataFrame, entity: str, period: str, filled: Column) -> DataFrame:
    """Share of all periods in which an entity's value is filled."""
    periods = df.agg(F.countDistinct(period)).scalar()
    return df.groupBy(entity).agg((F.count_if(filled).cast("double") / periods).alias("fill_rate"))


def completeness(
    df: DataFrame,
    entity: str,
    period: str,
    value: str,
    history: float = 0.7,
    recent: float = 0.7,
    days: int = 364,
) -> DataFrame:
    """Share of weeks in which an entity has a value, over all (``h``) and over the last ``days`` (``y``), with classes.

    ``df`` holds one aggregated row per entity and week, so a window per entity is bounded by the
    calendar; the weeks themselves are one short list.
    """
    weeks = F.col("weeks")
    last = F.element_at(weeks, -1)
    in_last_year = F.filter(weeks, lambda w: w >= F.date_sub(last, days))
    calendar = df.agg(F.array_sort(F.collect_set(period)).alias("weeks")).select(
        F.struct(
            F.date_sub(last, days).alias("first"),
            F.size(weeks).alias("weeks"),
            F.size(in_last_year).alias("year_weeks"),
        )
    ).scalar()
    own = W.partitionBy(entity)
    filled, in_year = F.col(value).isNotNull(), F.col(period) >= calendar["first"]
    seen = F.count_if(in_year).over(own)
    h = F.count_if(filled).over(own).cast("double") / calendar["weeks"]
    # An entity without any row in the last year has no year share at all.
    y = F.when(seen > 0, F.count_if(filled & in_year).over(own).cast("double") / calendar["year_weeks"])
    out = df.withColumns({"h": h, "y": y})
    h, y = F.col("h"), F.col("y")
    final = (
        F.when((h >= history) & (y >= recent), "Alta qualidade")
        .when((h < history) & (y < recent), "Baixa qualidade")
        .when((h >= history) & (y < recent), "Apenas histórico")
        .otherwise("Apenas 12 meses")
    )
    return out.withColumns(
        {
            "history_class": F.when(h >= history, "Bom Histórico").otherwise("Ruim histórico"),
            "year_class": F.when(y >= recent, "Bom 12 meses").otherwise("Ruim 12 meses"),
            "final_class": final,
        }
    )


def per_100k(count: Column | str, population: Column | str) -> Column:
    """Rate per 100,000; NULL for an unknown or zero population."""
    return F.try_divide(col(count).cast("double"), F.nullif(col(population), F.lit(0))) * 100000


def distinct_ratio(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows over all rows (NULL rows count); NULL for an empty table."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.try_divide(F.count(F.lit(1)).cast("double"), F.sum("n")).alias("ratio"))


def distinct_states(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, bucket, bits``: which values each group holds, exactly, in a form that can be merged.

    Distinct counts don't add up, their states do: each distinct value gets a number, a state holds a bit per number, and
    coarser groups take the bits of theirs together (``distinct_counts``). The numbers are written with the values once.
    NULL is no value. A state is at most 4 KB per 32,768 numbers in which the group has one.
    """
    values = stored(
        df.select(F.col(value).alias("__value")).where("__value is not null").distinct().withColumn(
            "__number", F.monotonically_increasing_id() + 1
        ),
        "numbered",
    )
    numbered = df.select(*by, value).distinct().join(values, F.col(value) == F.col("__value"))
    return numbered.groupBy(*by, F.bitmap_bucket_number("__number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__number")).alias("bits")
    )


def distinct_counts(states: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number of distinct values of each group of ``by``, any of the columns that the states were made by."""
    merged = states.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
