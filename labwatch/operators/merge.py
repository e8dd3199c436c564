"""Set operations and keyed upsert."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.functions.text import col


class FeedsOfTable(Mapping[str, DataFrame]):
    """Feeds that are conditions on one table, by name: each is read on its own, or all in one scan by ``union_feeds``."""

    def __init__(self, table: DataFrame, conditions: Mapping[str, Column]):
        self.table, self.conditions = table, dict(conditions)

    def __getitem__(self, lab: str) -> DataFrame:
        return self.table.filter(self.conditions[lab])

    def __iter__(self) -> Iterator[str]:
        return iter(self.conditions)

    def __len__(self) -> int:
        return len(self.conditions)


def union_feeds(feeds: Mapping[str, DataFrame], columns: list[str], distinct: bool = True) -> DataFrame:
    """Feeds under one column list with their ``lab_id``.

    ``distinct=False`` saves the shuffle where every feed is already unique by sample (upserted). Feeds of one table
    share its plan, which separate feeds would run once each.
    """
    if isinstance(feeds, FeedsOfTable):
        return split_feeds(feeds.table, feeds.conditions, columns, distinct)
    tagged = [df.select(F.lit(lab).alias("lab_id"), *columns) for lab, df in feeds.items()]
    out = reduce(DataFrame.unionByName, tagged)
    return out.distinct() if distinct else out


def split_feeds(df: DataFrame, feeds: Mapping[str, Column], columns: list[str], distinct: bool = True) -> DataFrame:
    """As ``union_feeds`` where every feed is a condition on one table: one scan, whatever their number.

    A row comes once for each condition it meets. ``lab_id`` of the table is replaced.
    """
    # Spark's array_compact is not compiled, and neither are the conditions below it: blank entries go as rows.
    labs = F.array(*[F.when(condition, F.lit(lab)) for lab, condition in feeds.items()])
    spread = df.withColumn("__labs", labs).select(F.explode("__labs").alias("lab_id"), *columns)
    tagged = spread.filter(F.col("lab_id").isNotNull())
    return tagged.distinct() if distinct else tagged


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    keep: tuple[str, ...] = ("created_at",),
    strict: bool = True,
) -> DataFrame:
    """MERGE by key: matched rows updated except ``keep``, new rows inserted, other rows kept.

    A NULL in a key never matches. With ``strict`` a repeated source key raises, as a MERGE would.

    Both passes over the target only ask for the source's keys, so a batch small enough for
    broadcast (Spark checks) leaves the target unshuffled.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    keyed, loose = source.filter(complete), source.filter(~complete)
    if strict:
        repeated = keyed.groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"upsert source repeats key {tuple(repeated[0][k] for k in keys)}")
    touched = keyed.select(*keys)
    untouched = target.join(touched, keys, "left_anti").select(*target.columns)
    held = [c for c in keep if c in target.columns]
    before = target.join(touched, keys, "left_semi").select(
        *keys, *[F.col(c).alias(f"__{c}") for c in held], F.lit(True).alias("__found")
    )
    merged = keyed.join(before, keys, "left").select(
        *[
            F.when(F.col("__found"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in held else F.col(c)
            for c in source.columns
        ]
    )
    return untouched.unionByName(merged).unionByName(loose)


def shared_ids(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.select(key).intersect(new.select(key))


def strip_zero_prefix(c: Column | str, length: int = 5) -> Column:
    """Ids that start with 0 lose their first ``length`` characters."""
    c = col(c)
    return F.when(c.startswith("0"), F.substring(c, F.lit(length + 1), F.length(c))).otherwise(c)


def release_diff(old: DataFrame, new: DataFrame, key: str, normalise=None) -> DataFrame:
    """Each id of two releases once, as ``added``, ``removed`` or ``kept``: one aggregation, no join."""
    def ids(df: DataFrame, side: int) -> DataFrame:
        value = F.col(key) if normalise is None else normalise(F.col(key))
        return df.select(value.alias(key), F.lit(side).alias("side"))

    sides = ids(old, 1).unionByName(ids(new, 2)).groupBy(key).agg(F.bit_or("side").alias("sides"))
    status = F.when(F.col("sides") == 1, "removed").when(F.col("sides") == 2, "added").otherwise("kept")
    return sides.select(key, status.alias("status"))
