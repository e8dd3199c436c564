"""Header repair for rows whose cells are a ``header -> text`` map.

Input rows: ``file_name, sheet, row_no, cells``. Layouts may differ between files, so repairs are
decided per file from aggregates over its rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.operators.joins import join_back

TAG = r"^(\w+):"
TAG_AND_SPACE = r"^\w+:\s*"


def named_columns(
    rows: DataFrame, wanted: list[str], aliases: Mapping[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Cells -> columns. A header variant is used only where the file lacks the canonical header."""
    aliases = aliases or {}
    cells = F.col("cells")

    def value(name: str):
        out = F.lit(None).cast("string")
        for header in reversed([name, *aliases.get(name, ())]):
            out = F.when(F.map_contains_key(cells, header), F.try_element_at(cells, F.lit(header))).otherwise(out)
        return out.alias(name)

    return rows.select(*[value(name) for name in wanted], "file_name")


def rename_aliases(df: DataFrame, aliases: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Column-level variant: rename the first variant found when the canonical column is absent."""
    renames = {}
    for name, variants in aliases.items():
        if name not in df.columns:
            for variant in variants:
                if variant in df.columns:
                    renames[variant] = name
                    break
    return df.withColumnsRenamed(renames)


def tagged_columns(rows: DataFrame, prefix: str) -> DataFrame:
    """Columns ``prefix*`` holding ``TAG: value`` are renamed to ``TAG`` and lose the tag.

    The first non-empty value of a column, per file, decides its tag. Wholly empty columns go; a
    single remaining column is called ``prefix``.
    """
    own = F.col("key").startswith(prefix)
    entries = rows.select("file_name", "row_no", F.explode("cells").alias("key", "value")).filter(own)
    filled = F.when(F.trim("value") != "", F.col("value"))
    first = entries.groupBy("file_name", "key").agg(
        F.min_by(filled, F.when(filled.isNotNull(), F.col("row_no"))).alias("first"),
    )
    tag = F.nullif(F.regexp_extract("first", TAG, 1), F.lit(""))
    # One row per file: header -> new name; untagged columns keep theirs unless they are alone.
    plan = first.filter(F.col("first").isNotNull()).select(
        "file_name", "key", tag.alias("tag")
    ).groupBy("file_name").agg(
        F.collect_list(F.struct("key", "tag")).alias("seen"), F.count_if(F.col("tag").isNull()).alias("untagged")
    )
    names = F.map_from_entries(
        F.transform(
            "seen",
            lambda e: F.struct(
                e["key"],
                F.coalesce(e["tag"], F.when(F.col("untagged") == 1, F.lit(prefix)).otherwise(e["key"])),
            ),
        )
    )
    counts = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("__rows"))
    stats = counts.join(plan.select("file_name", names.alias("__names")), "file_name", "left")
    joined = join_back(rows, stats, ["file_name"], "__rows")

    def tagged(key):
        return F.col("__names").isNotNull() & F.map_contains_key(F.col("__names"), key)

    def renamed(key):
        return F.when(tagged(key), F.try_element_at(F.col("__names"), key)).otherwise(key)

    kept = F.map_filter("cells", lambda k, v: ~k.startswith(prefix) | tagged(k))
    cells = F.map_from_entries(
        F.transform(
            F.map_entries(kept),
            lambda e: F.struct(
                renamed(e["key"]),
                F.when(
                    tagged(e["key"]) & (renamed(e["key"]) != e["key"]) & (renamed(e["key"]) != prefix),
                    F.coalesce(F.trim(F.regexp_replace(e["value"], TAG_AND_SPACE, "")), F.lit("")),
                ).otherwise(e["value"]),
            ),
        )
    )
    return joined.withColumn("cells", cells).select(*rows.columns)
