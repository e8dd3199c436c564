"""Writers, exports and releases."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labwatch.functions.dates import epi_label
from labwatch.functions.text import label
from labwatch.session import stored


def replace_table(df: DataFrame, path: str) -> int:
    """Overwrite a raw table and report the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_delimited(
    df: DataFrame, path: str, separator: str = "\t", compression: str | None = None, text: bool = True
) -> int:
    """Delimited files with a header, written by all tasks; returns the row count."""
    seen = Observation()
    out = (as_text(df) if text else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").option("header", "true").option("sep", separator)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return seen.get["rows"]


# Tables that are planned and written at a time: most are small, so one alone leaves the cluster idle.
AT_ONCE = 4


def _each(function: Callable, items: Iterable) -> list:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(function, items))


def export_tables(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    base: str,
    public_only: bool = False,
) -> list[tuple[str, str, int]]:
    """Every summary table as an all-text CSV folder, some at a time; returns (table, path, rows) in order."""

    def export(item) -> tuple[str, str, int]:
        name, table = item
        path = f"{base.rstrip('/')}/{name}"
        return name, path, write_delimited(table() if callable(table) else table, path, separator=",")

    return _each(export, [(n, t) for n, t in tables.items() if is_public(n) or not public_only])


def is_public(name: str) -> bool:
    """Only tables whose name starts with a digit are published."""
    return bool(re.match(r"\d", name))


def next_version(releases: DataFrame, week_label: Column, name: str = "release") -> Column:
    """1 + the version of the latest release folder when that is of the same week, else 1.

    The latest folder is the greatest name; the column is an aggregate over ``releases``.
    """
    last = F.max(F.when(F.col(name) != "current", F.col(name)))
    previous = F.regexp_extract(last, r"(?i)V(\d+)", 1).try_cast("int")
    same_week = F.contains(last, week_label)
    return F.when(same_week & previous.isNotNull(), previous + 1).otherwise(1)


def release_name(releases: DataFrame, as_of: str, project: str = "Arbo", name: str = "release") -> DataFrame:
    """One row: ``{time}_{project}_SE{ww}.{yyyy}_V{n}`` for the week before ``as_of``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    week = epi_label(F.date_sub(now.cast("date"), 6))
    stamp = F.date_format(now, "yyyy-MM-dd_HH'h'mm")
    return releases.agg(next_version(releases, week, name).alias("version")).select(
        "version", label(stamp, "_", F.lit(project), "_", week, "_V", F.col("version")).alias("release")
    )


def clear_others(spark: SparkSession, base: str, names: Collection[str]) -> None:
    """Empty what an earlier export left below ``base`` and this one doesn't write; its list is kept beside."""
    listed = f"{base.rstrip('/')}-tables"
    try:
        before = {r["name"] for r in spark.read.schema("name string").json(listed).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        before = set()
    for name in sorted(before - set(names)):
        spark.createDataFrame([], "gone string").write.mode("overwrite").csv(f"{base.rstrip('/')}/{name}")
    rows = [(name,) for name in names]
    spark.createDataFrame(rows, "name string").coalesce(1).write.mode("overwrite").json(listed)


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    internal: str,
    public: str,
    release: str,
) -> dict[str, list]:
    """Versioned and ``current`` copies; the public side gets digit-named tables under the week label.

    A table is computed once and stored; each place is written from the stored, ordered rows, so order and empty
    texts are the same everywhere. Tables that ``current`` no longer has are emptied.
    """
    week = re.search(r"SE\d+\.\d+", release).group()
    held = dict(_each(lambda nt: (nt[0], stored(nt[1]() if callable(nt[1]) else nt[1], "published")), tables.items()))
    shown = {name: df for name, df in held.items() if is_public(name)}
    clear_others(spark, f"{internal}/current/matrices/csv", held)
    clear_others(spark, f"{public}/current/matrices/csv", shown)
    return {
        "release": export_tables(held, f"{internal}/{release}/matrices/csv"),
        "current": export_tables(held, f"{internal}/current/matrices/csv"),
        "public": export_tables(shown, f"{public}/{week}/matrices/csv"),
        "public_current": export_tables(shown, f"{public}/current/matrices/csv"),
    }
