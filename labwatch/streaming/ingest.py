"""New files -> LabResult -> upsert, and weekly counts on a stream."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from labwatch.feeds.runner import run_feed
from labwatch.feeds.spec import LabSpec
from labwatch.schema import strings
from labwatch.session import stored
from labwatch.sources.readers import text_options, workbook_feed
from labwatch.sources.snapshots import manifest, merge_into, read_snapshot, snapshot_version
from labwatch.sources.workbook import BINARY_FILE, parse_workbooks

Step = Callable[[DataFrame, int], None]


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    glob: str | None = None,
    archive: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Unseen files of a folder as a stream, with their ``file_name``.

    With ``archive`` the consumed files move there once their batch is committed.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("file_name"))


def run_available(stream: DataFrame, step: Step, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process every file present now in micro-batches, then stop. A replayed batch keeps its id."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(step)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def aside(rows: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The rows to merge, and those for which a condition holds, with the first such ``reason``; NULL does not hold."""
    reason = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()])
    marked = rows.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def newest(spark: SparkSession, table: str, date: str):
    """The latest date that a snapshot table holds, None before its first row."""
    rows = read_snapshot(spark, table)
    return rows.agg(F.max(date)).first()[0] if rows is not None else None


def sorted_step(
    table: str,
    keys: list[str],
    writer: str,
    kept_aside: str,
    reasons: Callable[[DataFrame], dict[str, Column]] | None = None,
    date: str | None = None,
    days: int = 0,
    then: Callable[[SparkSession, str], None] | None = None,
    checks: Callable[[DataFrame], None] | None = None,
) -> Step:
    """As ``upsert_step``, but rows that are rejected or late are kept in a table of their own.

    A row is rejected for the first of ``reasons`` (named conditions on the batch) that holds, and ``late`` where its
    ``date`` lies more than ``days`` behind the latest one that the table held before the batch. Both go to
    ``kept_aside`` with reason, writer and batch, so in every batch the rows that came are those merged and those kept
    aside. A replayed batch writes the same place again; its lateness is judged as at first, by the merges before it.
    """
    merge = upsert_step(table, keys, writer, then, checks)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        conditions = dict(reasons(batch) if reasons else {})
        if any(p.writer == writer and p.batch == number for p in manifest(spark, table)):
            return
        if date is not None and (last := newest(spark, table, date)) is not None:
            conditions["late"] = F.col(date) < F.date_sub(F.lit(last).cast("date"), days)
        if not conditions:
            return merge(batch, number)
        rows = stored(batch, "batch")
        accepted, held = aside(rows, conditions)
        held.write.mode("overwrite").parquet(f"{kept_aside}/writer={writer_label(writer)}/batch={number}")
        merge(accepted, number)

    return step


def writer_label(writer: str) -> str:
    """A writer's name as a folder name."""
    return re.sub(r"[^A-Za-z0-9_.-]+", "-", writer)


def read_aside(spark: SparkSession, kept_aside: str) -> DataFrame:
    """Rejected and late rows of all batches with ``reason``, ``writer`` and ``batch``."""
    return spark.read.parquet(kept_aside)


def upsert_step(
    table: str,
    keys: list[str],
    writer: str,
    then: Callable[[SparkSession, str], None] | None = None,
    checks: Callable[[DataFrame], None] | None = None,
) -> Step:
    """Merge each batch by key; ``then`` (rebuilding what depends on it) runs when the table changed.

    ``writer`` names the stream, and a new checkpoint needs a new name: its batches count from 0 again, and a batch
    number that a writer has merged is a replay.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = snapshot_version(spark, table)
        after = merge_into(spark, batch, table, keys, writer, number, checks=checks)
        if then is not None and after != before:
            then(spark, table)

    return step


def stream_feed(
    spark: SparkSession,
    path: str,
    spec: LabSpec,
    table: str,
    checkpoint: str,
    archive: str | None = None,
    as_of: str | None = None,
    checks: Callable[[DataFrame], None] | None = None,
    then: Callable[[SparkSession, str], None] | None = None,
) -> StreamingQuery:
    """New files of one laboratory, delimited or workbooks, upserted by sample into a snapshot table."""
    if spec.format == "workbook":
        raw = stream_files(spark, path, BINARY_FILE, "binaryFile", spec.glob, archive)
    else:
        options = text_options(spec.separator, spec.encoding)
        raw = stream_files(spark, path, strings(*spec.raw_headers()), "csv", spec.glob, archive, **options)
    merge = upsert_step(table, ["sample_id"], checkpoint, then, checks)

    def step(batch: DataFrame, number: int) -> None:
        rows = workbook_feed(parse_workbooks(batch, spec.sheet, spec.all_sheets), spec) if spec.format == "workbook" else batch
        merge(run_feed(rows, spec, as_of), number)

    return run_available(raw, step, checkpoint)


def weekly_counts(events: DataFrame, ts: str, keys: list[str], late: str | None = None) -> DataFrame:
    """Counts per Sunday-to-Saturday week; works on streams and tables alike.

    Without ``late`` no row is ever too late (update mode; the state is one row per week and key).
    With it, weeks older than the watermark are final, as append mode needs.
    """
    # Weeks counted from the epoch start on Thursday; three days later is Sunday.
    week = F.window(F.col(ts), "7 days", "7 days", "3 days")
    if events.isStreaming and late:
        events = events.withWatermark(ts, late)
    counted = events.groupBy(week.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    start = F.col("w.start").cast("date")
    return counted.select(start.alias("week_start"), F.date_add(start, 6).alias("week_end"), *keys, "n")
