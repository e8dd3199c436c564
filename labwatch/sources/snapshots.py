"""Snapshot tables: keyed upserts by any number of writers, reads of touched buckets only, and a feed of what changed.

A table is a folder of parts. A part holds the rows of one merge, in folders by ``__bucket``, a range of the key's hash.
The manifest has a file per version that names the part, its buckets and their ranges of hashes; a version counts once
its file is there, and of several writers only one can create it. A part of kind ``base`` stands for all that its buckets
held up to version ``as_of``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwatch.operators.merge import upsert

MANIFEST = (
    "version long, as_of long, kind string, writer string, batch long, keys array<string>, columns string, path string,"
    " buckets int, covers array<int>, held array<struct<bucket: int, rows: long, low: long, high: long>>"
)
# Ranges of key hashes of a new table; large tables take some thousands.
BUCKETS = 16
KEEP = ("created_at",)


class Conflict(Exception):
    """The table moved on since the version that a write was made for."""


def manifest(spark: SparkSession, table: str) -> list[Row]:
    """The versions of a snapshot table in order; empty before its first write."""
    try:
        return sorted(spark.read.schema(MANIFEST).json(f"{table}/manifest").collect(), key=lambda r: r.version)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def snapshot_version(spark: SparkSession, table: str) -> int | None:
    parts = manifest(spark, table)
    return parts[-1].version if parts else None


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``; False if there is one. Written aside, then renamed without replacing."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    target = target.getFileSystem(conf).makeQualified(target)
    files = target.getFileSystem(conf)
    aside = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(aside)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    rename = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(aside, target, options)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def _commit(spark: SparkSession, table: str, **entry) -> bool:
    return create_once(spark, f"{table}/manifest/{entry['version']:012d}.json", json.dumps(entry))


def _placed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``rows`` with the hash of their key and its range, of ``buckets`` equal ones."""
    hashed = rows.withColumn("__hash", F.xxhash64(*keys))
    return hashed.withColumn("__bucket", F.shiftright(F.shiftrightunsigned("__hash", 32) * buckets, 32).cast("int"))


def _complete(keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])


def _write_part(rows: DataFrame, table: str, keys: list[str], buckets: int) -> tuple[str, list[dict]]:
    """Write ``rows`` in buckets, a file or more each; returns the part's folder and what each bucket holds."""
    path = f"{table}/part-{uuid.uuid4().hex}"
    placed = _placed(rows, keys, buckets).hint("rebalance", "__bucket").sortWithinPartitions("__bucket", "__hash")
    placed.write.partitionBy("__bucket").parquet(path)
    schema = T.StructType([*rows.schema.fields]).add("__hash", T.LongType()).add("__bucket", T.IntegerType())
    ranges = rows.sparkSession.read.schema(schema).parquet(path).groupBy("__bucket")
    counted = ranges.agg(F.count("*").alias("rows"), F.min("__hash").alias("low"), F.max("__hash").alias("high"))
    held = [{"bucket": b, "rows": n, "low": low, "high": high} for b, n, low, high in counted.collect()]
    return path, sorted(held, key=lambda h: h["bucket"])


def _scan(spark: SparkSession, part: Row, buckets: set[int]) -> DataFrame | None:
    """A part's rows of some buckets: only their folders are listed and opened."""
    paths = [f"{part.path}/__bucket={h.bucket}" for h in part.held if h.bucket in buckets]
    return spark.read.schema(T.StructType.fromJson(json.loads(part.columns))).parquet(*paths) if paths else None


class _Layout:
    """Which part answers for which bucket at a version: one base each, and the merges after it."""

    def __init__(self, parts: list[Row], version: int | None):
        self.parts = [p for p in parts if version is None or p.version <= version]
        self.buckets = range(self.parts[-1].buckets)
        bases = sorted((p for p in self.parts if p.kind == "base"), key=lambda p: (p.as_of, p.version))
        self.base = {b: p for p in bases for b in (self.buckets if p.covers is None else p.covers)}
        merges = [p for p in self.parts if p.kind == "merged"]
        self.merges = {
            p.version: {h.bucket for h in p.held if self.base[h.bucket].as_of < p.version} for p in merges
        }
        self.touched = set().union(*self.merges.values())
        self.by_version = {p.version: p for p in self.parts}

    def base_rows(self, spark: SparkSession, buckets: set[int]) -> list[DataFrame]:
        of_part: dict[int, set[int]] = {}
        for bucket in buckets:
            of_part.setdefault(self.base[bucket].version, set()).add(bucket)
        scans = [_scan(spark, self.by_version[v], own) for v, own in sorted(of_part.items())]
        return [s for s in scans if s is not None]

    def merged_rows(self, spark: SparkSession, buckets: set[int], after: int = 0) -> list[DataFrame]:
        scans = []
        for version, own in sorted(self.merges.items()):
            rows = _scan(spark, self.by_version[version], own & buckets) if version > after else None
            if rows is not None:
                scans.append(rows.withColumn("__version", F.lit(version)))
        return scans


def _buckets_of(wanted: DataFrame, keys: list[str], layout: _Layout) -> set[int]:
    """Buckets that may hold keys of ``wanted``: by their own ranges of hashes and those that the parts tell."""
    placed = _placed(wanted.select(*keys), keys, len(layout.buckets)).groupBy("__bucket")
    ranges = placed.agg(F.min("__hash"), F.max("__hash")).collect()  # a row per bucket
    found = set()
    for bucket, low, high in ranges:
        parts = [layout.base[bucket], *(layout.by_version[v] for v, own in layout.merges.items() if bucket in own)]
        held = [h for p in parts for h in p.held if h.bucket == bucket]
        if any(h.low <= high and low <= h.high for h in held):
            found.add(bucket)
    return found


def _folded(rows: DataFrame, keys: list[str], keep: tuple[str, ...], columns: list[str]) -> DataFrame:
    """The latest row of each key among merges, with columns ``keep`` of the first; rows without a whole key all."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("__version"))
    whole = newest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = {c: F.last(c).over(whole) for c in keep if c in rows.columns}
    complete = rows.filter(_complete(keys)).withColumn("__place", F.row_number().over(newest_first)).withColumns(held)
    return complete.filter("__place = 1").select(*columns).unionByName(rows.filter(~_complete(keys)).select(*columns))


def _current(spark: SparkSession, layout: _Layout, buckets: set[int], keep: tuple[str, ...]) -> DataFrame:
    columns = T.StructType.fromJson(json.loads(layout.parts[0].columns))
    empty = spark.createDataFrame([], columns)
    pieces = layout.base_rows(spark, buckets - layout.touched)
    touched = buckets & layout.touched
    merges = layout.merged_rows(spark, touched)
    if merges:
        keys = layout.parts[-1].keys
        base = reduce(DataFrame.unionByName, layout.base_rows(spark, touched) or [empty])
        rows = _folded(reduce(DataFrame.unionByName, merges), keys, keep, columns.names)
        pieces.append(upsert(base, rows, keys, keep, strict=False))
    return reduce(DataFrame.unionByName, pieces or [empty])


def read_snapshot(
    spark: SparkSession,
    table: str,
    version: int | None = None,
    keep: tuple[str, ...] = KEEP,
    wanted: DataFrame | None = None,
) -> DataFrame | None:
    """Rows of a snapshot table, or None before its first write: the latest row of each key.

    Buckets without merges since their base are read as they stand; in the others the merges are folded among themselves
    and upserted into the base. Columns ``keep`` stay as a key's first row had them. With ``wanted``, a frame with the key
    columns, only its keys' rows come, and only buckets that may hold them are opened.
    """
    parts = manifest(spark, table)
    if not parts or version is not None and version < parts[0].version:
        return None
    layout = _Layout(parts, version)
    if wanted is None:
        return _current(spark, layout, set(layout.buckets), keep)
    keys = layout.parts[-1].keys
    rows = _current(spark, layout, _buckets_of(wanted, keys, layout), keep)
    return rows.join(wanted.select(*keys).distinct(), keys, "left_semi")


def merge_into(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: list[str],
    writer: str = "load",
    batch: int | None = None,
    strict: bool = True,
    checks: Callable[[DataFrame], None] | None = None,
    buckets: int = BUCKETS,
    expected: int | None = None,
) -> int | None:
    """Upsert ``source`` into a snapshot table; returns the table's version afterwards.

    Only the source is written, once; ``checks`` and the key check (``strict``) read what was written, and only then a
    version names it. A lost job leaves the table as it was. Versions count up, whoever writes: a writer that finds its
    version taken takes the next one, without writing its rows again, so no batch is lost; with ``expected`` it raises
    ``Conflict`` instead where the table is no longer at that version (0: not there). A writer's ``batch`` that is in the
    manifest already is not merged again; an empty source makes no version beyond the first. ``buckets`` holds for a new table.
    """
    path, held, number = None, [], buckets
    while True:
        parts = manifest(spark, table)
        last = parts[-1].version if parts else None
        if batch is not None and any(p.writer == writer and p.batch == batch for p in parts):
            return last
        if expected is not None and (last or 0) != expected:
            raise Conflict(f"{table} is at version {last}, not {expected}")
        if path is None or parts and parts[-1].buckets != number:
            number = parts[-1].buckets if parts else buckets
            path, held = _write_part(source, table, keys, number)
            written = spark.read.schema(source.schema).parquet(path)
            if checks is not None:
                checks(written)
            if strict:
                repeated = written.filter(_complete(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect()
                if repeated:
                    raise ValueError(f"upsert source repeats key {tuple(repeated[0][k] for k in keys)}")
        if not held and parts:
            return last
        version = (last or 0) + 1
        kind = "merged" if parts else "base"
        entry = dict(kind=kind, as_of=version, writer=writer, batch=batch, keys=keys, columns=source.schema.json())
        if _commit(spark, table, version=version, path=path, buckets=number, covers=None, held=held, **entry):
            return version


def compact_snapshot(spark: SparkSession, table: str) -> int | None:
    """Write the current rows of all buckets with merges as their new base; other buckets stay where they are.

    Merges that are committed meanwhile stay on top of it.
    """
    parts = manifest(spark, table)
    if not parts:
        return None
    layout = _Layout(parts, None)
    if not layout.touched:
        return parts[-1].version
    keys, number = parts[-1].keys, len(layout.buckets)
    current = _current(spark, layout, layout.touched, KEEP)
    path, held = _write_part(current, table, keys, number)
    entry = dict(kind="base", as_of=parts[-1].version, writer="compaction", batch=None, keys=keys)
    entry |= dict(columns=current.schema.json(), path=path, buckets=number, covers=sorted(layout.touched), held=held)
    version = parts[-1].version + 1
    while not _commit(spark, table, version=version, **entry):
        version += 1
    return version


def changes(spark: SparkSession, table: str, since: int, until: int | None = None, keep: tuple[str, ...] = KEEP) -> DataFrame:
    """What the merges after version ``since`` changed: rows as they were (``sign`` -1) and as they are (1).

    Only keys that were merged and only their buckets are read; a row that was merged without a change comes with both
    signs. Rows without a whole key are added by every merge. ``since`` 0 stands for the empty table.
    """
    parts = manifest(spark, table)
    layout = _Layout(parts, until)
    keys, columns = layout.parts[-1].keys, T.StructType.fromJson(json.loads(parts[0].columns)).names
    if since < parts[0].version:
        return read_snapshot(spark, table, until, keep).withColumn("sign", F.lit(1))
    merged = [
        _scan(spark, p, set(layout.buckets)) for p in layout.parts if p.kind == "merged" and p.version > since and p.held
    ]
    if not merged:
        return spark.createDataFrame([], T.StructType.fromJson(json.loads(parts[0].columns))).withColumn("sign", F.lit(1))
    rows = reduce(DataFrame.unionByName, merged)
    keyed = rows.filter(_complete(keys)).select(*keys).distinct()
    sides = []
    for version, sign in ((since, -1), (layout.parts[-1].version, 1)):
        sides.append(read_snapshot(spark, table, version, keep, keyed).select(*columns, F.lit(sign).alias("sign")))
    loose = rows.filter(~_complete(keys)).select(*columns, F.lit(1).alias("sign"))
    return sides[0].unionByName(sides[1]).unionByName(loose)


CELL = "__cell"


def refresh_counts(spark: SparkSession, table: str, counts: str, by: list[str], prepare=lambda rows: rows) -> int | None:
    """Bring the table ``counts`` (rows of ``table`` per ``by``) up to date by what changed since it was last; its version.

    ``prepare`` makes the columns ``by`` of rows of the table. Cells that did not change are neither read nor written. The
    version of ``table`` is the batch number, so a repeated refresh does nothing; of two at a time one starts again.
    """
    while True:
        until = snapshot_version(spark, table)
        done = manifest(spark, counts)
        since = max((p.batch for p in done if p.writer == "refresh"), default=0)
        if until is None or until <= since:
            return done[-1].version if done else None
        moved = prepare(changes(spark, table, since, until)).groupBy(*by).agg(F.sum("sign").alias("n")).filter("n <> 0")
        cells = moved.withColumn(CELL, F.md5(F.to_json(F.struct(*by))))
        before = read_snapshot(spark, counts, wanted=cells) if done else None
        if before is not None:
            was = before.select(F.col(CELL).alias("__was"), F.col("n").alias("__n"))
            cells = cells.join(was, F.col(CELL) == F.col("__was"), "left").withColumn("n", F.col("n") + F.coalesce("__n", F.lit(0)))
        try:
            rows = cells.select(CELL, *by, "n")
            version = done[-1].version if done else 0
            made = merge_into(spark, rows, counts, [CELL], "refresh", until, expected=version)
        except Conflict:
            continue
        return made


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    return read_snapshot(spark, counts).filter("n <> 0").drop(CELL)
