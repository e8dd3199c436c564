"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwatch.session import scratch_dir

# Multipliers of the 64-bit finalizer that spreads hashes over all bits.
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizers' package keeps a file; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back; cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_remainder(key: str | Column, divisor: int) -> Column:
    """``crc32`` of a key's text modulo ``divisor``; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null becomes empty."""
    values = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [v if v is not None else b"" for v in values.to_pylist()]


# Rows that a task's Python side holds at once, where rows don't depend on each other.
ROWS_AT_ONCE = 2048


def give_back() -> None:
    """Hand freed memory back to the system: Spark keeps Python workers for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def parts_of(batches: Iterator[pa.RecordBatch], rows: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows or max(batch.num_rows, 1)):
            yield batch.slice(at, rows)
    give_back()


def arrow_append(
    df: DataFrame, carry: list[str], added: str, function: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """The columns ``carry`` and the ones that ``function`` makes of each record batch (``added``, as DDL).

    An input column that is called like an added one is replaced.
    """
    new = T.StructType.fromDDL(added)
    carry = [c for c in carry if c not in new.names]
    schema = T.StructType([df.schema[c] for c in carry] + new.fields)
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, ROWS_AT_ONCE):
            if batch.num_rows:
                kept = [batch.column(batch.schema.get_field_index(c)) for c in carry]
                yield pa.RecordBatch.from_arrays(kept + function(batch), names=names)

    return df.mapInArrow(task, schema)


def arrow_explode(
    df: DataFrame,
    carry: list[str],
    added: str,
    function: Callable[[pa.RecordBatch], tuple[np.ndarray, list[pa.Array]]],
    rows_at_once: int | None = None,
) -> DataFrame:
    """As ``arrow_append``, for functions that make any number of rows of a row: they also return its index.

    Functions that sum over their rows get whole batches unless ``rows_at_once`` is given.
    """
    new = T.StructType.fromDDL(added)
    carry = [c for c in carry if c not in new.names]
    schema = T.StructType([df.schema[c] for c in carry] + new.fields)
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, rows_at_once):
            if batch.num_rows:
                rows, made = function(batch)
                if len(rows):
                    at = pa.array(rows, pa.int64())
                    kept = [batch.column(batch.schema.get_field_index(c)).take(at) for c in carry]
                    yield pa.RecordBatch.from_arrays(kept + made, names=names)

    return df.mapInArrow(task, schema)


def arrow_map(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType
) -> DataFrame:
    """``function`` over every record batch of ``df``; None stands for no rows."""
    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, ROWS_AT_ONCE):
            if batch.num_rows and (out := function(batch)) is not None:
                yield out.rename_columns(names)

    return df.mapInArrow(task, schema)


FILTER_BITS = 1 << 24


def few_of(ids: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test that all 64-bit ids of the one column of ``ids`` pass, and most others don't.

    It is a bitmap of fixed size (2 MB), made on the executors; with very many ids it lets more pass, so a join must
    decide.
    """
    name = ids.columns[0]
    # From 1 on, so that the bitmaps' buckets start at 1 and their bits at 0.
    place = F.pmod(F.col(name), F.lit(FILTER_BITS)) + 1
    bitmaps = ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    marked = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, bits in bitmaps.collect():  # FILTER_BITS bits at most
        begin = (bucket - 1) * len(bits)
        marked[begin : begin + len(bits)] = np.frombuffer(bits, np.uint8)

    def passes(values: np.ndarray) -> np.ndarray:
        at = values % FILTER_BITS
        return (marked[at // 8] >> (at % 8).astype(np.uint8) & 1).astype(bool)

    return passes


def texts_of(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """``text_id, text`` once for each id of ``needed`` (one column of that name); few other texts are shuffled."""
    passes = few_of(needed)

    def picked(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = np.asarray(batch.column(0))
        rows = np.nonzero(passes(ids))[0]
        if not len(rows):
            return None
        _, once = np.unique(ids[rows], return_index=True)
        return batch.take(pa.array(rows[once]))

    few = arrow_map(texts.select("text_id", "text"), picked, "text_id long, text string")
    kept = few.join(needed, F.col("text_id") == F.col("needed"), "left_semi")
    return kept.groupBy("text_id").agg(F.first("text").alias("text"))
