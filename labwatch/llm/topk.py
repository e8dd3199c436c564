"""Exact top-k search over integer vectors by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.common import arrow_explode, stored


def integer_vectors(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """``row, key, data, width``: floor(scale * x) of every component as little-endian doubles, and a number per row.

    Rows whose key or vector is null, or whose vector holds a null or non-finite component, are left out. The number holds
    where the frame is written.
    """

    def quantized(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        rows, data, widths = [], [], []
        keys = batch.column(0)
        for i, value in enumerate(batch.column(1)):
            if keys[i].is_valid and value.is_valid and not value.values.null_count:
                numbers = np.floor(scale * np.asarray(value.values, np.float64))
                if np.isfinite(numbers).all():
                    rows.append(i)
                    data.append(numbers.tobytes())
                    widths.append(len(numbers))
        return np.array(rows, np.int64), [pa.array(data, pa.binary()), pa.array(widths, pa.int32())]

    chosen = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    made = arrow_explode(chosen, ["key"], "data binary, width int", quantized)
    return made.select(F.monotonically_increasing_id().alias("row"), "key", "data", "width")


def _similar_order(rows: DataFrame, width: int, seed: int = 5) -> DataFrame:
    """``rows`` with ``place``: the signs of 16 random projections, so that ranges of it hold similar vectors."""
    directions = np.random.default_rng(seed).standard_normal((width, 16))

    def placed(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        matrix = _padded(batch.column(2).to_pylist(), width)
        bits = (matrix @ directions > 0).astype(np.int64) @ (1 << np.arange(16, dtype=np.int64))
        return np.arange(batch.num_rows), [pa.array(bits)]

    return arrow_explode(rows.select("row", "key", "data"), ["row", "key", "data"], "place long", placed)


def _padded(rows: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        numbers = np.frombuffer(row, "<f8")
        out[i, : len(numbers)] = numbers
    return out


def _merge(k: int, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query: larger scores first, then smaller keys."""
    order = np.lexsort((key, -score, query))
    query, score, key = query[order], score[order], key[order]
    start = np.searchsorted(query, query, side="left")
    keep = np.arange(len(query)) - start < k
    return query[keep], score[keep], key[keep]


class Block:
    """Consecutive rows: their numbers, keys and vectors, and every component's maximum and minimum."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray, matrix: np.ndarray):
        self.rows, self.keys, self.matrix = rows, keys, matrix


def bounds_of(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No row of a block scores above this: the sum over components of the larger product with its maximum or minimum."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search_blocks(
    queries: np.ndarray, own: np.ndarray, threshold: np.ndarray, blocks: list[Block], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, score and key of each query's k best rows among ``blocks`` that reach its threshold.

    Each query goes through the blocks by falling bound, one, one, two, four, ... at a time, and ends where the bound
    is below its k-th score so far; equal bounds are still scored, as a tie may go to a smaller key.
    """
    high = np.stack([b.matrix.max(axis=0) for b in blocks])
    low = np.stack([b.matrix.min(axis=0) for b in blocks])
    bounds = bounds_of(queries, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    threshold = threshold.copy()
    found = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    first, last = 0, 1
    while first < len(blocks):
        window = order[:, first:last]
        rows, places = np.nonzero(np.take_along_axis(bounds, window, axis=1) >= threshold[:, None])
        if not len(rows):
            break
        wanted = window[rows, places]
        parts = [found]
        for number in np.unique(wanted).tolist():
            asking, block = rows[wanted == number], blocks[number]
            scores = queries[asking] @ block.matrix.T
            hits = (scores >= threshold[asking][:, None]) & (block.rows[None, :] != own[asking][:, None])
            at, column = np.nonzero(hits)
            parts.append((asking[at], scores[at, column], block.keys[column]))
        found = _merge(k, *(np.concatenate(p) for p in zip(*parts)))
        full, start, count = np.unique(found[0], return_index=True, return_counts=True)
        done = count == k
        threshold[full[done]] = np.maximum(threshold[full[done]], found[1][start[done] + k - 1])
        first, last = last, min(len(blocks), 2 * last)
    return found


FOUND = "query_row long, query_id long, vec_id long, score long"
LIMIT = 2.0**63 - 1024
# Shards whose blocks' bounds a query meets in one task.
SHARDS_AT_ONCE = 64


def _numbers(column: pa.ChunkedArray, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _blocks(table: pa.Table, width: int) -> list[Block]:
    columns = (table[c].to_pylist() for c in ("rows", "keys", "matrix"))
    return [
        Block(np.frombuffer(r, "<i8"), np.frombuffer(k, "<i8"), np.frombuffer(m, "<f8").reshape(-1, width))
        for r, k, m in zip(*columns)
    ]


def _found(own: np.ndarray, ids: np.ndarray, query: np.ndarray, score: np.ndarray, key: np.ndarray) -> pa.Table:
    columns = [own[query], ids[query], key, np.clip(score, -LIMIT, LIMIT).astype(np.int64)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_row", "query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame,
    k: int = 20,
    query_divisor: int = 20,
    scale: float = 64.0,
    block_rows: int = 512,
    shard_rows: int = 32_768,
    key: str = "vec_id",
    vector: str = "embedding",
    queries_at_once: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of every query.

    Queries are the rows whose key is divisible by ``query_divisor``, each row for itself, candidates all rows but the
    query's own: rows of equal key are candidates of each other, and ties among them are alike in what is returned.

    1. Rows are put in an order in which neighbours are similar and cut into blocks of consecutive rows, each with its
       forward index (the vectors) and every component's maximum and minimum; consecutive blocks form shards.
    2. A shard's queries search its own blocks; their k-th scores are the first thresholds.
    3. Queries with thresholds meet the blocks' maxima and minima alone, and only shards with a bound that reaches the
       threshold are listed for a query.
    4. Listed queries go to their shards, ``queries_at_once`` in a task, through the blocks by falling bound until it is
       below the k-th score so far. The k best rows of each search meet by query.

    Shorter vectors count as filled up with zeros. Products are exact while their sums stay below 2**53. Null keys
    and unusable vectors take no part; an empty table gives an empty result; other columns are not read.
    """
    usable = stored(integer_vectors(vectors, scale, key, vector), "vectors")
    rows, width = usable.agg(F.count("*"), F.max("width")).first()
    width = max(width or 0, 1)
    shards = max(1, -(-rows // shard_rows))
    by = ("place", "key", "row")
    placed = _similar_order(usable, width).repartitionByRange(shards, *by).sortWithinPartitions(*by)

    def blocked(batches):
        part = TaskContext.get().partitionId()
        for batch in batches:
            numbers, all_keys, data = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2).to_pylist()
            out = []
            for at in range(0, batch.num_rows, block_rows):
                own = slice(at, at + block_rows)
                keys, matrix = all_keys[own], _padded(data[own], width)
                bounds = np.concatenate((matrix.max(axis=0), matrix.min(axis=0)))
                out.append([part, *(np.ascontiguousarray(p).tobytes() for p in (numbers[own], keys, matrix, bounds))])
            if out:
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(next(columns), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=list("abcde")
                )

    blocks = stored(placed.mapInArrow(blocked, "part int, rows binary, keys binary, matrix binary, bounds binary"), "blocks")
    # Spark may have made more ranges than asked for: adjacent ones form a shard.
    parts = (blocks.agg(F.max("part")).first()[0] or 0) + 1
    blocks = blocks.withColumn("shard", F.floor(F.col("part") * F.lit(shards) / F.lit(parts)).cast("int"))

    def searched_at_home(_, table):
        held = _blocks(table, width)
        numbers, keys = np.concatenate([b.rows for b in held]), np.concatenate([b.keys for b in held])
        asks = keys % query_divisor == 0
        queries = np.concatenate([b.matrix[b.keys % query_divisor == 0] for b in held])
        return _found(numbers[asks], keys[asks], *search_blocks(queries, numbers[asks], np.full(len(queries), -np.inf), held, k))

    home = blocks.groupBy("shard").applyInArrow(searched_at_home, FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    if shards > 1:
        home = stored(home, "found-at-home")
        away = _searched_away(usable, blocks, home, k, query_divisor, width, shards, queries_at_once)
        found = home.unionByName(away)
    else:
        found = home
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched_away(
    usable: DataFrame,
    blocks: DataFrame,
    home: DataFrame,
    k: int,
    query_divisor: int,
    width: int,
    shards: int,
    queries_at_once: int,
) -> DataFrame:
    """What the queries find outside their own shards, with scores that reach their thresholds."""

    def listed(batch: pa.RecordBatch):
        """The rows of a block that ask, and the shard they are at home in."""
        at, numbers = [], []
        for n, (rows, keys) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            own = np.frombuffer(rows, "<i8")[np.frombuffer(keys, "<i8") % query_divisor == 0]
            at.append(np.full(len(own), n))
            numbers.append(own)
        return np.concatenate(at), [pa.array(np.concatenate(numbers), pa.int64())]

    at_home = arrow_explode(blocks.select("shard", "rows", "keys"), ["shard"], "row long", listed)
    # Fewer than k rows at home leave no threshold.
    best = home.groupBy("query_row").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    threshold = F.when(F.col("found") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    queries = (
        at_home.withColumnRenamed("row", "of")
        .join(usable, F.col("of") == F.col("row"))
        .join(best, F.col("row") == F.col("query_row"), "left")
        .select("row", "key", "data", "shard", F.coalesce(threshold, F.lit(float("-inf"))).alias("threshold"))
    )
    queries = stored(queries, "queries")
    groups = -(-shards // SHARDS_AT_ONCE)
    chunk = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-queries.count() // queries_at_once)))).cast("int")
    asking = queries.withColumn("chunk", chunk).withColumn("shards", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    chunks = asking.agg(F.max("chunk")).first()[0] or 0
    of_group = blocks.select("shard", "bounds", F.floor(F.col("shard") / SHARDS_AT_ONCE).cast("int").alias("shards"))
    meeting = of_group.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks))))

    def reached(_, left, right):
        matrix = _padded(left["data"].to_pylist(), width)
        both = _numbers(right["bounds"], "<f8").reshape(-1, 2 * width)
        shard, home_shard = np.asarray(right["shard"]), np.asarray(left["shard"])
        if not len(matrix) or not len(both):
            return pa.table({"row": pa.array([], pa.int64()), "target": pa.array([], pa.int32())})
        hits = bounds_of(matrix, both[:, :width], both[:, width:]) >= np.asarray(left["threshold"])[:, None]
        query, place = np.nonzero(hits)
        pairs = np.unique(np.stack([query, shard[place]], axis=1), axis=0)
        pairs = pairs[home_shard[pairs[:, 0]] != pairs[:, 1]]
        rows = np.asarray(left["row"])[pairs[:, 0]]
        return pa.table({"row": pa.array(rows, pa.int64()), "target": pa.array(pairs[:, 1], pa.int32())})

    cogrouped = asking.groupBy("chunk", "shards").cogroup(meeting.groupBy("chunk", "shards"))
    pairs = stored(cogrouped.applyInArrow(reached, "row long, target int"), "query-shards")
    loads = pairs.groupBy(F.col("target").alias("loaded")).agg(F.ceil(F.count("*") / F.lit(queries_at_once)).cast("int").alias("cells"))
    told = (
        pairs.join(loads, F.col("target") == F.col("loaded"))
        .withColumn("cell", F.pmod(F.xxhash64("row"), F.col("cells")).cast("int"))
        .select(F.col("row").alias("of"), "target", "cell")
        .join(queries.select("row", "key", "data", "threshold"), F.col("of") == F.col("row"))
        .select("target", "cell", "row", "key", "data", "threshold")
    )
    held = (
        blocks.join(loads, F.col("shard") == F.col("loaded"))
        .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select(F.col("shard").alias("target"), "cell", "rows", "keys", "matrix")
    )

    def searched(_, left, right):
        own, ids = np.asarray(left["row"]), np.asarray(left["key"])
        if not len(own) or not right.num_rows:
            return _found(own[:0], ids[:0], *(np.zeros(0, np.int64) for _ in range(3)))
        matrix = _padded(left["data"].to_pylist(), width)
        return _found(own, ids, *search_blocks(matrix, own, np.asarray(left["threshold"]), _blocks(right, width), k))

    cells = told.groupBy("target", "cell").cogroup(held.groupBy("target", "cell"))
    return cells.applyInArrow(searched, FOUND)
