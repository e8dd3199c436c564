"""Best-fit packing with dual-feasible-function certificates and exchange between partitions."""

from __future__ import annotations

import os
import re
from functools import reduce
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwatch.llm.alphabet import BLANKS, DIGITS, LETTERS, byte_alphabet, is_latin
from labwatch.llm.common import arrow_explode, binary_column, stored

# Distinct words of one of a task's two generations; what leaves the older one is encoded again when it comes back.
REMEMBERED_WORDS = 200_000
ID_BYTES = 4


# The parts of a lower-case word that the tokenizer's pattern tells apart.
WORD_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+")


class WordIds(dict):
    """Ids of words between ASCII blanks, as little-endian 32-bit integers; a word is encoded when it is asked for.

    The tokenizer normalises and splits at blanks, so a text's ids are its words' ids one after another. Words of code
    points up to U+00FF are cut into parts here, which the tokenizer's vocabulary encodes; all others, and such as may
    hold a special token, go through the tokenizer as a whole, and so do all words where it is of another kind.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        sample = ["a", "the", "Idea", "zqxv,", "été.", "GRÖßE", "señor's", "we'll...", "x²½×ª«3.14»", "\x1cª\x85b\xa0c", "$%'d"]
        self.by_parts = True
        self.by_parts = all(self.encoded(w.encode()) == self.whole(w) for w in sample)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack_ids(f"<{len(ids)}I", *ids)

    def part(self, part: str) -> bytes:
        """Ids of one part: every byte is a character of the vocabulary."""
        letters = part if part.isascii() and part.isalpha() else part.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(letters)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.encoded(word)
        self[word] = found
        return found

    def encoded(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if not self.by_parts or "<|" in text or not is_latin(text):
            return self.whole(text)
        low = text.lower()
        if low.isalpha():
            return self.part(low) if low == text else self[low.encode()]
        return b"".join(self[p.encode()] if p.isalpha() else self.part(p) for p in WORD_PARTS.findall(low))

    def age(self) -> None:
        """Begin a new generation where this one is full; words of the one before it are forgotten."""
        if len(self) > REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, text: str = "text", carry: tuple = ("doc_id",)
) -> DataFrame:
    """``carry, piece, start, length, ids``: token ids of every text and ``end_id``, cut where longer than ``capacity``.

    ``ids`` is binary, little-endian unsigned 32-bit. Only texts above the capacity are cut, into pieces of exactly
    that length and a last one that may be shorter. Null and empty texts give one piece with the end alone. The
    tokenizer's definition is read on the driver from ``tokenizer_path``, so executors need no such file.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    end = np.asarray([end_id], "<u4").tobytes()
    step = capacity * ID_BYTES
    # Filled by the first batch of a task, and gone with it.
    memories: list[WordIds] = []

    def pieces(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        if not memories:
            memories.append(WordIds(definition))
        memory = memories[0]
        rows, piece, start, length, ids = [], [], [], [], []
        for row, value in enumerate(binary_column(batch, text)):
            memory.age()
            whole = b"".join(map(memory.__getitem__, value.split())) + end
            for n, at in enumerate(range(0, len(whole), step)):
                part = whole[at : at + step]
                rows.append(row)
                piece.append(n)
                start.append(at // ID_BYTES)
                length.append(len(part) // ID_BYTES)
                ids.append(part)
        return np.array(rows, np.int64), [
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array(ids, pa.binary()),
        ]

    docs = docs.select(*carry, text) if text not in carry else docs.select(*carry)
    return arrow_explode(docs, list(carry), "piece int, start long, length long, ids binary", pieces, 1024)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing of so many pieces of each length needs: the best of two families of dual feasible functions.

    The first, for a cut e up to half the capacity: above ``capacity - e`` counts as full, below e as nothing. The
    second, for k: ``floor((k + 1) x / capacity) * capacity / k``, or x where that division has no rest.
    """
    if not counts.any():
        return 0
    counts = counts.astype(np.int64)
    sizes = np.arange(capacity + 1)
    many, total = np.cumsum(counts), np.cumsum(counts * sizes)
    cuts = np.arange(0, capacity // 2 + 1)
    below = np.where(cuts > 0, total[np.maximum(cuts - 1, 0)], 0)
    middle = total[capacity - cuts] - below
    large = many[capacity] - many[capacity - cuts]
    best = int((-(-(large * capacity + middle) // capacity)).max())
    for k in range(1, 33):
        # Times k, all in integers.
        value = np.where((k + 1) * sizes % capacity == 0, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, int(-(-(counts * value).sum() // (k * capacity))))
    return max(best, 1)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and each bin's free space; ties go in input order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    free: list[int] = []
    spaces = 0  # bit s: some bin has s left
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = spaces >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            holder = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, holder = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = holder, capacity - space
        left = free[holder] = space - n
        by_space[left].append(holder)
        spaces |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def pack(
    pieces: DataFrame, capacity: int = 4096, rows_per_partition: int = 100_000, rounds: int = 6, length: str = "length"
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of at most ``capacity`` as can be.

    Every partition (a hash of the row's place, about ``rows_per_partition`` each) is packed best-fit decreasing, and a
    lower bound of its bin count certifies it where the count is no higher. Full bins are closed, and so are certified
    partitions but for their emptiest bin. All other bins have gaps: they are dealt anew, whole, among as many partitions
    as their documents ask, so documents of different partitions meet and are packed again; a partition keeps the bins it
    got where the new ones are not fewer. So every bin is of one packing and gapless from 0. This ends when the bins are as many as the bound of
    the whole input certifies, when the gaps fit one partition, when a round saves nothing, or after ``rounds``.

    Null lengths count as 0, lengths above the capacity fail. Repeated rows are separate pieces. Columns called like
    the two added ones are replaced; an empty table stays empty.
    """
    # Read again in every round, and in the same order each time: a row's partition hangs on its place.
    pieces = stored(pieces.drop("sequence_id", "offset"), "pieces")
    names = pieces.columns
    schema = T.StructType(
        pieces.schema.fields + T.StructType.fromDDL("sequence_id long, offset long, _closed boolean").fields
    )
    counts = pieces.groupBy(F.coalesce(F.col(length), F.lit(0)).alias("n")).count().collect()  # capacity + 1 rows at most
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    if max(n for n, _ in counts) > capacity:
        raise ValueError(f"a length is above the capacity of {capacity}")
    histogram = np.zeros(capacity + 1, np.int64)
    for n, count in counts:
        histogram[n] = count
    bound = lower_bound(histogram, capacity)

    def packed(key, table):
        number, part = (int(k.as_py()) for k in key)
        lengths = np.asarray(table[length].fill_null(0)).astype(np.int64)
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        ids, count, spaces = bins + (part << 28) + (number << 56), len(free), free[bins]
        if number:
            before, where = np.unique(np.asarray(table["sequence_id"]), return_inverse=True)
            if len(before) <= count:
                used = np.bincount(where, weights=lengths).astype(np.int64)
                ids, offsets, count, spaces = before[where], np.asarray(table["offset"]), len(before), (capacity - used)[where]
        certified = count <= lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        closed = spaces == 0
        if certified:
            closed |= ids != ids[np.argmax(spaces)]
        added = [pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()), pa.array(closed)]
        return pa.table([table[c] for c in names] + added, names=schema.names)

    # What may still exchange, and what is closed, and its bins.
    pool = pieces.withColumns({"sequence_id": F.lit(-1).cast("long"), "offset": F.lit(0).cast("long")})
    rows, closed, closed_bins, last = int(histogram.sum()), [], 0, None
    for number in range(rounds):
        parts = max(1, -(-rows // rows_per_partition))
        place = F.xxhash64("sequence_id", F.lit(number)) if number else F.xxhash64(F.monotonically_increasing_id())
        dealt = pool.withColumns({"_round": F.lit(number), "_part": F.pmod(place, F.lit(parts)).cast("int")})
        result = stored(dealt.groupBy("_round", "_part").applyInArrow(packed, schema), f"packed-{number}")
        done = F.col("_closed")
        per_bin = result.groupBy("sequence_id").agg(F.first(done).alias("done"), F.count("*").alias("rows"))
        full, gaps, rows = per_bin.agg(
            F.count_if("done"), F.count_if(~F.col("done")), F.coalesce(F.sum(F.when(~F.col("done"), F.col("rows"))), F.lit(0))
        ).first()
        closed.append(result.where(done))
        closed_bins += full
        pool = result.where(~done).select(*names, "sequence_id", "offset")
        bins = closed_bins + gaps
        if not gaps or bins <= bound or parts == 1 or (last is not None and bins >= last):
            break
        last = bins
    closed = [part.select(*names, "sequence_id", "offset") for part in closed]
    out = reduce(DataFrame.unionByName, [*closed, pool])
    return out.select(*names, "sequence_id", "offset")
