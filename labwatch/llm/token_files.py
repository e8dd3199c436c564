"""Token-id files of directly addressable codes: any id can be read without decoding a block."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.llm.alphabet import BLANKS, DIGITS, LETTERS, byte_alphabet, is_latin
from labwatch.llm.common import binary_column, give_back, parts_of, stored

MAGIC = b"TIDS0001"
# Ids of a segment, after which it ends with the document; and documents that are encoded at once.
SEGMENT_IDS = 1 << 19
TEXTS_AT_ONCE = 128
REMEMBERED_PARTS = 300_000
# A rank directory counts the continuation bits before every so many of them.
RANK_STEP = 512


class Codes:
    """Ids cut into bytes, least first: level k holds byte k of the ids that have one, and a bit for those that go on.

    The place of an id's next byte is the number of bits before its own: a count from the directory and at most
    ``RANK_STEP`` bits more, so ``self[i]`` costs as many look-ups as the id has bytes.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: int):
        self.levels, self.size = levels, size

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        rest, levels = np.ascontiguousarray(ids, np.uint32), []
        while len(rest) or not levels:
            more = rest > 255
            bits = np.packbits(more, bitorder="little")
            before = np.concatenate(([0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_STEP))))) if len(more) else [0]
            levels.append((rest.astype(np.uint8), bits, np.asarray(before[:-1] if len(more) else before, np.uint32)))
            rest = rest[more] >> np.uint32(8)
            if not len(rest):
                break
        return cls(levels, len(ids))

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<IB", self.size, len(self.levels))]
        for chunk, bits, before in self.levels:
            parts += [struct.pack("<I", len(chunk)), chunk.tobytes(), bits.tobytes(), before.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> Codes:
        size, count = struct.unpack_from("<IB", data, at)
        at += 5
        levels = []
        for _ in range(count):
            (n,) = struct.unpack_from("<I", data, at)
            at += 4
            chunk = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at + n)
            at += n + len(bits)
            before = np.frombuffer(data, "<u4", max(1, -(-n // RANK_STEP)), at)
            at += before.nbytes
            levels.append((chunk, bits, before))
        return cls(levels, size)

    def rank(self, level: int, place: int) -> int:
        """Continuation bits of a level before ``place``."""
        _, bits, before = self.levels[level]
        step = min(place // RANK_STEP, len(before) - 1)
        begin, whole = step * RANK_STEP // 8, place // 8
        count = int(before[step]) + int(np.bitwise_count(bits[begin:whole]).sum())
        return count + (int(bits[whole]) & ((1 << place % 8) - 1)).bit_count() if place % 8 else count

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = 0
        for level, (chunk, bits, _) in enumerate(self.levels):
            value |= int(chunk[i]) << 8 * level
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self.rank(level, i)
        return value

    def slice(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` to ``end``: two ranks a level, whatever lies before."""
        begin, end = max(begin, 0), min(end, self.size)
        if begin >= end:
            return np.zeros(0, np.uint32)
        spans = []
        for level, (chunk, bits, _) in enumerate(self.levels):
            first = begin // 8
            more = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")[begin - first * 8 : end - first * 8]
            spans.append((chunk[begin:end], more.astype(bool)))
            begin, end = self.rank(level, begin), self.rank(level, end)
            if begin == end:
                break
        values = np.zeros(0, np.uint32)
        for chunk, more in reversed(spans):
            whole = chunk.astype(np.uint32)
            whole[more] |= values << np.uint32(8)
            values = whole
        return values


class Segment:
    """One file image: documents by ascending id, where each begins, and all ids as ``Codes``.

    Little-endian: magic, number of documents, the ids before the segment in its part, document ids, a byte per document
    that tells a null id, lengths, then the codes.
    """

    def __init__(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, base: int, codes: Codes):
        self.doc_ids, self.nulls, self.lengths, self.base, self.codes = doc_ids, nulls, lengths, base, codes
        self.starts = np.concatenate(([0], np.cumsum(lengths)))

    @classmethod
    def of(cls, doc_ids: list[int | None], ids: list[np.ndarray], base: int) -> Segment:
        keys = np.array([k if k is not None else 0 for k in doc_ids], np.int64)
        nulls = np.array([k is None for k in doc_ids], np.uint8)
        return cls(keys, nulls, np.array([len(x) for x in ids], np.int64), base, Codes.of(np.concatenate(ids)))

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<IQ", len(self.doc_ids), self.base)
        keys, lengths = self.doc_ids.astype("<i8").tobytes(), self.lengths.astype("<u4").tobytes()
        return head + keys + self.nulls.tobytes() + lengths + self.codes.to_bytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Segment:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token segment")
        n, base = struct.unpack_from("<IQ", data, len(MAGIC))
        at = len(MAGIC) + 12
        keys = np.frombuffer(data, "<i8", n, at)
        nulls = np.frombuffer(data, np.uint8, n, at + 8 * n)
        lengths = np.frombuffer(data, "<u4", n, at + 9 * n).astype(np.int64)
        return cls(keys, nulls, lengths, base, Codes.from_bytes(data, at + 13 * n))

    def ids(self, n: int) -> np.ndarray:
        """The ids of the n-th document."""
        return self.codes.slice(int(self.starts[n]), int(self.starts[n + 1]))


PARTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)


class ByteLevelIds(dict):
    """Ids of the parts that a byte-level tokenizer cuts a text into, as little-endian 32-bit integers.

    Merges never cross parts, so a text's ids are its parts' ids one after another. Texts of code points up to U+00FF
    without special tokens are cut here and a part is encoded when it is first asked for, letters by the tokenizer's
    vocabulary alone; all other texts go through the tokenizer as a whole, and so do all texts where the tokenizer is of
    another kind.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.blank = chr(self.alphabet[0x20])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        sample = "It's  9 déjà-vu,\n\n we'll\tsee 1½ × ª«tests»  n'est \r\n "
        self.plain = self.whole([sample])[0] == b"".join(self.whole(PARTS.findall(sample)))
        self.by_letters = False
        words = [" the", "Idea", " zqxvé", "Größe", " señor"]
        self.by_letters = self.whole(words) == [self.letters(w) for w in words]

    def whole(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def letters(self, part: str) -> bytes:
        """Ids of letters, perhaps after a blank: every byte is a character of the vocabulary."""
        if part.isascii():
            part = part.replace(" ", self.blank)
        else:
            part = part.encode().decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: str) -> bytes:
        if self.by_letters and part.removeprefix(" ").isalpha():
            ids = self.letters(part)
        else:
            ids = self.whole([part])[0]
        self[part] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self) > REMEMBERED_PARTS:
            self.clear()
        out: list[bytes | None] = []
        for text in texts:
            cut = self.plain and is_latin(text) and not any(s in text for s in self.special)
            out.append(b"".join(map(self.__getitem__, PARTS.findall(text))) if cut else None)
        rest = [n for n, ids in enumerate(out) if ids is None]
        for n, ids in zip(rest, self.whole([texts[n] for n in rest])):
            out[n] = ids
        return out


def write_segments(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> DataFrame:
    """The token table of ``docs``: ``part, segment, first_id, last_id, n_docs, n_ids, data``, written to the shared folder.

    ``data`` holds a ``Segment``: whole documents in ascending order of ``key`` (integers), null first, each with
    ``end_id`` after its ids. Parts, and segments in a part, follow each other in that order; rows of equal key stand in
    their order of input, over as many parts as they need. A segment ends with the document that brings it to
    ``segment_ids`` ids, so tasks hold one segment. A null text is an empty one: its end alone. Segments are binary
    values of a Parquet table, since only Spark's writers reach every shared store; statistics of ``first_id`` and
    ``last_id`` lead to a document's segment. Other columns are not read. Texts are shuffled, once, before they are encoded.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    end = np.array([end_id], "<u4").tobytes()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ByteLevelIds(definition)
        part = TaskContext.get().partitionId()
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        held = base = number = 0

        def out() -> pa.RecordBatch:
            known = [k for k in keys if k is not None]
            ends = (known[0], known[-1]) if known else (None, None)
            row = [part, number, *ends, len(keys), held, Segment.of(keys, ids, base).to_bytes()]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=list("abcdefg"))

        for batch in parts_of(batches, TEXTS_AT_ONCE):
            values = [v.decode("utf-8") for v in binary_column(batch, "_text")]
            for doc_id, coded in zip(batch.column(0).to_pylist(), memory.encode(values)):
                keys.append(doc_id)
                ids.append(np.frombuffer(coded + end, "<u4"))
                held += len(ids[-1])
                if held >= segment_ids:
                    yield out()
                    base, number = base + held, number + 1
                    keys.clear()
                    ids.clear()
                    held = 0
        if keys:
            yield out()
        memory.clear()
        give_back()

    narrow = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    ordered = (
        narrow.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(F.asc_nulls_first("_key"), F.asc("_place"))
        .sortWithinPartitions(F.asc_nulls_first("_key"), F.asc("_place"))
    )
    schema = "part int, segment long, first_id long, last_id long, n_docs long, n_ids long, data binary"
    return stored(ordered.select("_key", "_text").mapInArrow(written, schema), "token-segments")


def part_starts(segments: DataFrame) -> DataFrame:
    """``part, before``: ids of all earlier parts. There are at most as many parts as the sort had partitions."""
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    return segments.sparkSession.createDataFrame(rows, "part int, before long")


def read_segments(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of every document of a token table: ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 1):
            segment = Segment.from_bytes(batch.column(2).to_pylist()[0])
            before = batch.column(1).to_pylist()[0] + segment.base
            for at in range(0, len(segment.lengths), TEXTS_AT_ONCE):
                rows = range(at, min(at + TEXTS_AT_ONCE, len(segment.lengths)))
                keys = [None if segment.nulls[n] else int(segment.doc_ids[n]) for n in rows]
                made = [
                    pa.array(keys, pa.int64()),
                    pa.array(before + segment.starts[at : rows.stop], pa.int64()),
                    pa.array(segment.lengths[at : rows.stop], pa.int64()),
                    pa.array([segment.ids(n).astype("<u4").tobytes() for n in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(made, names=["key", "start", "n_tokens", "ids"])

    # At most one row per partition of the sort, as wide as two integers.
    starts = F.broadcast(part_starts(segments).withColumnRenamed("part", "of"))
    placed = segments.join(starts, F.col("part") == F.col("of")).select("part", "before", "data")
    found = placed.mapInArrow(read, "_key long, start long, n_tokens long, ids binary")
    return found.withColumnRenamed("_key", key)


