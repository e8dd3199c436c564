"""Removal of byte strings that occur at two places of the corpus, by suffix arrays of the passages in question."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.common import (
    arrow_append,
    arrow_explode,
    arrow_map,
    binary_column,
    few_of,
    mix64,
    stored,
    texts_of,
)
from labwatch.llm.jaccard import whole_runs
from labwatch.llm.suffixes import repeated_windows

GRAM = 32
CELLS = 4
# Strings that a task sorts at once, and members of one key that it takes; larger keys are counted window by window.
SORTED_AT_ONCE = 1500
KEY_ROWS = 20_000
ODD = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)
LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * ODD)
BLOCK = 1 << 22
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_WORD = 64
CELL_COLUMNS = "key long, whole long, begin int, size int, times int"
KEPT_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, count: int) -> np.ndarray:
    """The first powers of ``base``; a worker keeps those that short texts need."""
    known = _powers.get(int(base), LETTER[:0])
    if len(known) < count:
        known = np.full(1 << max(16, (count - 1).bit_length()), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= KEPT_POWERS:
            _powers[int(base)] = known
    return known[:count]


class Substrings:
    """Hashes of any substrings of one text, or of any runs of hashed words."""

    def __init__(self, data: np.ndarray):
        letters = LETTER[data] if data.dtype == np.uint8 else data
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters * powers(ODD, len(data)), dtype=np.uint64, out=self.total[1:])
        self.back = powers(BACK, len(data) + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[begin]) * self.back[begin] + (end - begin).astype(np.uint64))

    def runs(self, size: int, first: int, stop: int) -> np.ndarray:
        """The hashes of the runs of ``size`` that begin from ``first`` on and before ``stop``."""
        sums = self.total[first + size : stop + size] - self.total[first:stop]
        return mix64(sums * self.back[first:stop] + np.uint64(size))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of ``width``."""
    pad = (-len(values)) % width
    rows = np.concatenate((values, np.full(pad, 2**64 - 1, np.uint64))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


def anchors(
    data: np.ndarray, length: int, part: Substrings | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place, hash, and first and last start of the windows of ``length`` bytes that choose it, for every anchor.

    A window's anchor is its run of ``GRAM`` bytes with the least hash, the first of equals: equal windows choose the
    same one at the same offset, wherever they stand.
    """
    width = length - GRAM + 1
    part = part or Substrings(data)
    parts = []
    # Blocks overlap by a window, so texts of any length need bounded memory beside their own.
    for begin in range(0, len(data) - length + 1, BLOCK):
        hashes = part.runs(GRAM, begin, min(begin + BLOCK + length - 1, len(data)) - GRAM + 1)
        least = sliding_least((hashes & HIGH) | np.arange(len(hashes), dtype=np.uint64), width)
        change = np.concatenate(([0], np.nonzero(least[1:] != least[:-1])[0] + 1))
        place = (least[change] & LOW).astype(np.int64)
        last = np.append(change[1:], len(least)) - 1
        parts.append((place + begin, hashes[place], change + begin, last + begin))
    place, hashes, first, last = (np.concatenate(p) for p in zip(*parts))
    # An anchor that windows on both sides of a block's end choose is one anchor.
    new = np.concatenate(([True], place[1:] != place[:-1]))
    return place[new], hashes[new], first[new], last[np.append(new[1:], True)]


def cells_of(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """``key, whole, begin, size`` of the cells of a text: groups of windows that may repeat elsewhere.

    An anchor's windows are dealt to ``CELLS`` ranges of the anchor's offset. A cell's key hashes the anchor, the range
    and the bytes that all its windows share; ``whole`` hashes all bytes that any of them covers. So windows of cells
    with different keys differ, and in cells that are equal as a whole every window repeats.
    """
    data = np.frombuffer(text, np.uint8)
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    part = Substrings(data)
    place, hashes, first, last = anchors(data, length, part)
    step = -(-(length - GRAM + 1) // CELLS)
    out = []
    for cell in range(CELLS):
        near, far = cell * step, min((cell + 1) * step - 1, length - GRAM)
        on = (place - last <= far) & (place - first >= near)
        at = place[on]
        if not len(at):
            continue
        begin, end = np.maximum(at - far, 0), np.minimum(at - near + length, len(data))
        shared = part(at - near, at - far + length)
        key = mix64(hashes[on] + np.uint64(cell)) ^ shared
        # Where a text's ends cut a cell, the anchor's offset tells cells apart that cover the same bytes.
        whole = part(begin, end) ^ mix64((at - begin).astype(np.uint64))
        out.append((key.view(np.int64), whole.view(np.int64), begin, end - begin))
    return tuple(np.concatenate(c) for c in zip(*out))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``text, begin, after, hash`` of all words of ``texts``: a text's number, and places in it; ``after`` is the next
    word's begin or the text's end."""
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n" * 9, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    space = SPACE[data]
    edges = np.nonzero(space[1:] != space[:-1])[0] + 1
    begin, size = edges[::2], edges[1::2] - edges[::2]
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)

    def eight_bytes(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(eights[at]).view("<u8").ravel() & FIRST_BYTES[np.minimum(left, 8)]

    hashes = mix64(eight_bytes(begin, size) * ODD + size.astype(np.uint64))
    longer = np.nonzero((size > 8) & (size <= LONG_WORD))[0]
    for offset in range(8, LONG_WORD, 8):
        longer = longer[size[longer] > offset]
        if not len(longer):
            break
        hashes[longer] = mix64(hashes[longer] * ODD + eight_bytes(begin[longer] + offset, size[longer] - offset))
    for i in np.nonzero(size > LONG_WORD)[0].tolist():
        word = data[begin[i] : begin[i] + size[i]]
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    own = np.diff(np.append(np.searchsorted(begin, starts), len(begin)))
    text = np.repeat(np.arange(len(texts)), own)
    after = np.minimum(np.append(begin[1:], len(data)), (starts + sizes)[text])
    return text, begin - starts[text], after - starts[text], hashes


def word_cells_of(texts: list[bytes], words: int) -> tuple[np.ndarray, ...]:
    """``text, key, whole, begin, size`` of the cells of windows of ``words`` words, as ``cells_of`` has them of bytes.

    All windows of an anchor are one cell here. What stands between words doesn't count.
    """
    text, begin, after, hashes = words_of(texts)
    gram = max(words // 3, 1)
    count = len(hashes) - words + 1
    at = np.nonzero(text[: max(count, 0)] == text[words - 1 :])[0]
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    part = Substrings(hashes)
    grams = part.runs(gram, 0, len(hashes) - gram + 1)
    least = sliding_least((grams & HIGH) | np.arange(len(grams), dtype=np.uint64), words - gram + 1)[at]
    new = np.concatenate(([True], least[1:] != least[:-1]))
    first, last = at[new], at[np.append(new[1:], True)]
    place = (least[new] & LOW).astype(np.int64)
    whole = part(first, last + words) ^ mix64((place - first).astype(np.uint64))
    return text[first], grams[place].view(np.int64), whole.view(np.int64), begin[first], after[last + words - 1] - begin[first]


def one_of_equals(
    row: np.ndarray, times: np.ndarray, key: np.ndarray, whole: np.ndarray, begin: np.ndarray, size: np.ndarray
) -> tuple[np.ndarray, list[pa.Array]]:
    """Row numbers and ``CELL_COLUMNS`` of a batch's cells.

    Of equal cells one stands for all under their key; the others are repeated anyway and go under keys of their own,
    so that a cell which many texts share is a few rows per task.
    """
    order = np.lexsort((whole, key))
    new = np.concatenate(([True], (np.diff(key[order]) != 0) | (np.diff(whole[order]) != 0)))[: len(order)]
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=times[order]).astype(np.int64)
    first = order[new]
    times[first] = total
    later = order[~new]
    key[later] = mix64((row[later] << 32).astype(np.uint64) + begin[later].astype(np.uint64) + LETTER[1]).view(np.int64)
    times[later] = 2
    columns = [pa.array(c, pa.int64()) for c in (key, whole)] + [pa.array(c, pa.int32()) for c in (begin, size)]
    return row, [*columns, pa.array(np.minimum(times, 2), pa.int32())]


def that_meet(cells: DataFrame) -> DataFrame:
    """Cells that share their key with a different one (``varied``) or occur more than once (``twice``), stored."""
    by_key, by_whole = Window.partitionBy("key"), Window.partitionBy("key", "whole")
    met = cells.select(
        "*",
        (F.min("whole").over(by_key) < F.max("whole").over(by_key)).alias("varied"),
        (F.sum("times").over(by_whole) > 1).alias("twice"),
    )
    return stored(met.where("varied or twice"), "cells")


def places_met_twice(starts: DataFrame) -> DataFrame:
    """The windows of ``starts`` that stand at two places or are known to occur elsewhere."""
    counted = starts.groupBy("window").agg(
        F.max("twice").alias("known"),
        F.min(F.struct("text_id", "begin")).alias("low"),
        F.max(F.struct("text_id", "begin")).alias("high"),
    )
    double = counted.where("known or low < high").select(F.col("window").alias("double"))
    return starts.join(double, F.col("window") == F.col("double"), "left_semi")


def joined_spans(marks: DataFrame, name: str) -> DataFrame:
    """``text_id`` and the marked ranges of each text as ordered spans, joined where they touch; stored."""
    spans = marks.groupBy("text_id").agg(F.collect_set(F.struct("begin", "size")).alias("marks"))

    def merged(batch: pa.RecordBatch) -> list[pa.Array]:
        own = batch.column(1).flatten()
        row = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column(1).value_lengths()))
        begin, size = (np.asarray(own.field(n)).astype(np.int64) for n in ("begin", "size"))
        order = np.lexsort((begin, row))
        row, begin, end = row[order], begin[order], (begin + size)[order]
        # Texts are laid one behind the other, a byte apart.
        apart = row * (end.max() + 1)
        reach = np.maximum.accumulate(end + apart)
        new = np.concatenate(([True], (begin + apart)[1:] > reach[:-1]))
        last = np.append(new[1:], True)
        spans = pa.StructArray.from_arrays([pa.array(begin[new]), pa.array((reach - apart)[last])], ["begin", "end"])
        offsets = np.searchsorted(row[new], np.arange(batch.num_rows + 1))
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)]

    return stored(arrow_append(spans, ["text_id"], f"{name} array<struct<begin: long, end: long>>", merged), name)


def repeated_spans(texts: DataFrame, length: int = 400) -> DataFrame:
    """``text_id, spans`` of the distinct texts that hold a repeated string of ``length`` bytes, spans by place.

    ``texts`` has text_id (a hash of the text) and text, one row per document; null texts are left out. Equal texts
    are documents of their own, so all of a text of ``length`` bytes or more that occurs twice is repeated.

    1. Every window of ``length`` bytes belongs to an anchor chosen by its content alone; see ``cells_of``.
    2. Cells meet by key. Those that are equal as a whole elsewhere are repeated; those that share only a key with
       others are cut out of their texts, with one of each kind of their equals.
    3. Cells of a key come to one task, which sorts their suffixes in two stages and compares neighbours; every run
       that shares ``length`` bytes and stands at two places is repeated. Keys with more than ``KEY_ROWS`` kinds of
       cells have their windows' hashes counted instead, spread over all tasks.
    """

    def entered(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        seen: dict[bytes, list[int]] = {}
        for row, value in enumerate(binary_column(batch, "text")):
            seen.setdefault(value, []).append(row)
        rows, times, parts = [], [], []
        for value, own in seen.items():
            cells = cells_of(value, length)
            rows.append(np.full(len(cells[0]), own[0]))
            times.append(np.full(len(cells[0]), len(own)))
            parts.append(cells)
        key, whole, begin, size = (np.concatenate(p) for p in zip(*parts))
        row, times = np.concatenate(rows), np.concatenate(times)
        return one_of_equals(row, times, key, whole, begin, size)

    known = texts.where("text is not null")
    met = that_meet(arrow_explode(known, ["text_id"], CELL_COLUMNS, entered, 4096))

    kinds = met.where("varied").groupBy("key", "whole").agg(
        *[F.first(c).alias(c) for c in ("twice", "text_id", "begin", "size")]
    )
    kinds = stored(kinds, "kinds")
    large = kinds.groupBy("key").count().where(F.col("count") > KEY_ROWS).select(F.col("key").alias("large_key"))
    kinds = stored(kinds.join(large, F.col("key") == F.col("large_key"), "left"), "kinds")
    wanted = kinds.groupBy(F.col("text_id").alias("needed")).agg(
        F.collect_list(F.struct("key", "begin", "size", "twice", F.col("large_key").isNotNull().alias("large"))).alias("cells")
    )
    wanted = stored(wanted, "wanted")
    bodies = texts_of(known, wanted.select("needed")).join(wanted, F.col("text_id") == F.col("needed"))

    def cut(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        rows, out = [], []
        for row, (value, own) in enumerate(zip(binary_column(batch, "text"), batch.column(2).to_pylist())):
            for c in own:
                rows.append(row)
                out.append((c["key"], c["begin"], c["twice"], c["large"], value[c["begin"] : c["begin"] + c["size"]]))
        types = (pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary())
        return np.array(rows, np.int64), [pa.array(c, t) for c, t in zip(zip(*out), types)]

    strings = stored(
        arrow_explode(
            bodies.select("text_id", "text", "cells"),
            ["text_id"],
            "key long, begin int, twice boolean, large boolean, string binary",
            cut,
            512,
        ),
        "strings",
    )

    def sorted_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, text, begin, twice, string), _ in whole_runs(batches, 1, KEY_ROWS + 1):
            keys = np.asarray(key)
            last = np.append(np.nonzero(keys[1:] != keys[:-1])[0] + 1, len(keys))
            at = 0
            while at < len(keys):
                fits = last[last <= at + SORTED_AT_ONCE]
                end = int(fits[-1]) if len(fits) and fits[-1] > at else int(last[np.searchsorted(last, at, side="right")])
                own = slice(at, end)
                texts_, begins = np.asarray(text)[own], np.asarray(begin).astype(np.int64)[own]
                flags = np.asarray(twice.slice(at, end - at)).astype(bool)
                found = repeated_windows(string.slice(at, end - at).to_pylist(), texts_, begins, flags, length)
                at = end
                if found:
                    which, first, stop = (np.array(c, np.int64) for c in zip(*found))
                    columns = [pa.array(texts_[which]), pa.array(first, pa.int32()), pa.array(stop - first, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["text_id", "begin", "size"])

    usual = strings.where("not large").select("key", "text_id", "begin", "twice", "string")
    by_sorting = (
        usual.repartition("key").sortWithinPartitions("key").mapInArrow(sorted_suffixes, "text_id long, begin int, size int")
    )

    def windows(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        rows, hashes, offsets = [], [], []
        for row, value in enumerate(binary_column(batch, "string")):
            at = np.arange(len(value) - length + 1)
            rows.append(np.full(len(at), row))
            hashes.append(Substrings(np.frombuffer(value, np.uint8))(at, at + length).view(np.int64))
            offsets.append(at)
        return np.concatenate(rows), [pa.array(np.concatenate(hashes)), pa.array(np.concatenate(offsets), pa.int32())]

    starts = arrow_explode(
        strings.where("large").select("text_id", "begin", "twice", "string"),
        ["text_id", "begin", "twice"],
        "window long, offset int",
        windows,
    ).select("text_id", (F.col("begin") + F.col("offset")).alias("begin"), "twice", "window")
    by_counting = places_met_twice(starts).select("text_id", "begin", F.lit(length).alias("size"))
    marks = met.where("twice").select("text_id", "begin", "size").unionByName(by_sorting).unionByName(by_counting)
    return joined_spans(marks, "spans")


def repeated_passages(texts: DataFrame, words: int = 51) -> DataFrame:
    """``text_id, passages`` of the distinct texts that hold ``words`` consecutive words found at two places.

    ``texts`` is as in ``repeated_spans``. Words are runs of bytes other than blanks; a passage is a run of words all
    of which such windows cover, from its first word to the next word after it. Windows meet by anchors of a few words
    as they do there by bytes; of cells that share only a key, the hashes of the windows are counted.
    """

    def entered(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        seen: dict[bytes, list[int]] = {}
        for row, value in enumerate(binary_column(batch, "text")):
            seen.setdefault(value, []).append(row)
        first, times = np.array([own[0] for own in seen.values()]), np.array([len(own) for own in seen.values()])
        which, *cells = word_cells_of(list(seen), words)
        return one_of_equals(first[which], times[which], *cells)

    known = texts.where("text is not null")
    met = that_meet(arrow_explode(known, ["text_id"], CELL_COLUMNS, entered, 1024))
    kinds = met.where("varied").groupBy("key", "whole").agg(*[F.first(c).alias(c) for c in ("twice", "text_id", "begin", "size")])
    wanted = kinds.groupBy(F.col("text_id").alias("needed")).agg(F.collect_list(F.struct("begin", "size", "twice")).alias("cells"))
    wanted = stored(wanted, "wanted")
    bodies = texts_of(known, wanted.select("needed")).join(wanted, F.col("text_id") == F.col("needed"))

    def windows(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        values = binary_column(batch, "text")
        cells = [(row, c) for row, own in enumerate(batch.column(2).to_pylist()) for c in own]
        of = np.array([row for row, _ in cells])
        place, twice = np.array([c["begin"] for _, c in cells]), np.array([c["twice"] for _, c in cells])
        text, begin, after, hashes = words_of([values[r][c["begin"] : c["begin"] + c["size"]] for r, c in cells])
        at = np.nonzero(text[: max(len(text) - words + 1, 0)] == text[words - 1 :])[0]
        own = text[at]
        size = after[at + words - 1] - begin[at]
        return of[own], [
            pa.array(Substrings(hashes)(at, at + words).view(np.int64)),
            pa.array(place[own] + begin[at], pa.int32()),
            pa.array(size, pa.int32()),
            pa.array(twice[own]),
        ]

    columns = "window long, begin int, size int, twice boolean"
    starts = arrow_explode(bodies.select("text_id", "text", "cells"), ["text_id"], columns, windows, 512)
    counted = places_met_twice(stored(starts, "windows")).select("text_id", "begin", "size")
    return joined_spans(met.where("twice").select("text_id", "begin", "size").unionByName(counted), "passages")


def without(text: bytes, spans: list[dict]) -> bytes:
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["begin"]])
        at = span["end"]
    return b"".join([*kept, text[at:]])


def long_enough(text: bytes, spans: list[dict], words: int) -> list[dict]:
    return [s for s in spans if len(text[s["begin"] : s["end"]].split()) >= words] if words else spans


def removal_digests(
    docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", words: int = 0
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in another row or in
    its own; all such strings are judged on the input. Null and empty texts have 0 bytes. Null keys stay null,
    repeated rows are documents of their own, other columns are not read.

    With ``words`` a column ``n_passages`` follows: how many passages of at least so many words the text holds that stand
    elsewhere as well, be they removed or, as strings below ``length`` bytes, kept.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("text_id", F.xxhash64("text"))
    spans = repeated_spans(rows.select("text_id", "text"), length).withColumnRenamed("text_id", "of")
    held = texts_of(rows.where("text is not null").select("text_id", "text"), spans.select(F.col("of").alias("needed")))

    def digested(batch: pa.RecordBatch) -> list[pa.Array]:
        removed, count, digest = [], [], []
        for value, own in zip(binary_column(batch, "text"), batch.column(2).to_pylist()):
            kept = without(value, own)
            removed.append(len(value) - len(kept))
            count.append(len(own))
            digest.append(hashlib.sha256(kept).hexdigest())
        return [pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest)]

    made = arrow_append(
        held.join(spans, F.col("text_id") == F.col("of")).select("text_id", "text", "spans"),
        ["text_id"],
        "n_removed long, n_spans long, cut_sha256 string",
        digested,
    ).withColumnRenamed("text_id", "of")
    if words:
        passages = repeated_passages(rows.select("text_id", "text"), words)
        made = made.join(passages.select(F.col("text_id").alias("of"), F.size("passages").alias("n_passages")), "of", "full")
    plain = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    each = rows.select(
        "key", "text_id", F.length(plain).cast("long").alias("n_bytes"), F.sha2(plain, 256).alias("whole_sha256")
    )
    return each.join(made, F.col("text_id") == F.col("of"), "left").select(
        F.col("key").alias(key),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
        *([F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages")] if words else []),
    )


def cut_repeats(
    docs: DataFrame, length: int = 400, text: str = "text", chars: str | None = None, words: int = 0
) -> DataFrame:
    """``docs`` with every text's repeated strings taken out, all columns and rows kept.

    With ``words`` only runs of repeated strings go that hold at least so many words, whole or cut at the run's ends.

    Bytes of a character that a cut leaves incomplete go as well. Null texts stay null. A column ``chars`` is set to
    the number of characters left. Only texts that are cut are shuffled.
    """
    marked = docs.withColumn("_text_id", F.xxhash64(F.col(text)))
    texts = marked.select(F.col("_text_id").alias("text_id"), F.col(text).alias("text"))
    spans = repeated_spans(texts, length).select(F.col("text_id").alias("_of"), F.col("spans").alias("_spans"))
    passes = few_of(spans.select("_of"))
    place = len(docs.columns)

    def side(wanted: bool):
        def chosen(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = np.nonzero(passes(np.asarray(batch.column(place))) == wanted)[0]
            return batch.take(pa.array(rows)) if len(rows) else None

        return chosen

    whole = arrow_map(marked, side(False), marked.schema).drop("_text_id")
    touched = arrow_map(marked, side(True), marked.schema)
    joined = touched.join(spans, F.col("_text_id") == F.col("_of"), "left").drop("_text_id", "_of")

    def kept(batch: pa.RecordBatch) -> list[pa.Array]:
        own = batch.column(batch.schema.get_field_index("_spans")).to_pylist()
        valid = batch.column(batch.schema.get_field_index(text)).is_valid().to_pylist()
        out = [
            without(value, long_enough(value, spans or [], words)).decode("utf-8", "ignore") if there else None
            for value, spans, there in zip(binary_column(batch, text), own, valid)
        ]
        return [pa.array(out, pa.string())]

    cut = arrow_append(joined, [c for c in docs.columns if c != text] + ["_spans"], f"`{text}` string", kept)
    if chars:
        count = F.when(F.col("_spans").isNotNull(), F.char_length(F.col(text)).cast(docs.schema[chars].dataType))
        cut = cut.withColumn(chars, F.coalesce(count, F.col(chars)))
    return whole.unionByName(cut.select(*docs.columns))
