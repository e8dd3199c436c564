"""Spelling variant grouping over a bit-sliced position index of the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import ROWS_AT_ONCE, binary_column, give_back, parts_of, stored
from labwatch.llm.jaccard import whole_runs

# Distinct words that a task counts before it hands them on.
COUNTED_AT_ONCE = 200_000
# Words of a cell that are indexed at once; larger cells are compared block by block.
BLOCK_WORDS = 4096
RUN = re.compile("[a-zÀ-ÿ]+")
ASCII_RUN = re.compile(b"[a-z]+")


def spelled(text: bytes, doc_id: str, damage: int | None = 97, shortest: int = 5) -> Counter:
    """Words of a text and how often they occur: runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased.

    Where ``damage`` divides the crc32 of ``doc_id:run``, the run loses the code point at that number modulo the
    run's length; all runs that are equal in a document share this. Shorter results than ``shortest`` are left out.
    """
    text = text.lower()
    if text.isascii():
        runs = {run.decode("ascii"): n for run, n in Counter(ASCII_RUN.findall(text)).items() if len(run) >= shortest}
    else:
        runs = {run: n for run, n in Counter(RUN.findall(text.decode("utf-8"))).items() if len(run) >= shortest}
    if damage is None:
        return Counter(runs)
    begun = zlib.crc32(f"{doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        number = zlib.crc32(run.encode(), begun)
        if number % damage == 0:
            at = number % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < shortest:
                continue
        words[run] += n
    return words


def vocabulary(
    docs: DataFrame,
    least: int = 3,
    damage: int | None = 97,
    shortest: int = 5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``word, n`` of all words of at least ``shortest`` code points that occur ``least`` times in all whole texts.

    Null and empty texts have no words; a null key counts as empty text. Tasks count before anything is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in parts_of(batches, ROWS_AT_ONCE):
            ids = [k if k is not None else "" for k in batch.column(0).to_pylist()]
            for doc_id, value in zip(ids, binary_column(batch, "_text")):
                words.update(spelled(value, doc_id, damage, shortest))
                if len(words) > COUNTED_AT_ONCE:
                    yield out()
                    words.clear()
        yield out()
        words.clear()
        give_back()

    narrow = docs.select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    counts = narrow.mapInArrow(counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class PositionIndex:
    """Bitsets over a list of words: for each position and letter the words that have it there, for each length its words.

    ``near`` runs over a word's letters once and keeps four sets, a bit per indexed word: those equal so far, and those
    with one letter replaced, one more or one less so far, whose later letters stand at shifted positions.
    """

    def __init__(self, words: list[str]):
        self.at: list[dict[str, int]] = [{} for _ in range(max(map(len, words), default=0) + 2)]
        self.of_length: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
            for place, letter in zip(self.at, word):
                place[letter] = place.get(letter, 0) | bit
        self.everything = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """The indexed words that differ from ``word`` by exactly one inserted, deleted or replaced letter."""
        equal, replaced, more, less, before = self.everything, 0, 0, 0, {}
        for i, letter in enumerate(word):
            here = self.at[i] if i < len(self.at) else {}
            after = self.at[i + 1] if i + 1 < len(self.at) else {}
            same = here.get(letter, 0)
            less = less & before.get(letter, 0) | equal
            more = (more | equal) & after.get(letter, 0)
            replaced = replaced & same | equal ^ (equal & same)
            equal &= same
            before = here
        size, sets = len(word), self.of_length
        return (
            replaced & sets.get(size, 0)
            | (more | equal) & sets.get(size + 1, 0)
            | less & sets.get(size - 1, 0)
        )


def members(bits: int) -> Iterator[int]:
    """Places of the bits that are set."""
    while bits:
        last = bits & -bits
        yield last.bit_length() - 1
        bits ^= last


class _Best:
    """Near words of each word of a cell: how many, and the one with the largest count."""

    def __init__(self):
        self.found: dict[str, tuple[int, int, str]] = {}

    def add(self, word: str, other: str, n: int) -> None:
        number, least, best = self.found.get(word, (0, 0, ""))
        if not number or (-n, other) < (least, best):
            least, best = -n, other
        self.found[word] = (number + 1, least, best)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of words sorted by cell (key, i, j) what is near within it, each pair in one of the cells that it shares."""
    for columns, _ in whole_runs(batches, 3, 1 << 20):
        key, i, j, block, k, from_end, words, counts = (c.to_pylist() for c in columns)
        best = _Best()
        begin = 0
        while begin < len(key):
            end = begin
            cell = (key[begin], i[begin], j[begin])
            while end < len(key) and (key[end], i[end], j[end]) == cell:
                end += 1
            rows = range(begin, end)
            begin = end
            if len(rows) < 2:
                continue
            indexed = [r for r in rows if block[r] == cell[2]]
            asking = [r for r in rows if block[r] == cell[1]]
            index = PositionIndex([words[r] for r in indexed])
            for r in asking:
                word, size, beginning = words[r], len(words[r]), words[r][: k[r]]
                for place in members(index.near(word)):
                    other = words[indexed[place]]
                    # A pair belongs to the cells of half its shorter word's length; the ones by beginning come first.
                    if min(size, len(other)) // 2 != k[r] or from_end[r] and other.startswith(beginning):
                        continue
                    best.add(word, other, counts[indexed[place]])
                    if cell[1] != cell[2]:
                        best.add(other, word, counts[r])
        if best.found:
            found = best.found
            made = [pa.array(list(found), pa.string())]
            made += [pa.array([f[p] for f in found.values()], t) for p, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(made, names=["word", "n_near", "least", "best"])


def near_words(words: DataFrame, shortest: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` of the words of ``words`` (word, n: once each) that have a near one.

    Two words are near if they differ by one inserted, deleted or replaced code point. Then the first or the last half
    of the shorter one's length is equal in both, so words meet in cells of equal beginnings and of equal ends; each
    cell has a position index of its own. Cells above ``block_words`` are compared block by block. Nothing is left out.
    """
    length = F.char_length("word")
    half, shorter = F.floor(length / 2).cast("int"), F.floor((length - 1) / 2).cast("int")
    halves = F.array_distinct(F.when(length > shortest, F.array(half, shorter)).otherwise(F.array(half)))
    halved = words.select("word", "n", F.explode(halves).alias("k"))
    ends = F.explode(F.array(F.lit(False), F.lit(True))).alias("from_end")
    affix = F.when(F.col("from_end"), F.expr("right(word, k)")).otherwise(F.expr("left(word, k)"))
    entries = halved.select("word", "n", "k", ends).withColumn("key", F.xxhash64("from_end", "k", affix))
    sizes = entries.groupBy(F.col("key").alias("shared")).agg(F.count("*").alias("rows")).where("rows > 1")
    blocks = sizes.select("shared", F.ceil(F.col("rows") / F.lit(block_words)).cast("int").alias("blocks"))
    spread = (
        entries.join(blocks, F.col("key") == F.col("shared"))
        .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    cells = (
        spread.select("key", "i", "j", "block", "k", "from_end", "word", "n")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )
    found = cells.mapInArrow(_compared, "word string, n_near long, least long, best string")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("least", "best")).alias("first"))
        .select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.least")).alias("best_n"))
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word of ``forms`` (word, form): where its chain of forms ends.

    Every round a word takes the place of its place, so chains shrink by half; counts at least double along a chain,
    so a few rounds are enough.
    """
    current = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = current.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        current = stored(
            current.join(step, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "forms",
        )
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2, shortest: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``words`` (word, n: once each, n not null).

    A word's form is its near word of largest n (ties: the first in code-point order), if that n is ``ratio`` times its
    own or more, else null. ``root`` is where the chain of forms ends, the word itself without one. ``ratio`` is above
    1, so no chain closes. Null words take no part; words are texts of code points up to U+00FF or beyond alike.
    Columns besides word and n are not read. An empty table gives an empty one.
    """
    words = stored(words.where("word is not null").select("word", "n"), "vocabulary")
    near = near_words(words, shortest, block_words).withColumnRenamed("word", "of")
    has_form = F.col("best_n") >= ratio * F.col("n")
    formed = stored(
        words.join(near, F.col("word") == F.col("of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best")).alias("form"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "formed",
    )
    roots = last_forms(formed.where("form is not null").select("word", "form")).withColumnRenamed("word", "of")
    return formed.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
