"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihoods by scaled forward recursion."""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_append, arrow_explode, binary_column, stored

BLOCK_TOKENS = 1 << 18


class Vocabulary:
    """Counts of the most frequent words, and the classes that the states emit.

    The first ``own`` words are classes of their own; any other word belongs to the class of its last bytes, where
    it has its share of the class's count (plus one for each word, and one for all unseen). The last class is a
    text's end. Words beyond the listed ones have their counts joined.
    """

    def __init__(self, words: list[bytes], counts: list[int], own: int, endings: int, totals: tuple[int, int], ends: int):
        self.counts, self.own, self.endings, self.tokens, self.types = counts, own, endings, *totals
        self.ends = ends
        self.numbers = {w: i for i, w in enumerate(words)}
        self.classes = min(own, len(words)) + endings + 1
        self.first_ending = min(own, len(words))
        self.class_sizes = np.ones(endings)
        self.tables: tuple[np.ndarray, ...] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}

    def ending(self, word: bytes) -> int:
        return ending_of(word, self.endings)

    def prepared(self) -> tuple[np.ndarray, ...]:
        """Per listed word its class, its part of the base score and its share of its class, as logarithms."""
        if self.tables is None:
            logs = np.log10(np.array(self.counts, np.float64) + 1)
            classes = np.arange(len(logs))
            share = np.zeros(len(logs))
            for word, i in self.numbers.items():
                if i >= self.own:
                    ending = self.ending(word)
                    classes[i] = self.first_ending + ending
                    share[i] = logs[i] - math.log10(self.class_sizes[ending])
            self.tables = classes.astype(np.uint16), logs - math.log10(self.tokens + self.types + 1), share
        return self.tables


def ending_of(word: bytes, endings: int) -> int:
    return crc32(word[-3:]) % endings


class Hmm:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    def log10_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probabilities of whole sequences by the scaled forward recursion.

        Sequences of similar length advance together; a position's scale is the probability of its symbol given all
        before it.
        """
        out = np.zeros(len(sequences))
        emit = np.ascontiguousarray(self.emit.T)
        for rows, steps, active in _blocks(sequences):
            total = np.zeros(len(rows))
            alpha = np.tile(self.start, (len(rows), 1))
            for t, symbols in enumerate(steps):
                n = active[t]
                alpha = alpha[:n] @ self.move if t else alpha[:n]
                alpha *= emit[symbols]
                scale = alpha.sum(axis=1)
                alpha /= scale[:, None]
                total[:n] += np.log10(scale)
            out[rows] = total
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions of the sequences (forward-backward), and their log10 probability."""
        states = len(self.start)
        starts, moves = np.zeros(states), np.zeros((states, states))
        emissions, total = np.zeros((states, self.emit.shape[1])), 0.0
        emit = np.ascontiguousarray(self.emit.T)
        for rows, steps, active in _blocks(sequences):
            alphas, scales = [], []
            alpha = np.tile(self.start, (len(rows), 1))
            for t, symbols in enumerate(steps):
                alpha = alpha[: active[t]] @ self.move if t else alpha[: active[t]]
                alpha = alpha * emit[symbols]
                scale = alpha.sum(axis=1)
                alpha /= scale[:, None]
                alphas.append(alpha)
                scales.append(scale)
            beta = np.ones((len(rows), states))
            gammas = [np.zeros(0)] * len(steps)
            for t in range(len(steps) - 1, -1, -1):
                n = active[t]
                gammas[t] = alphas[t] * beta[:n]
                if t:
                    # Sequences that end here start from one; all others bring their beta along.
                    weighted = beta[:n] * emit[steps[t]] / scales[t][:, None]
                    moves += alphas[t - 1][:n].T @ weighted * self.move
                    beta[:n] = weighted @ self.move.T
            starts += gammas[0].sum(axis=0)
            symbols, gamma = np.concatenate(steps), np.concatenate(gammas)
            for k in range(states):
                emissions[k] += np.bincount(symbols, weights=gamma[:, k], minlength=emissions.shape[1])
            total += float(np.log10(np.concatenate(scales)).sum())
        return starts, moves, emissions, total


def _blocks(sequences: list[np.ndarray]):
    """``rows, steps, active`` of blocks of sequences, longest first: the symbols of each step, and how many go on."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        tokens = np.cumsum(lengths[order[at:]])
        size = max(1, int(np.searchsorted(tokens, BLOCK_TOKENS, side="right")))
        rows = order[at : at + size]
        at += size
        own = lengths[rows]
        flat = np.concatenate([sequences[r] for r in rows.tolist()]).astype(np.int64)
        step = np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own)
        by_step = flat[np.argsort(step, kind="stable")]
        active = np.bincount(step)
        yield rows, np.split(by_step, np.cumsum(active)[:-1]), active.tolist()


def starting_model(sequences: list[np.ndarray], classes: int, states: int, prior: np.ndarray, seed: int) -> Hmm:
    """States from a mixture of unigrams over a few whole texts, so that Baum-Welch starts where texts differ."""
    random = np.random.default_rng(seed)
    counts = np.array([np.bincount(s, minlength=classes) for s in sequences], np.float64).reshape(-1, classes)
    emit = prior * random.uniform(0.5, 1.5, (states, classes))
    if len(counts):
        emit += 0.01 * counts[random.choice(len(counts), states, replace=len(counts) < states)]
    emit /= emit.sum(axis=1, keepdims=True)
    for _ in range(15 if len(counts) else 0):
        logs = counts @ np.log(emit).T
        share = np.exp(np.clip((logs - logs.max(axis=1, keepdims=True)) / 8, -50, 0))
        share /= share.sum(axis=1, keepdims=True)
        emit = share.T @ counts + 50.0 * prior
        emit /= emit.sum(axis=1, keepdims=True)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    return Hmm(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit)


class LanguageModel:
    """A vocabulary, the table of all training counts, and the states."""

    def __init__(self, vocabulary: Vocabulary, counts: DataFrame, hmm: Hmm | None = None):
        self.vocabulary, self.counts, self.hmm = vocabulary, counts, hmm


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case; blank, tab, line feed, vertical tab, form feed and carriage return separate."""
    return text.lower().split()


def fit_vocabulary(texts: DataFrame, listed: int, own: int, endings: int) -> LanguageModel:
    """Counts of all words of all training texts; at most ``listed`` of the most frequent come to the driver."""

    def counted(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        found = Counter(chain.from_iterable(map(words_of, binary_column(batch, "text"))))
        words = list(found)
        return np.zeros(len(words), np.int64), [
            pa.array(words, pa.binary()),
            pa.array(list(found.values()), pa.int64()),
            pa.array([ending_of(w, endings) for w in words], pa.int32()),
        ]

    partial = arrow_explode(texts, [], "word binary, n long, ending int", counted)
    counts = stored(partial.groupBy("word", "ending").agg(F.sum("n").alias("n")), "word-counts")
    ends = texts.count()
    frequent = _most_frequent(counts, listed)
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    vocabulary = Vocabulary(
        [word for word, _ in frequent], [n for _, n in frequent], own, endings, (tokens + ends, types + (ends > 0)), ends
    )
    for ending, n, kinds in counts.groupBy("ending").agg(F.sum("n"), F.count("*")).collect():  # endings rows at most
        vocabulary.class_sizes[ending] += n + kinds
    for word, n in frequent[:own]:
        vocabulary.class_sizes[ending_of(word, endings)] -= n + 1
    return LanguageModel(vocabulary, counts)


def _most_frequent(counts: DataFrame, listed: int) -> list[tuple[bytes, int]]:
    """The most frequent words down to a count that at most ``listed`` words reach, by falling count, then word.

    Counts are first summed up by levels (each number up to 1024, then 64 for every doubling), so that only words
    above the level come to the driver.
    """
    n = F.col("n").cast("double")
    level = F.when(n <= 1024, n).otherwise(F.lit(1024.0) + F.floor(64 * F.log2(n / 1024))).cast("long")
    leveled = counts.withColumn("level", level)
    found, least = 0, None
    for at, words in sorted(leveled.groupBy("level").count().collect(), reverse=True):  # a few thousand levels
        found += words
        if found > listed:
            break
        least = at
    if least is None:
        return []
    table = leveled.where(F.col("level") >= least).select("word", "n").toArrow()
    rows = zip(table["word"].to_pylist(), table["n"].to_pylist())
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def coded(texts: DataFrame, vocabulary: Vocabulary, carry: list[str]) -> DataFrame:
    """Texts as class numbers with the parts of the scores that the listed words decide, and the other words.

    ``base`` and ``share`` lack, for each of ``others``, the logarithm of its count plus one.
    """

    def encode(batch: pa.RecordBatch) -> list[pa.Array]:
        classes, base_part, share_part = vocabulary.prepared()
        numbers, first = vocabulary.numbers, vocabulary.first_ending
        least = -math.log10(vocabulary.tokens + vocabulary.types + 1)
        end_score = math.log10(vocabulary.ends + 1) + least
        known = np.array(vocabulary.counts, np.int64) > 0
        codes, base, share, tokens, found, others = [], [], [], [], [], []
        for value in binary_column(batch, "text"):
            words = words_of(value)
            number = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
            rare = np.nonzero(number < 0)[0].tolist()
            own = classes[number] if len(classes) else np.zeros(len(words), np.uint16)
            listed = number[number >= 0]
            unlisted = [words[i] for i in rare]
            endings = [vocabulary.ending(w) for w in unlisted]
            own[rare] = np.array(endings, np.int64) + first
            codes.append(np.append(own, np.uint16(vocabulary.classes - 1)).astype("<u2").tobytes())
            base.append(float(base_part[listed].sum()) + least * len(rare) + end_score)
            share.append(float(share_part[listed].sum()) - float(np.log10(vocabulary.class_sizes[endings]).sum() if endings else 0))
            tokens.append(len(words) + 1)
            found.append(int(known[listed].sum()) + (vocabulary.ends > 0))
            others.append([{"word": w, "times": n} for w, n in Counter(unlisted).items()])
        return [
            pa.array(codes, pa.binary()),
            pa.array(base),
            pa.array(share),
            pa.array(tokens, pa.int64()),
            pa.array(found, pa.int64()),
            pa.array(others, pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))),
        ]

    added = (
        "codes binary, base double, share double, n_tokens long, n_listed long, "
        "others array<struct<word: binary, times: long>>"
    )
    return arrow_append(texts, carry, added, encode)


def fit_hmm(
    codes: DataFrame,
    vocabulary: Vocabulary,
    states: int = 6,
    rounds: int = 3,
    segment: int = 512,
    start_rows: int = 800,
    smoothing: float = 200.0,
    seed: int = 9,
) -> Hmm:
    """Baum-Welch over all training texts (column ``codes``); each task sends its expected counts by class.

    Texts are cut into segments of ``segment`` tokens for training only, so that a task's texts advance together; the move
    from one segment to the next is not counted, and a segment's first token counts as a start. The starting point, and
    nothing else, comes from about ``start_rows`` distinct whole texts, chosen by hash. Emissions are smoothed with ``smoothing``
    pseudo-counts in proportion to the classes' counts, so every class has a positive probability in every state.
    """
    classes = vocabulary.classes
    prior = np.ones(classes)
    prior[: vocabulary.first_ending] += np.array(vocabulary.counts[: vocabulary.first_ending], np.float64)
    prior[vocabulary.first_ending : -1] = vocabulary.class_sizes
    prior[-1] += vocabulary.ends
    prior /= prior.sum()
    total = codes.count()
    share = min(1.0, start_rows / max(total, 1))
    picked = codes.where(F.pmod(F.xxhash64("codes"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("codes")
    # Copies of a text are picked all or none, and count once here.
    some = [np.frombuffer(bytes(r[0]), "<u2") for r in picked.distinct().collect()]
    hmm = starting_model(some, classes, states, prior, seed)
    names = [f"s{k}" for k in range(states)]

    for _ in range(rounds if total else 0):

        def expect(batch: pa.RecordBatch, hmm=hmm) -> tuple[np.ndarray, list[pa.Array]]:
            whole = [np.frombuffer(c, "<u2") for c in batch.column(0).to_pylist()]
            pieces = [w[i : i + segment] for w in whole for i in range(0, len(w), segment)]
            starts, moves, emissions, _ = hmm.expected(pieces)
            rows = np.concatenate((emissions.T, moves, starts[None, :]))
            used = np.nonzero(rows.any(axis=1))[0]
            return np.zeros(len(used), np.int64), [pa.array(used), *(pa.array(rows[used, k]) for k in range(states))]

        sent = arrow_explode(codes.select("codes"), [], "i long, " + ", ".join(f"{n} double" for n in names), expect)
        table = np.zeros((classes + states + 1, states))
        for i, *values in sent.groupBy("i").agg(*[F.sum(n) for n in names]).collect():  # classes + states + 1 rows
            table[i] = values
        emit = table[:classes].T + smoothing * prior
        move = table[classes : classes + states] + 1e-2
        start = table[-1] + 1e-2
        hmm = Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))
    return hmm


def score_texts(
    docs: DataFrame,
    held_out: Column,
    listed: int = 1 << 17,
    own: int = 1 << 13,
    endings: int = 1 << 10,
    states: int = 6,
    rounds: int = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The model learns from all rows that aren't ``held_out`` and scores all of them on their whole texts; a text's
    tokens are its words and one end. ``base_score`` is the sum of log10((c + 1) / (N + V + 1)) with the training
    counts c; ``score`` is the log10 probability of the text by the hidden Markov model, where a rare word has its
    class's probability times its share of the class. Both are finite for any text.

    Null texts count as empty and have the end alone. Null keys stay null; repeated rows are counted and scored each.
    Without training rows all counts are 0 and the states are alike. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out.alias("held_out"))
    model = fit_vocabulary(rows.where("not held_out").select("text"), listed, own, endings)
    vocabulary = model.vocabulary
    codes = coded(rows, vocabulary, ["key", "held_out"]).withColumn("row", F.monotonically_increasing_id())
    codes = stored(codes, "codes")
    hmm = fit_hmm(codes.where("not held_out"), vocabulary, states, rounds)

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        sequences = [np.frombuffer(c, "<u2") for c in batch.column(batch.schema.get_field_index("codes")).to_pylist()]
        return [pa.array(hmm.log10_likelihoods(sequences))]

    narrow = ["row", "key", "held_out", "base", "share", "n_tokens", "n_listed"]
    forward = arrow_append(codes.select(*narrow, "codes"), narrow, "forward double", scored)
    other = codes.select("row", F.explode("others").alias("other")).select("row", "other.word", "other.times")
    counts = model.counts.select(F.col("word").alias("counted"), "n")
    rare = (
        other.join(counts, F.col("word") == F.col("counted"))
        .groupBy(F.col("row").alias("of"))
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("logs"), F.sum("times").alias("seen"))
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return forward.join(rare, F.col("row") == F.col("of"), "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_listed") + F.coalesce("seen", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("forward") + F.col("share") + logs).alias("score"),
    )
