"""Toxicity by maximum-scoring segments of token log-odds, calibrated with extreme-value statistics."""

from __future__ import annotations

from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_append, arrow_explode, binary_column, stored

BUCKETS = 1 << 20
PREFIXES = range(3, 8)
# Distinct words a task remembers; beyond it the memory is emptied, which changes time but no result.
REMEMBERED_WORDS = 200_000
EDGES = b".,;:!?\"'()[]"


def word_features(word: bytes) -> list[int]:
    """Buckets of a lower-cased word without punctuation at its edges, and of its beginnings of 3 to 7 bytes."""
    word = word.strip(EDGES)
    return [crc32(word + b"=") % BUCKETS] + [crc32(word[:k]) % BUCKETS for k in PREFIXES if len(word) >= k]


class Remembered(dict):
    """Numbers of words in order of appearance, with a value for each."""

    def __init__(self, value):
        super().__init__()
        self.value, self.values_of = value, []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.values_of)
        self.values_of.append(self.value(word))
        return number

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, text after text, and how many words each text has."""
        if len(self) > REMEMBERED_WORDS:
            self.clear()
            self.values_of.clear()
        split = [text.lower().split() for text in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = chain.from_iterable(split)
        return np.fromiter(map(self.__getitem__, words), np.int64, int(sizes.sum())), sizes


def best_segments(scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The largest sum of adjacent scores of each text, 0 if none is positive: one pass over running sums."""
    best = np.zeros(len(sizes))
    used = np.nonzero(sizes)[0]
    if not len(used):
        return best
    ends = np.cumsum(sizes)
    total = np.cumsum(scores, dtype=np.float64)
    before = np.concatenate(([0.0], total[:-1]))
    # Each text is shifted below all earlier ones, so a running minimum starts anew with it.
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = before[(ends - sizes)[text]]
    span = float(np.abs(total - first).max() + np.abs(before - first).max() + 1)
    lowest = np.minimum.accumulate(before - first - text * span) + text * span
    best[used] = np.maximum.reduceat(total - first - lowest, (ends - sizes)[used])
    return np.maximum(best, 0.0)


def all_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in linear time.

    Runs of one sign are summed first. Each positive run opens a candidate that is merged with earlier ones as long
    as joining raises its score.
    """
    if not len(scores):
        return []
    sign = scores > 0
    starts = np.concatenate(([0], np.nonzero(sign[1:] != sign[:-1])[0] + 1))
    ends = np.append(starts[1:], len(scores))
    sums = np.add.reduceat(scores.astype(np.float64), starts)
    found: list[list[float]] = []  # first, end, total before it, total at its end, index of the last one that lies lower
    total = 0.0
    for first, end, value in zip(starts.tolist(), ends.tolist(), sums.tolist()):
        low, total = total, total + value
        if value <= 0:
            continue
        one = [first, end, low, total, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= one[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= one[3]:
                one[4] = j
                found.append(one)
                break
            one = [found[j][0], one[1], found[j][2], one[3], -1]
            del found[j:]
    return [(int(f), int(e), high - low) for f, e, low, high, _ in found]


class ToxicityModel:
    """Log-odds per bucket, the extreme-value parameters, and the logistic that turns evidence into a probability."""

    def __init__(
        self, odds: np.ndarray, drift: float, decay: float, scale: float, logistic: np.ndarray, significance: float
    ):
        self.odds, self.drift, self.decay, self.scale = odds, drift, decay, scale
        self.logistic, self.significance = logistic, significance
        self.words: Remembered | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": None}

    def word_score(self, word: bytes) -> float:
        """The strongest log-odds among a word's buckets, less the drift."""
        return float(max(self.odds[word_features(word)].tolist(), key=abs)) - self.drift

    def token_scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A score per token, and each text's number of tokens; a word right after itself adds no evidence."""
        if self.words is None:
            self.words = Remembered(self.word_score)
        numbers, sizes = self.words.numbers(texts)
        scores = np.array(self.words.values_of, np.float64)[numbers]
        again = np.zeros(len(numbers), bool)
        again[1:] = numbers[1:] == numbers[:-1]
        # A text's first token has none before it, whatever text stands before it in the batch.
        again[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        scores[again] = -self.drift
        return scores, sizes

    def evidence(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int, float, float]]]]:
        """Per text its features, and its significant segments (first token, end, score, expected number by chance).

        Features are a constant, the best segment's log-evidence, that of all significant ones together, and
        log length.
        """
        scores, sizes = self.token_scores(texts)
        best = best_segments(scores, sizes)
        features = np.zeros((len(texts), 4))
        space = np.log(self.scale * np.maximum(sizes, 1))
        features[:, 0] = 1
        features[:, 1] = features[:, 2] = np.clip(self.decay * best - space, -10, 40)
        features[:, 3] = np.log1p(sizes) / 5
        segments: list[list[tuple[int, int, float, float]]] = [[] for _ in texts]
        ends = np.cumsum(sizes)
        limit = (space - np.log(self.significance)) / self.decay
        for i in np.nonzero((best > 0) & (best >= limit))[0].tolist():
            own = scores[ends[i] - sizes[i] : ends[i]]
            segments[i] = [
                (f, e, s, float(np.exp(space[i] - self.decay * s))) for f, e, s in all_segments(own) if s >= limit[i]
            ]
            features[i, 2] = np.clip(sum(self.decay * s - space[i] for *_, s, _ in segments[i]), -10, 80)
        return features, segments

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features @ self.logistic, -50, 50)))


def log_odds(toxic: np.ndarray, plain: np.ndarray, totals: tuple[float, float], prior: float, deviations: float) -> np.ndarray:
    """Log-odds with an informative Dirichlet prior, shrunk to 0 by some standard deviations.

    The prior's pseudo-counts are ``prior`` in all, in proportion to the corpus.
    """
    alpha = prior * (toxic + plain + 0.01) / max(sum(totals), 1.0)
    a, b = toxic + alpha, plain + alpha
    odds = np.log(a / (totals[0] + prior - alpha)) - np.log(b / (totals[1] + prior - alpha))
    spread = np.sqrt(1 / a + 1 / b)
    return np.clip(np.sign(odds) * np.maximum(np.abs(odds) - deviations * spread, 0), -4.0, 6.0).astype(np.float32)


def decay_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(decay * score)] = 1 over the background; needs a negative mean."""
    if not (scores[weights > 0] > 0).any():
        return 1.0
    p = weights / weights.sum()
    low, high = 0.0, 1.0
    while (p * np.exp(high * scores)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return max(high, 0.05)


def logistic_fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic regression."""
    beta = np.zeros(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (labels - p) - ridge * beta
        curve = (features * (p * (1 - p))[:, None]).T @ features + ridge * np.eye(len(beta))
        move = np.linalg.solve(curve, gradient)
        beta = beta + move / max(1.0, np.abs(move).max() / 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 30_000,
    prior: float = 500.0,
    deviations: float = 2.0,
    drift: float = 0.7,
    significance: float = 0.05,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """A model from labelled rows; rows without a label, and labels without a text, teach nothing.

    It is fitted on a bounded sample: about ``max_rows`` labelled keys, chosen by a hash. Three of four give the
    log-odds, from the number of texts each word occurs in; the others give the extreme-value scale (largest
    segments of texts labelled 0) and the logistic. A key with several labels counts as 1 where their mean is at
    least one half.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        (F.avg(F.col(label)) >= 0.5).cast("int").alias("_toxic")
    )
    n = known.count()
    place = F.pmod(F.xxhash64(F.lit(11), F.col("_key")), F.lit(1 << 30))
    chosen = known.where(place < F.lit(int(min(1.0, max_rows / max(n, 1)) * (1 << 30))))
    chosen = chosen.withColumn("_fold", F.pmod(F.xxhash64(F.lit(12), F.col("_key")), F.lit(4)).cast("int"))
    # At most about max_rows narrow rows, whatever the input: a proven bound for the broadcast.
    joined = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_key")
    )
    sample = joined.select("_text", "_toxic", "_fold")

    def counted(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        toxic = np.asarray(batch.column(1)).astype(bool)
        counts = np.zeros((2, BUCKETS), np.int64)
        words = Remembered(lambda word: np.array(word_features(word)))
        numbers, sizes = words.numbers(binary_column(batch, "_text"))
        for own, label in zip(np.split(numbers, np.cumsum(sizes)[:-1]), toxic.astype(int).tolist()):
            if len(own):
                present = np.unique(np.concatenate([words.values_of[n] for n in np.unique(own).tolist()]))
                counts[label, present] += 1
        bucket = np.nonzero(counts.any(axis=0))[0]
        return np.zeros(len(bucket), np.int64), [pa.array(bucket), pa.array(counts[1, bucket]), pa.array(counts[0, bucket])]

    found = arrow_explode(sample.where("_fold < 3"), [], "bucket long, toxic long, plain long", counted)
    summed = stored(found.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")), "odds")
    totals = tuple(float(v or 0) for v in summed.agg(F.sum("toxic"), F.sum("plain")).first())
    # Rarer buckets would shrink to 0; the number of buckets bounds what comes to the driver.
    often = summed.where(F.col("toxic") + F.col("plain") >= 3).toPandas()
    odds = np.zeros(BUCKETS, np.float32)
    toxic, plain = often["toxic"].to_numpy(np.float64), often["plain"].to_numpy(np.float64)
    odds[often["bucket"].to_numpy(np.int64)] = log_odds(toxic, plain, totals, prior, deviations)
    background = np.append(odds[often["bucket"].to_numpy(np.int64)], 0.0) - drift
    decay = decay_rate(background.astype(np.float64), np.append(plain, 1e-3))
    model = ToxicityModel(odds, drift, decay, 1.0, np.array([-3.0, 1.0, 0.0, 0.0]), significance)

    def measured(batch: pa.RecordBatch) -> list[pa.Array]:
        scores, sizes = model.token_scores(binary_column(batch, "_text"))
        return [pa.array(best_segments(scores, sizes)), pa.array(sizes)]

    rest = sample.where("_fold = 3 and _toxic = 0")
    largest = arrow_append(rest, [], "best double, size long", measured).agg(
        F.count("*"), F.sum(F.col("size") * F.exp(-F.lit(decay) * F.col("best")))
    )
    n, mass = largest.first()
    # The maximum-likelihood scale of a Gumbel law whose decay is known.
    model.scale = float(np.clip(n / mass, 1e-4, 10.0)) if n and mass else 1.0

    def explained(batch: pa.RecordBatch) -> list[pa.Array]:
        features, _ = model.evidence(binary_column(batch, "_text"))
        return [pa.array(features.tolist(), pa.list_(pa.float64()))]

    rows = arrow_append(sample.where("_fold = 3"), ["_toxic"], "features array<double>", explained).toPandas()  # max_rows / 4
    if rows["_toxic"].nunique() == 2:
        model.logistic = logistic_fit(np.array(rows["features"].tolist()), rows["_toxic"].to_numpy(np.float64))
    elif not totals[0]:
        model.logistic = np.array([-5.0, 0.0, 0.0, 0.0])
    return model


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text: str = "text", carry: tuple = ("doc_id",), segments: bool = True
) -> DataFrame:
    """``carry, score, predicted, segments`` of every row, from its whole text alone.

    Score is the probability of label 1, ``predicted`` is 1 from one half on. Segments are the significant toxic
    passages: first token, end (exclusive), score, and the number of such segments expected by chance in a text of
    that length. Null and empty texts have no tokens, and so no segment, and get the probability of no evidence.
    """

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        features, found = model.evidence(binary_column(batch, text))
        p = model.probability(features)
        out = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
        if segments:
            spans = [[{"first": f, "end": e, "score": s, "expected": x} for f, e, s, x in own] for own in found]
            out.append(pa.array(spans, SEGMENTS))
        return out

    added = "score double, predicted int"
    if segments:
        added += ", segments array<struct<first: long, end: long, score: double, expected: double>>"
    return arrow_append(docs.select(*dict.fromkeys([*carry, text])), list(carry), added, scored)


SEGMENTS = pa.list_(
    pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
)
