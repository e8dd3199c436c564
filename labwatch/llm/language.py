"""Language identification with error-correcting output codes over byte n-grams."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import arrow_append, arrow_explode, binary_column

ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
BLOCK_BYTES = 1 << 19
PAD = b"   "
# Of these bytes n-grams are made as they are; all other ASCII counts as a blank.
LETTERS = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
UNKNOWN = "und"


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """One row of -1 and 1 per class: every split of the classes for up to five, else random far-apart columns.

    With all splits any two rows differ in more than half the columns, so single wrong bits are corrected.
    """
    if classes < 2:
        return np.zeros((classes, 0), np.int8)
    if classes <= 5:
        columns = []
        for size in range(classes):
            for others in combinations(range(1, classes), size):
                column = -np.ones(classes, np.int8)
                column[[0, *others]] = 1
                if (column < 0).any():
                    columns.append(column)
        return np.stack(columns, axis=1)
    bits = math.ceil(10 * math.log2(classes))
    random = np.random.default_rng(seed)
    best, distance = None, -1
    for _ in range(200):
        code = np.where(random.random((classes, bits)) < 0.5, -1, 1).astype(np.int8)
        if (np.abs(code.sum(axis=0)) == classes).any():
            continue
        product = code.astype(int) @ code.T
        nearest = int((bits - product[~np.eye(classes, dtype=bool)]).min() // 2)
        if nearest > distance:
            best, distance = code, nearest
    return best


def gram_blocks(texts: list[bytes]):
    """``first, last, starts, hashes`` for runs of whole texts: the buckets of every n-gram, one array per order.

    Bucket ``BUCKETS`` stands for windows that reach beyond their text. A text above the block size is a run of its own.
    """
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= BLOCK_BYTES):
            size += len(texts[last]) + 4
            last += 1
        joined = b"".join(b" " + t.lower().translate(LETTERS) + PAD for t in texts[first:last])
        lengths = np.array([len(t) + 4 for t in texts[first:last]], np.int64)
        ends = np.cumsum(lengths)
        data = np.frombuffer(joined + PAD, np.uint8).astype(np.uint32)
        beyond = (ends[:, None] - np.arange(1, 4)).ravel()
        grams = []
        for order in ORDERS:
            mixed = data[: len(joined)] * np.uint32(0x9E3779B1)
            for k in range(1, order):
                mixed = (mixed ^ data[k : k + len(joined)]) * np.uint32(0x85EBCA6B) + np.uint32(order)
            bucket = (mixed >> np.uint32(17)).astype(np.int32)
            bucket[beyond] = BUCKETS
            grams.append(bucket)
        yield first, last, ends - lengths, grams
        first = last


class LanguageModel:
    """Learned languages, their codewords, a weight per bit, order and bucket, and the weight of each bit's vote."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, votes: np.ndarray, scales: np.ndarray):
        self.languages, self.code, self.weights, self.votes, self.scales = languages, code, weights, votes, scales

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """A row per text, a column per bit: the mean log-odds of its n-grams over the bit's scale."""
        out = np.zeros((len(texts), self.code.shape[1]))
        for first, last, starts, grams in gram_blocks(texts):
            lengths = np.diff(np.append(starts, len(grams[0]))) - 3
            for order, bucket in enumerate(grams):
                for bit in range(out.shape[1]):
                    out[first:last, bit] += np.add.reduceat(self.weights[bit, order][bucket], starts)
            out[first:last] /= (lengths * len(ORDERS))[:, None]
        return out / self.scales

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword by weighted loss, its share in (0, 1], and the loss by which the next one is farther."""
        if not self.code.shape[1]:
            rows = len(margins)
            return np.zeros(rows, np.int64), np.ones(rows), np.full(rows, np.inf)
        loss = np.stack(
            [(np.logaddexp(0, -4.0 * margins * self.code[c]) * self.votes[c]).sum(axis=1) for c in range(len(self.code))], axis=1
        )
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 4)
        ordered = np.sort(loss, axis=1)
        return loss.argmin(axis=1), 1.0 / share.sum(axis=1), ordered[:, 1] - ordered[:, 0]


def _sampled(docs: DataFrame, key: str, label: str, per_label: int, salt: int) -> DataFrame:
    """About ``per_label`` rows of each label at most, chosen by a hash of the key."""
    counts = {r[0]: r[1] for r in docs.groupBy(label).count().collect()}
    place = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    share: Column = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(label) == F.lit(name), F.lit(min(1.0, per_label / n))).otherwise(share)
    return docs.where(place < share)


def fit_languages(
    docs: DataFrame,
    rows_per_language: int = 8000,
    vote_rows: int = 1000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
) -> LanguageModel:
    """A model from labelled rows; rows with null text or label teach nothing.

    It is fitted on a bounded sample: about ``rows_per_language`` whole texts of each label for the n-gram counts
    and ``vote_rows`` for the votes, chosen by a hash of the key. Bit b's classifier is naive Bayes between the
    languages whose codeword has b and those that lack it, each language with equal say.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")
    )

    def counted(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array]]:
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        texts = binary_column(batch, "text")
        names = sorted(set(labels))
        totals = np.zeros((len(names), len(ORDERS), BUCKETS + 1), np.int64)
        for n, name in enumerate(names):
            for *_, grams in gram_blocks([t for t, own in zip(texts, labels) if own == name]):
                for order, bucket in enumerate(grams):
                    totals[n, order] += np.bincount(bucket, minlength=BUCKETS + 1)
        at = np.nonzero(totals[:, :, :BUCKETS])
        rows = np.array([labels.index(name) for name in names], np.int64)[at[0]]
        return rows, [pa.array((at[1] * BUCKETS + at[2]).astype(np.int32)), pa.array(totals[at])]

    sample = _sampled(known, "key", "label", rows_per_language, 1)
    grams = arrow_explode(sample, ["label"], "gram int, n long", counted)
    totals = grams.groupBy("label", "gram").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    languages = sorted(totals["label"].unique().tolist())
    code = codewords(len(languages))
    p = np.full((len(languages), len(ORDERS), BUCKETS + 1), 0.5)
    index = totals["label"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    gram = totals["gram"].to_numpy(np.int64)
    p[index, gram // BUCKETS, gram % BUCKETS] += totals["n"].to_numpy(np.float64)
    p /= p.sum(axis=2, keepdims=True)
    weights = np.zeros((code.shape[1], len(ORDERS), BUCKETS + 1), np.float32)
    for bit in range(code.shape[1]):
        weights[bit] = np.log(p[code[:, bit] > 0].mean(axis=0)) - np.log(p[code[:, bit] < 0].mean(axis=0))
    weights[:, :, BUCKETS] = 0
    model = LanguageModel(languages, code, weights, np.ones(code.shape) / max(1, code.shape[1]), np.ones(code.shape[1]))
    if not code.shape[1]:
        return model

    def voted(batch: pa.RecordBatch) -> list[pa.Array]:
        margins = model.margins(binary_column(batch, "text"))
        return [pa.array(margins.tolist(), pa.list_(pa.float64()))]

    bits = arrow_append(_sampled(known, "key", "label", vote_rows, 2), ["label"], "margins array<double>", voted)
    seen = (
        bits.select("label", F.posexplode("margins").alias("bit", "margin"))
        .groupBy("label", "bit")
        .agg(F.avg((F.col("margin") > 0).cast("double")), F.avg(F.abs("margin")))
        .collect()
    )
    right, size = np.full(code.shape, 0.5), np.ones(code.shape)
    for name, bit, above, mean in seen:
        if name in languages:
            row = languages.index(name)
            right[row, bit] = above if code[row, bit] > 0 else 1 - above
            size[row, bit] = mean
    model.scales = np.maximum(size.mean(axis=0), 1e-6)
    model.votes = (right + 1e-3) / (right + 1e-3).sum(axis=1, keepdims=True)
    return model


def identify_languages(
    docs: DataFrame, model: LanguageModel, ambiguous_below: float = 0.15, text: str = "text", carry: tuple = ("doc_id",)
) -> DataFrame:
    """``carry, lang_pred, score, ambiguous`` of every row, from its whole text alone.

    The language is the one whose codeword has the least weighted loss; score is its share among all of them, and
    ``ambiguous`` says that the next codeword is hardly farther. Texts that are null or have no letter, and all texts
    where nothing was learned, get ``und`` with score 0 and are ambiguous. Ties go to the smaller language.
    """

    def predicted(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = binary_column(batch, text)
        lettered = np.array([any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts], bool)
        if not model.languages:
            lettered[:] = False
        best, score, gap = model.decode(model.margins(texts))
        names = [model.languages[b] if known else UNKNOWN for b, known in zip(best.tolist(), lettered)]
        return [
            pa.array(names, pa.string()),
            pa.array(np.where(lettered, score, 0.0)),
            pa.array(~lettered | (gap < ambiguous_below)),
        ]

    return arrow_append(
        docs.select(*dict.fromkeys([*carry, text])), list(carry), "lang_pred string, score double, ambiguous boolean", predicted
    )
