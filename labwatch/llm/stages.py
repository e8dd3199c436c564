"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``, each on one of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import table, tokenizer_path
from labwatch.llm.jaccard import one_of_each
from labwatch.llm.mixing import mix_sources
from labwatch.llm.packing import pack, tokenize_pieces
from labwatch.llm.suffix_dedup import cut_repeats
from labwatch.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


# Rows of an Arrow batch: whole texts are long, and each task holds several batches on both sides.
BATCH_ROWS = "1024"


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns beyond those of the documents renamed, so that none clashes; and the old names.

    The session's Arrow batches are made smaller for whole texts; that changes memory, no result.
    """
    names = docs.columns
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.toDF(*[c if c in COLUMNS else f"_extra_{i}" for i, c in enumerate(names)]), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on all labelled ones of ``docs``, scores below one half."""
    plain, names = _apart(docs)
    model = fit_toxicity(plain, table(spark, sf_dir, "labels"))
    scored = score_toxicity(plain, model, carry=tuple(plain.columns), segments=False)
    return scored.where("predicted = 0").select(*plain.columns).toDF(*names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are alike by 0.8 or more."""
    plain, names = _apart(docs)
    return one_of_each(plain, size=5, num=80, den=100).select(*plain.columns).toDF(*names)


# Passages of over 50 words: shorter strings of bytes are left out of the search, then runs are held against the words.
REPEATED_BYTES = 240
REPEATED_WORDS = 51


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of over 50 words (and 240 bytes) that occur at two places."""
    plain, names = _apart(docs)
    chars = "n_chars" if "n_chars" in names else None
    return cut_repeats(plain, REPEATED_BYTES, chars=chars, words=REPEATED_WORDS).select(*plain.columns).toDF(*names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards sources' shares by the square root of their sizes, in a global random order."""
    plain, names = _apart(docs)
    return mix_sources(plain, epochs=1.0, temperature=0.5, seed=42).select(*plain.columns).toDF(*names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 4096."""
    plain, _ = _apart(docs)
    pieces = tokenize_pieces(plain, tokenizer_path(), capacity=4096, end_id=1)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digests, capacity=4096)
