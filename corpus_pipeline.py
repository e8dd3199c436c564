"""The training-data pipeline: documents through the stages below, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labwatch.llm import stages
from labwatch.llm.common import stored, table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("jaccard_join", stages.one_of_each_group),
    ("suffix_dedup", stages.cut_repeated),
    ("mixing", stages.mix),
    ("packing", stages.pack_sequences),
]

# Fitted scores, suffix arrays and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage's result is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
