"""Connected components of links between 64-bit keys, by contraction in a few rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch.llm.common import stored


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, larger key first; loops and null ends are dropped."""
    return (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): root is the smallest node it is connected with.

    Each round moves every node that has a smaller neighbour to its smallest neighbour's smallest neighbour and
    carries the links along, until none is left. Keys should be hashes: in a random order descending runs are short,
    so each round leaves a fraction of the nodes. Only narrow rows are shuffled, with partial aggregation, so a hub
    costs one row per task; every round's tables are written.
    """
    current = stored(_ordered(links), "links")
    labels = current.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    for _ in range(max_rounds):
        if current.isEmpty():
            return stored(labels, "components")
        least = stored(current.groupBy("a").agg(F.min("b").alias("b")), "least")
        further = least.select(F.col("a").alias("via"), F.col("b").alias("beyond"))
        jump = least.join(further, F.col("b") == F.col("via"), "left").select(
            F.col("a").alias("was"), F.coalesce("beyond", "b").alias("now")
        )
        jump = stored(jump, "jumps")
        labels = labels.join(jump, F.col("root") == F.col("was"), "left").select(
            "node", F.coalesce("now", "root").alias("root")
        )
        other = jump.select(F.col("was").alias("was_b"), F.col("now").alias("now_b"))
        moved = current.join(jump, F.col("a") == F.col("was"), "left").join(other, F.col("b") == F.col("was_b"), "left")
        current = stored(_ordered(moved.select(F.coalesce("now", "a").alias("a"), F.coalesce("now_b", "b").alias("b"))), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
