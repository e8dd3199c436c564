"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Generated methods above this size are never compiled by the JVM's JIT.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "labwatch", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose driver and executors are one machine, may leave it unset: then it lies below the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.conf.get("spark.master", "").startswith("local"):
        base = spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/labwatch/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, for results used in several phases."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# Spark deletes an execution's shuffled files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """As ``stored``, dealt by ``key`` into as many buckets as a shuffle has partitions.

    Joins and aggregations on ``key`` read the buckets as they lie, without a shuffle, and what made the rows is deleted
    once they are written. Only a table can have buckets: its name is dropped again, its files stay.
    """
    spark = df.sparkSession
    buckets, cleaned = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get(CLEANUP, None)
    name = f"labwatch_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", scratch_dir(spark, label))
    spark.conf.set(CLEANUP, "true")
    try:
        writer.bucketBy(buckets, key).saveAsTable(name)
    finally:
        spark.conf.unset(CLEANUP) if cleaned is None else spark.conf.set(CLEANUP, cleaned)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows
