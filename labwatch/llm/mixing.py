"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch.llm.common import stored

# The first 13 hexadecimal digits of an md5 are 52 bits: exact in a double.
UNIT = float(1 << 52)


def unit_draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the parts' texts (null counts as empty)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(UNIT)


def log_factorial(k: Column) -> Column:
    """ln k!, by the factorial up to 20 and by Stirling's series beyond, which is then exact to a double."""
    x = k.cast("double")
    series = (
        x * F.log(x)
        - x
        + F.log(x * F.lit(2 * pi)) / 2
        + 1 / (12 * x)
        - 1 / (360 * F.pow(x, F.lit(3)))
        + 1 / (1260 * F.pow(x, F.lit(5)))
        - 1 / (1680 * F.pow(x, F.lit(7)))
    )
    few = F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double")
    return F.when(k <= 20, F.log(few)).otherwise(series)


def poisson_laws(rates: DataFrame) -> DataFrame:
    """``_source, _from, _cdf`` of each ``_source, _rate``: cumulative probabilities of the counts from ``_from`` on.

    The counts reach twelve standard deviations and thirty more to both sides of the mean; what lies beyond is below any
    52-bit draw. So a law has as many terms as the square root of its mean, however large that is.
    """
    rate = F.col("_rate")
    reach = F.lit(12.0) * F.sqrt(rate) + 30
    first, last = F.greatest(F.floor(rate - reach), F.lit(0)).cast("long"), F.ceil(rate + reach).cast("long")
    terms = rates.where("_rate > 0").select("_source", "_rate", F.explode(F.sequence(first, last)).alias("_k"))
    mass = F.exp(F.col("_k") * F.log(rate) - rate - log_factorial(F.col("_k")))
    so_far = Window.partitionBy("_source").orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = terms.select("_source", "_k", F.sum(mass).over(so_far).alias("_total"))
    # Totals never fall, so their own order is that of the counts.
    laws = summed.groupBy("_source").agg(F.min("_k").alias("_from"), F.array_sort(F.collect_list("_total")).alias("_cdf"))
    never = rates.where("_rate <= 0").select("_source", F.lit(0).cast("long").alias("_from"), F.array(F.lit(1.0)).alias("_cdf"))
    return laws.unionByName(never)


def source_rates(
    docs: DataFrame, targets: DataFrame | None, epochs: float, temperature: float, source: str, text: str
) -> DataFrame:
    """``_source, _from, _cdf`` per source: the Poisson law of how often one of its documents is taken."""
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(
        F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).alias("_size")
    )
    if targets is None:
        shares = sizes.withColumn("_weight", F.pow(F.col("_size").cast("double"), F.lit(temperature)))
    else:
        named = targets.select(F.col("source").alias("_named"), F.col("weight").cast("double").alias("_given"))
        shares = sizes.join(named, F.col("_source").eqNullSafe(F.col("_named")), "left").select(
            "_source", "_size", F.coalesce("_given", F.lit(0.0)).alias("_weight")
        )
    # One row per source; a written table has a known size, so Spark itself decides how to join it.
    shares = stored(shares, "source-sizes")
    total = shares.agg(F.sum("_size"), F.sum(F.when(F.col("_size") > 0, F.col("_weight")))).first()
    size, weight = (float(v) if v else 0.0 for v in total)
    rate = F.when(
        (F.col("_size") > 0) & F.lit(weight > 0),
        F.lit(epochs * size) * F.col("_weight") / F.lit(weight or 1.0) / F.col("_size").cast("double"),
    ).otherwise(F.lit(0.0))
    rates = shares.select("_source", rate.alias("_rate"))
    return stored(poisson_laws(rates), "source-rates")


def mix_sources(
    docs: DataFrame,
    targets: DataFrame | None = None,
    epochs: float = 1.0,
    temperature: float = 0.5,
    seed: int = 42,
    shuffle: bool = True,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    copy: str = "copy",
    order: str = "shuffle_key",
) -> DataFrame:
    """Rows of ``docs``, each as often as its source's target asks, in one global random order.

    A source's mean repetition is ``epochs * all bytes * target share / its bytes``; shares come from ``targets``
    (source, weight; a source that isn't named has weight 0) or else from ``bytes ** temperature``. A document's
    count is the smallest k whose Poisson cumulative probability is above its draw, a hash of the seed and its key.
    Two columns are added: the copy's number from 1 and the 52-bit key of the global order.

    Null sources form a source of their own; a null or empty text weighs nothing, and a source of only such texts
    is dropped (its rate is 0). Rows that share a key draw the same count, a null key draws as the empty text.
    Empty tables give empty results. Input columns that clash with the two added ones are replaced.
    """
    docs = docs.drop(copy, order)
    rates = source_rates(docs, targets, epochs, temperature, source, text)
    draw = unit_draw(seed, F.col(key))
    joined = docs.join(rates, docs[source].eqNullSafe(F.col("_source")), "inner")
    times = F.col("_from") + F.size(F.filter("_cdf", lambda c: c <= F.col("_draw")))
    counted = joined.withColumn("_draw", draw).withColumn("_times", times).where("_times > 0")
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    place = (unit_draw(seed + 1, F.col(key), F.col(copy)) * F.lit(UNIT)).cast("long")
    mixed = copies.withColumn(order, place).drop("_source", "_from", "_cdf", "_draw", "_times")
    return mixed.orderBy(order, key, copy) if shuffle else mixed
