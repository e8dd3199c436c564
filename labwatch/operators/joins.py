"""Joins that stay equi-joins.

No side is broadcast on trust. Dimension sides are left to the size check of
``spark.sql.autoBroadcastJoinThreshold`` (static and adaptive), or were counted by their caller; the
only other broadcasts are the hot-key list of :func:`join_back`, bounded by ``HOT_SHARE``, and the
patterns of :func:`pattern_join`, counted and sent in parts of at most ``PART_BYTES``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all lines, so at most HOT_SHARE keys can be hot.
HOT_SHARE = 100_000
# Keys below this many lines never count as hot.
HOT_FLOOR = 200_000

# Signs that make a LIKE pattern more than a literal.
WILDCARD = r"[%_\\]"


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Key equality of frames aliased ``l`` and ``s``; NULL equals NULL where a key can be NULL.

    Plain equality keeps an aggregate's partitioning usable, so it is used where it can be.
    """
    nullable = {f.name: f.nullable for f in left.schema.fields}
    out = F.lit(True)
    for key in keys:
        a, b = F.col(f"l.{key}"), F.col(f"s.{key}")
        may_be_null = nullable[key] or right.schema[key].nullable
        out = out & (a.eqNullSafe(b) if may_be_null else a == b)
    return out


def join_back(lines: DataFrame, stats: DataFrame, keys: list[str], weight: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Put per-key statistics on every line; NULL keys form a group.

    ``stats`` has one row per key of ``lines`` and the number of lines in ``weight``. Lines of hot
    keys never shuffle: they meet a broadcast list of at most ``HOT_SHARE`` rows. The others join
    on the key, where the largest group is a known small share.
    """
    total = stats.agg(F.sum(weight)).scalar()
    is_hot = (F.col(weight) > floor) & (F.col(weight) * HOT_SHARE > total)
    hot = F.broadcast(stats.filter(is_hot))
    cold = stats.filter(~is_hot)
    extra = [c for c in stats.columns if c not in keys]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        on = same_key(lines, stats, keys)
        return left.alias("l").join(right.alias("s"), on, "inner").select("l.*", *[F.col(f"s.{c}") for c in extra])

    # The hot lines are told apart by the same list, so every line takes exactly one of the ways.
    cold_lines = lines.alias("l").join(hot.select(*keys).alias("s"), same_key(lines, stats, keys), "left_anti")
    return joined(lines, hot).unionByName(joined(cold_lines, cold))


def band_join(
    df: DataFrame,
    dim: DataFrame,
    value: str,
    low: str,
    high: str,
    how: str = "left",
    width: int = 1,
) -> DataFrame:
    """Join a number to the inclusive bands holding it.

    Bands are spread over buckets of ``width`` and matched on the bucket, so no nested loop is
    needed. Columns ``low`` and ``high`` of ``dim`` are kept.
    """
    bucket = "__bucket"
    spread = dim.withColumn(
        bucket,
        F.explode(
            F.sequence(F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long"))
        ),
    )
    keyed = df.withColumn(bucket, F.floor(F.col(value) / width).cast("long"))
    condition = (F.col(f"f.{bucket}") == F.col(f"d.{bucket}")) & F.col(f"f.{value}").between(
        F.col(f"d.{low}"), F.col(f"d.{high}")
    )
    return (
        keyed.alias("f")
        .join(spread.alias("d"), condition, how)
        .select(*[F.col(f"f.{c}") for c in df.columns], *[F.col(f"d.{c}") for c in dim.columns])
    )


def dyadic_nodes(low: Column, high: Column) -> Column:
    """The fewest aligned ranges ``(level, number)`` of ``2 ** level`` integers that make up ``low`` to ``high``.

    There are at most two per level. From level to level the ends move inwards past ranges that stand alone.
    """
    def node(level: Column, number: Column) -> Column:
        return F.struct(level.cast("int").alias("level"), number.alias("number"))

    def step(state: Column, level: Column) -> Column:
        first, last = state["first"], state["last"]
        odd = (first <= last) & (F.pmod(first, F.lit(2)) == 1)
        even = (first <= last) & (F.pmod(last, F.lit(2)) == 0)
        alone = F.array_compact(F.array(F.when(odd, node(level, first)), F.when(even, node(level, last))))
        # Ends that have passed each other stay as they are, else shifting would bring them together again.
        open_ = first <= last
        return F.struct(
            F.when(open_, F.shiftright(F.when(odd, first + 1).otherwise(first), 1)).otherwise(first).alias("first"),
            F.when(open_, F.shiftright(F.when(even, last - 1).otherwise(last), 1)).otherwise(last).alias("last"),
            F.concat(state["nodes"], alone).alias("nodes"),
        )

    start = F.struct(
        low.cast("long").alias("first"),
        high.cast("long").alias("last"),
        F.array().cast("array<struct<level: int, number: bigint>>").alias("nodes"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), start, step, lambda state: state["nodes"])


def covering_join(
    df: DataFrame, dim: DataFrame, value: str, low: str, high: str, how: str = "left"
) -> DataFrame:
    """Join a number to the inclusive ranges of any width that hold it: ``band_join`` without buckets.

    A range is made up of at most two aligned ranges per power of two, and a number lies in one aligned range of each
    power that occurs, so both sides meet by an equi-join on power and number; each match comes once. The cost is the
    logarithm of the widths, not the widths. Ranges that end before they begin or have a NULL end hold nothing; ends and
    values beyond 64-bit integers fail. ``low`` and ``high`` of ``dim`` are kept. Ranges that lie outside of all values
    are left out before they are cut.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    least, most = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    usable = dim.where((F.col(low) <= F.col(high)) & (F.col(low) <= most) & (F.col(high) >= least))
    nodes = usable.select("*", F.inline(dyadic_nodes(F.floor(low), F.floor(high))).alias("__level", "__number"))
    # At most one value per power of two.
    powers = nodes.agg(F.collect_set("__level")).first()[0]
    whole = F.floor(F.col("__value")).cast("long")
    pick = F.array(*[F.struct(F.lit(p).alias("__level"), F.shiftright(whole, p).alias("__number")) for p in sorted(powers)])
    if not powers:
        pick = F.array().cast("array<struct<__level: int, __number: bigint>>")
    distinct = df.select(F.col(value).alias("__value")).where("__value is not null").distinct()
    spread = distinct.select("__value", F.inline(pick))
    condition = (F.col("p.__level") == F.col("n.__level")) & (F.col("p.__number") == F.col("n.__number"))
    held = F.col("p.__value").between(F.col(f"n.{low}"), F.col(f"n.{high}"))
    found = spread.alias("p").join(nodes.alias("n"), condition & held).select("p.__value", *[F.col(f"n.{c}") for c in dim.columns])
    return (
        df.alias("f")
        .join(found.alias("m"), F.col(f"f.{value}") == F.col("m.__value"), how)
        .select(*[F.col(f"f.{c}") for c in df.columns], *[F.col(f"m.{c}") for c in dim.columns])
    )


def interval_join(
    df: DataFrame,
    dim: DataFrame,
    value: str,
    low: str,
    high: str,
    how: str = "left",
    days: int = 7,
) -> DataFrame:
    """Join a date to the inclusive date intervals holding it, on buckets of ``days``."""
    numbered = dim.withColumns({"__low": F.unix_date(low), "__high": F.unix_date(high)})
    keyed = df.withColumn("__day", F.unix_date(F.col(value)))
    out = band_join(keyed, numbered, "__day", "__low", "__high", how, days)
    return out.drop("__day", "__low", "__high")


def literal_prefix(pattern: Column) -> Column:
    """What stands before a LIKE pattern's first wildcard."""
    return F.regexp_extract(pattern, r"^[^%_\\]*", 0)


# The longest run of letters that patterns with a wildcard first are looked up by.
RUN = 8
# Patterns that rows meet where they lie are broadcast in parts of about this size, a row's share as an object included.
PART_BYTES = 128_000_000
ROW_BYTES = 100
# Rows make their runs again for each part, up to this many parts; beyond, the runs are shuffled.
PARTS = 16
# Rows are told apart from their values where a value stands in more than this many of them.
REPEATS = 4
# Rows in fewer tasks than this, of more than so many rows each, are dealt out anew first: their runs are much work.
TASKS = 32
TASK_ROWS = 100_000


def longest_literal(pattern: Column) -> Column:
    """The longest stretch of a LIKE pattern without wildcards; empty where there is none."""
    parts = F.split(pattern, r"[%_\\]")
    return F.aggregate(parts, F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best))


def runs_of(text: Column, length: Column) -> Column:
    """The distinct runs of ``length`` letters of a text; none where it is shorter."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - length + 1, F.lit(1)))
    runs = F.array_distinct(F.transform(places, lambda at: F.substring(text, at, length)))
    return F.when(F.length(text) >= length, runs).otherwise(F.array().cast("array<string>"))


def only_holds(pattern: Column, literal: Column) -> Column:
    """Whether a LIKE pattern asks for nothing but that a text holds ``literal``, of at most ``RUN`` letters."""
    bare = F.regexp_replace(pattern, "^%+|%+$", "") == literal
    return bare & pattern.startswith("%") & pattern.endswith("%") & (F.length(literal) <= RUN)


def room_behind(pattern: Column, literal: Column) -> Column:
    """How many letters a LIKE pattern asks for behind ``literal``, wherever that stands; NULL where it asks for more.

    Only for literals of at most ``RUN`` letters. Their first place in a text has the most letters behind it.
    """
    bare = F.regexp_replace(pattern, "^%+", "")
    tail = F.substring(bare, F.length(literal) + 1, F.length(bare))
    loose = pattern.startswith("%") & bare.startswith(literal) & tail.rlike(r"\A[%_]*%[%_]*\z") & (F.length(literal) <= RUN)
    return F.when(loose, F.length(F.regexp_replace(tail, "%", "")))


def _rarest_runs(values: DataFrame, text: Column, patterns: DataFrame, any_long: Column) -> DataFrame:
    """Patterns with the run they are looked up by, ``__rarest``; a long literal that no value can hold is left out."""
    long_ = F.length("__literal") > RUN
    whole = patterns.where(~long_).withColumn("__rarest", F.col("__literal"))
    long_ones = patterns.where(long_)
    literals = long_ones.select(F.col("__literal").alias("__of_literal")).distinct()
    parts = literals.select("__of_literal", F.explode(runs_of(F.col("__of_literal"), F.lit(RUN))).alias("__part"))
    often = (
        values.where(any_long)
        .select(F.explode(runs_of(text, F.lit(RUN))).alias("__of"))
        .groupBy("__of")
        .agg(F.count(F.lit(1)).alias("__often"))
    )
    weighed = parts.join(often, F.col("__part") == F.col("__of"), "left").groupBy("__of_literal").agg(
        F.min(F.struct(F.coalesce("__often", F.lit(0)).alias("n"), "__part")).alias("__rare")
    )
    rare = weighed.where("__rare.n > 0").select("__of_literal", F.col("__rare.__part").alias("__rarest"))
    cut = long_ones.join(rare, F.col("__literal") == F.col("__of_literal")).drop("__of_literal")
    return whole.unionByName(cut)


def _by_runs(values: DataFrame, text: Column, patterns: DataFrame) -> DataFrame:
    """Values and patterns that share a run of the pattern's longest literal stretch, ``__literal``.

    A stretch of at most ``RUN`` letters is the run itself, so the values are indexed by their runs of the lengths that
    occur. A longer one is looked up by the rarest of its runs among the values; one that no value has meets none.
    ``__sure`` tells where sharing the run is all that LIKE asks for, which costs a compiled pattern per pair.
    """
    sizes = patterns.agg(F.collect_set(F.least(F.length("__literal"), F.lit(RUN)))).scalar()
    any_long = patterns.agg(F.coalesce(F.bool_or(F.length("__literal") > RUN), F.lit(False))).scalar()
    index = values.withColumn("__text", text).select("*", F.explode(sizes).alias("__size"))
    index = index.select(*values.columns, F.explode(runs_of(F.col("__text"), F.col("__size"))).alias("__run"))
    led = _rarest_runs(values, text, patterns, any_long).drop("__literal")
    return index.join(led, F.col("__run") == F.col("__rarest")).drop("__run", "__rarest")


def _in_place(
    df: DataFrame, pairs: Mapping[str, str], fold: Callable[[Column], Column], led: DataFrame, dim: list[str], said: Row
) -> DataFrame:
    """Rows and the patterns ``led`` that match, both with all their columns; the rows stay where they are.

    The patterns come to the rows in ``said.parts`` broadcasts. A row makes the runs of its text, each at its first place,
    and meets the patterns of each in its own task, so neither runs nor pairs are shuffled, sorted or kept.
    """
    names = {c: f"__dim{i}" for i, c in enumerate(dim)}
    first = next(iter(pairs))
    text = fold(F.col(first))
    known = df.where(F.col(first).isNotNull())
    led = led.withColumn("__room", room_behind(fold(F.col(pairs[first])), F.col("__literal"))).withColumnsRenamed(names)
    led = _rarest_runs(known, text, led, F.lit(True)) if max(said.sizes) > RUN else led.withColumn("__rarest", F.col("__literal"))
    led = led.select("__rarest", "__room", *names.values())
    places = known.withColumn("__text", text).select("*", F.expr("explode(sequence(1, greatest(length(__text), 1)))").alias("__at"))
    sizes = F.array(*[F.lit(n) for n in sorted({min(n, RUN) for n in said.sizes})])
    cut = places.select("*", F.explode(sizes).alias("__size")).where("__at + __size - 1 <= length(__text)")
    index = cut.withColumn("__run", F.expr("substring(__text, __at, __size)")).where("instr(__text, __run) = __at")
    held = F.lit(True)
    for value, pattern in pairs.items():
        like = F.call_function("like", fold(F.col(value)), fold(F.col(names[pattern])))
        if value == first:
            enough = F.expr("__at + __size - 1 + __room <= length(__text)")
            like = F.when(F.col("__room").isNotNull(), enough).otherwise(like)
        held = held & like
    out = [*[F.col(c) for c in df.columns], *[F.col(n).alias(c) for c, n in names.items()]]
    met = []
    for part in range(said.parts):
        dealt = F.pmod(F.xxhash64(F.to_json(F.struct(*names.values()))), F.lit(said.parts))
        some = led if said.parts == 1 else led.where(dealt == part)
        met.append(index.join(F.broadcast(some), F.col("__run") == F.col("__rarest")).where(held).select(*out))
    return reduce(DataFrame.unionAll, met)


def _said_of(marked: DataFrame, by_runs: Column, dim: list[str]) -> Row:
    """Of a dimension's patterns: the lengths of the literals that lead, how many are not led, and the parts to send."""
    width = F.octet_length(F.to_json(F.struct(*dim))) + F.octet_length("__literal") + ROW_BYTES
    return marked.agg(
        F.collect_set(F.when(by_runs, F.least(F.length("__literal"), F.lit(RUN + 1)))).alias("sizes"),
        F.count_if(~by_runs).alias("others"),
        F.coalesce(F.ceil(F.sum(F.when(by_runs, width)) / PART_BYTES), F.lit(0)).cast("int").alias("parts"),
    ).first()


def _rows_of(df: DataFrame, value: str) -> Row:
    """How many rows have a value, about how many values there are, and the tasks that read them."""
    seen = df.select(F.col(value).alias("value"), F.spark_partition_id().alias("task")).where("value is not null")
    return seen.agg(F.count("value").alias("rows"), F.approx_count_distinct("value").alias("kinds"), F.countDistinct("task").alias("tasks")).first()


def pattern_join(
    df: DataFrame, dim: DataFrame, pairs: Mapping[str, str], how: str = "left", ignore_case: bool = True
) -> DataFrame:
    """``df.value [I]LIKE dim.pattern`` for every pair ``{value: pattern}``.

    The distinct values meet the patterns by equi-joins, on the first pair's literal prefix in each of the prefix
    lengths that occur, and LIKE decides; the matches then join back on the values. Patterns that begin with a wildcard
    meet the values that hold their longest literal stretch, or of a long one its rarest run of letters; only those of
    nothing but wildcards meet all distinct values.

    An inner join of values that hardly repeat brings those patterns to the rows instead, in counted broadcasts, so what
    is shuffled does not grow with the runs or the matches. It counts both sides when it is called.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    fold: Callable[[Column], Column] = F.upper if ignore_case else (lambda c: c)
    first = next(iter(pairs))
    marked = dim.withColumns(
        {"__prefix": literal_prefix(fold(F.col(pairs[first]))), "__literal": longest_literal(fold(F.col(pairs[first])))}
    ).withColumn("__sure", only_holds(fold(F.col(pairs[first])), F.col("__literal")))
    by_runs = (F.length("__prefix") == 0) & (F.length("__literal") > 0)
    found = []
    if how == "inner":
        said = _said_of(marked, by_runs, dim.columns)
        rows = _rows_of(df, first) if 0 < said.parts <= PARTS else None
        if rows and rows.rows <= REPEATS * rows.kinds:
            led = marked.where(by_runs).select(*dim.columns, "__literal")
            tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            few = rows.tasks < min(TASKS, tasks) and rows.rows > TASK_ROWS * rows.tasks
            found = [_in_place(df.repartition(tasks) if few else df, pairs, fold, led, dim.columns, said)]
            if not said.others:
                return found[0]
            marked = marked.where(~by_runs)
    patterns = marked.where(~by_runs).drop("__literal")
    lengths = patterns.where("__prefix is not null").agg(F.collect_set(F.length("__prefix"))).scalar()
    values = df.select(*[F.col(v).alias(f"__{v}") for v in pairs]).distinct().where(F.col(f"__{first}").isNotNull())
    text = fold(F.col(f"__{first}"))
    spread = values.select("*", text.alias("__text")).select("*", F.explode(lengths).alias("__length"))
    keyed = spread.where("length(__text) >= __length").withColumn("__start", F.expr("substring(__text, 1, __length)"))
    met = keyed.join(patterns, F.col("__start") == F.col("__prefix"))
    columns = [*[f"__{v}" for v in pairs], *dim.columns]
    met = met.select(*columns, F.lit(False).alias("__sure"))
    if not found:
        met = met.unionByName(_by_runs(values, text, marked.where(by_runs)).select(*columns, "__sure"))
    for value, pattern in pairs.items():
        held = F.call_function("like", fold(F.col(f"__{value}")), fold(F.col(pattern)))
        met = met.where(F.col("__sure") | held if value == first else held)
    matches = met.select(*columns)
    condition = F.lit(True)
    for value in pairs:
        condition = condition & (F.col(f"f.{value}") == F.col(f"m.__{value}"))
    joined = (
        df.alias("f")
        .join(matches.alias("m"), condition, how)
        .select(*[F.col(f"f.{c}") for c in df.columns], *[F.col(f"m.{c}") for c in dim.columns])
    )
    return reduce(DataFrame.unionAll, [*found, joined])


def dense_grid(
    facts: DataFrame,
    axis: str,
    axis_values: DataFrame,
    entity: list[str],
    measures: list[str],
    fill: int | None = 0,
) -> DataFrame:
    """Every entity at every axis value, measures summed, ``fill`` where there are no facts.

    ``facts`` are aggregated already (about one row per entity and axis value) and the axis is a
    short calendar list. Each entity's cells are gathered once, blank cells of the whole axis are
    added, and both are summed on the partitioning that is there: no cross join, no second pass
    over the facts, one shuffle.
    """
    types = dict(facts.dtypes)
    blank = F.struct(F.col(axis), *[F.lit(fill).cast(types[m]).alias(m) for m in measures])
    blanks = axis_values.select(axis).agg(F.collect_set(blank)).scalar()
    cells = facts.groupBy(*entity).agg(F.collect_list(F.struct(axis, *measures)).alias("__cells"))
    spread = cells.select(*entity, F.inline(F.concat("__cells", blanks)))
    return spread.groupBy(*entity, axis).agg(*[F.sum(m).alias(m) for m in measures])


def assert_unique(dim: DataFrame, keys: list[str], name: str = "dimension") -> DataFrame:
    """Fail before an enrichment when a dimension key repeats, since the join would fan out."""
    keyed = dim.filter(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    repeated = keyed.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"{name}: repeated key {[tuple(r[k] for k in keys) for r in repeated]}")
    return dim
