"""Finals -> combined table: union, age band, week, repaired place, geography; and what reads it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import epi_number, week_end, year_month
from labwatch.functions.text import kit_method, normalize_text, region_name
from labwatch.operators.joins import WILDCARD, band_join
from labwatch.operators.merge import union_feeds
from labwatch.operators.shaping import completed_weeks, or_missing, unpivot_results
from labwatch.schema import LAB_COLUMNS


def guarded(df: DataFrame, keys: list[str], name: str, literal: bool) -> DataFrame:
    """``df``, failing where it is used if a key repeats or, with ``literal``, holds a wildcard.

    All rows are checked, in the plan that reads them: one aggregate that a plan runs once, however often it reads the
    table, and whose answer its rows take along; they themselves are not shuffled for it. Rows whose whole key is NULL
    match nothing and may repeat.
    """
    wild = reduce(lambda x, y: x | y, [F.coalesce(F.col(k).cast("string").rlike(WILDCARD), F.lit(False)) for k in keys])
    present = F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    fault = F.when(F.bool_or(present & (F.col("__n") > 1)), F.lit(f"{name}: the key {keys} repeats"))
    if literal:
        fault = fault.when(F.bool_or(wild), F.lit(f"{name} holds wildcards; place repair takes literal names"))
    found = sizes.agg(fault.alias("__fault")).scalar()
    first, dtype = keys[0], df.schema[keys[0]].dataType
    value = F.when(found.isNotNull(), F.raise_error(found).cast(dtype)).otherwise(F.col(first))
    return df.withColumn(first, value)


@dataclass(frozen=True)
class Dimensions:
    """The lookup tables of the combined table; Spark's own size threshold decides how each is joined."""

    municipalities: DataFrame
    macroregions: DataFrame
    fix_state: DataFrame
    fix_location: DataFrame
    # Without them the fixed bands and the calendar arithmetic are used.
    age_groups: DataFrame | None = None
    # Set by ``verified``.
    checked: bool = False

    # Table -> (key columns, whether the keys are names that must hold no wildcards).
    KEYS = {
        "municipalities": (["NM_MUN_NORM", "NM_UF_NORM"], False),
        "macroregions": (["CO_UF", "ADM2_PCODE"], False),
        "fix_state": (["source_state"], True),
        "fix_location": (["source_location", "source_state"], True),
    }

    def verified(self) -> Dimensions:
        """The same tables with checks of keys and wildcards in their plans."""
        if self.checked:
            return self
        tables = {n: guarded(getattr(self, n), keys, n, literal) for n, (keys, literal) in self.KEYS.items()}
        return replace(self, checked=True, **tables)


def combine_feeds(finals: Mapping[str, DataFrame], distinct: bool = True, methods: DataFrame | None = None) -> DataFrame:
    """Union of the laboratories' finals with the method of each kit."""
    rows = union_feeds(finals, LAB_COLUMNS, distinct)
    if methods is None:
        return rows.withColumn("test_method", kit_method("test_kit"))
    return rows.join(methods.select("test_kit", "test_method"), "test_kit", "left").select(
        *rows.columns, "test_method"
    )


def add_age_group(df: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    if bands is not None:
        return band_join(df, bands, "age", "min_age", "max_age", width=10).drop("min_age", "max_age")
    out = None
    for name, low, high in vocab.AGE_BANDS:
        inside = F.col("age").between(low, high)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return df.withColumn("age_group", out)


def add_epiweek(df: DataFrame, first_year: int = 2018, last_year: int = 2027, date: str = "date_testing") -> DataFrame:
    """Week end, week number and month by date arithmetic; no week outside the calendar years."""
    known = F.year(F.date_sub(week_end(date), 3)).between(first_year, last_year)
    return df.withColumns(
        {
            "epiweek_enddate": F.when(known, week_end(date)),
            "epiweek_number": F.when(known, epi_number(date)),
            "month": year_month(date),
        }
    )


def fix_place(df: DataFrame, fix_state: DataFrame, fix_location: DataFrame) -> DataFrame:
    """Repair state and place names from two lookup tables of literal names.

    A place is looked up under its raw state or under its repaired state. Both lookups are
    equi-joins on upper-case names (cleaned text is upper case already); a place found under both states appears once per match.
    """
    states = fix_state.select(F.upper("source_state").alias("__s"), F.col("target_state").alias("__fixed"))
    places = fix_location.select(
        F.upper("source_location").alias("__l"),
        F.upper("source_state").alias("__s"),
        F.struct(F.col("target_location").alias("to")).alias("__hit"),
    )
    rows = df.withColumns({"location": normalize_text("location"), "state": normalize_text("state")})
    rows = rows.join(states, F.col("state") == F.col("__s"), "left").drop("__s")
    for name, state in (("__raw", F.col("state")), ("__rep", F.upper("__fixed"))):
        rows = rows.join(
            places.withColumnRenamed("__hit", name),
            (F.col("location") == F.col("__l")) & (state == F.col("__s")),
            "left",
        ).drop("__l", "__s")
    same = F.col("state").eqNullSafe(F.upper("__fixed"))
    hits = F.array_compact(F.array(F.col("__raw"), F.when(~same, F.col("__rep"))))
    spread = rows.withColumn("__hit", F.explode_outer(hits))
    return spread.withColumns(
        {
            "location": F.when(F.col("__hit").isNotNull(), F.col("__hit.to")).otherwise(F.col("location")),
            "state": F.coalesce(F.col("__fixed"), F.col("state")),
        }
    ).select(*df.columns)


def add_geography(df: DataFrame, municipalities: DataFrame, macroregions: DataFrame) -> DataFrame:
    """Official names and codes of a place."""
    areas = macroregions.select(
        F.col("CO_UF").alias("__uf"),
        F.col("ADM2_PCODE").alias("__code"),
        F.col("DS_NOMEPAD_macsaud").alias("macroregion"),
        F.col("CO_MACSAUD").alias("macroregion_code"),
    )
    places = municipalities.select(
        F.col("NM_MUN_NORM").alias("__place"),
        F.col("NM_UF_NORM").alias("__state"),
        F.col("NM_MUN").alias("location"),
        F.col("NM_UF").alias("state"),
        region_name("REGIAO").alias("region"),
        F.col("SIGLA_UF").alias("state_code"),
        F.col("CD_UF").alias("state_ibge_code"),
        F.col("CD_MUN").alias("location_ibge_code"),
        F.concat(F.lit("BR"), F.col("CD_MUN").cast("string")).alias("__area"),
        "lat",
        "long",
    )
    rows = df.withColumnsRenamed({"location": "__raw_place", "state": "__raw_state"})
    located = rows.join(
        places, (F.col("__raw_place") == F.col("__place")) & (F.col("__raw_state") == F.col("__state")), "left"
    )
    joined = located.join(
        areas, (F.col("state_ibge_code") == F.col("__uf")) & (F.col("__area") == F.col("__code")), "left"
    )
    return joined.withColumn("country", F.lit(vocab.COUNTRY)).drop(
        "__raw_place", "__raw_state", "__place", "__state", "__area", "__uf", "__code"
    )


def enrich(rows: DataFrame, dims: Dimensions) -> DataFrame:
    """Unioned finals -> combined: equi-joins with the dimensions, whatever their size.

    Dimensions below Spark's threshold are broadcast and the facts aren't shuffled; otherwise adaptive execution
    splits a place that holds much of the data.
    """
    dims = dims.verified()
    facts = add_epiweek(add_age_group(rows, dims.age_groups))
    fixed = fix_place(facts, dims.fix_state, dims.fix_location)
    return add_geography(fixed, dims.municipalities, dims.macroregions)


def combine(finals: Mapping[str, DataFrame], dims: Dimensions, distinct: bool = False) -> DataFrame:
    """Upserted finals are unique by sample, so the union needs no distinct by default."""
    return enrich(combine_feeds(finals, distinct), dims)


# Columns that point at a person, a sample or a delivery.
PRIVATE = ["sample_id", "test_id", "lab_id", "file_name", "patient_id", "qty_original_lines"]


def for_sharing(combined: DataFrame) -> DataFrame:
    return combined.drop(*PRIVATE)


SUMMARY_COLUMNS = ["sample_id", "test_kit", "epiweek_enddate", "epiweek_number", "lab_id", "month", "date_testing"]
PLACE_COLUMNS = ["location", "region", "state", "state_code", "country", "age_group"]


def summary_rows(combined: DataFrame, as_of: str, start: str = vocab.SUMMARY_START) -> DataFrame:
    """Rows of completed weeks with missing places and ages spelled out; results stay wide."""
    return combined.filter(completed_weeks("epiweek_enddate", as_of, start)).select(
        *SUMMARY_COLUMNS,
        "location_ibge_code",
        *[or_missing(c).alias(c) for c in PLACE_COLUMNS],
        "lat",
        "long",
        *vocab.RESULT_COLUMNS,
    )


def long_results(combined: DataFrame, as_of: str, start: str = vocab.SUMMARY_START) -> DataFrame:
    """One row per sample and pathogen; the wide results stay beside them."""
    rows = summary_rows(combined, as_of, start)
    pairs = F.array(
        *[F.struct(F.lit(p).alias("pathogen"), F.col(c).alias("result")) for p, c in vocab.RESULT_OF.items()]
    )
    return rows.select("*", F.inline(pairs))


def estimates_by_week(estimates: DataFrame, as_of: str, start: str = vocab.SUMMARY_START) -> DataFrame:
    weekly = add_epiweek(estimates, date="data_fimSE")
    return weekly.filter(completed_weeks("epiweek_enddate", as_of, start)).select(
        "disease",
        "epiweek_enddate",
        "epiweek_number",
        "month",
        "data_fimSE",
        "casos_estimados",
        "city_ibge_code",
        "city",
        "state_code",
        "state",
        "region",
    )


@dataclass(frozen=True)
class ReportCity:
    code: int = 3304557
    name: str = "Rio de Janeiro"
    state_code: str = "RJ"


def city_report(combined: DataFrame, city: ReportCity = ReportCity()) -> DataFrame:
    """Counts of one city's results per day, kit, age band, pathogen and result, without identities."""
    ids = ["date_testing", "test_kit", "age_group", "location_ibge_code"]
    rows = for_sharing(combined).filter(F.col("location_ibge_code") == city.code)
    long = unpivot_results(rows, ids).filter(F.col("result") != "NT")
    counts = long.groupBy(*ids, "pathogen", "result").agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "date_testing",
        "test_kit",
        "age_group",
        F.lit(city.name).alias("location"),
        F.lit(city.state_code).alias("state_code"),
        "location_ibge_code",
        "pathogen",
        "result",
        "count",
    )
