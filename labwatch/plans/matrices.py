"""Summary tables: a dozen parameterised builders and the registry of their exported forms.

Every builder reads wide rows (one per sample) or the cube of :func:`summary_cube`, filters the
wanted pathogen before aggregating, and aggregates once; nothing is unpivoted. Counts are additive,
so rates and the minimum-tests rule come last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import align_year, epi_year, month_name, quarter_label, week_month_label
from labwatch.functions.text import label
from labwatch.operators.aggregates import (
    completeness,
    count_where,
    fill_rate,
    observed_values,
    per_100k,
    pivot_fixed,
    positivity_metrics,
)
from labwatch.operators.joins import dense_grid
from labwatch.operators.shaping import tested
from labwatch.operators.windows import last_period, recent_days, recent_periods, running_total
from labwatch.session import stored

# Display names.
WEEKS = "Semanas epidemiológicas"
WEEK = "Semana epidemiológica"
RATE = "Positividade (%)"
POSITIVES, NEGATIVES, CASES = "Positivos", "Negativos", "Total de casos"
DISEASE_NAMES = {
    "DENV": "Dengue",
    "CHIKV": "Chikungunya",
    "OROV": "Oropouche",
    "ZIKV": "Zika",
    "YFV": "Febre amarela",
    "MAYV": "Mayaro",
    "WNV": "West Nile",
}
YEARS = [2022, 2023, 2024, 2025, 2026]
# Admissible kits by the first tested pathogen, in order.
SIX_PATHOGEN_RULE = [
    ("MAYV", ["mayv_pcr", "ns1_antigen", "igm_serum", "arbo_pcr_3"]),
    ("OROV", ["orov_pcr", "ns1_antigen", "igm_serum", "arbo_pcr_3"]),
    ("CHIKV", ["chikv_pcr", "ns1_antigen", "igm_serum", "arbo_pcr_3"]),
    ("ZIKV", ["zika_pcr", "ns1_antigen", "igm_serum", "arbo_pcr_3"]),
    ("WNV", ["ns1_antigen", "igm_serum", "arbo_pcr_3"]),
    ("YFV", ["yfv_pcr", "igm_serum"]),
]
TWO_PATHOGEN_RULE = [("DENV", vocab.DENV_KITS), ("CHIKV", vocab.CHIKV_KITS)]
# Horizons.
TWO_PATHOGEN_START = "2022-01-08"
MONTH_START = "2022-01"
DAY_START = "2022-01-01"
MAP_START = {"DENV": "2025-12-21", "CHIKV": "2026-02-01"}
YEAR_DAYS, SHORT_DAYS = 364, 70
KITS = {"DENV": vocab.DENV_KITS, "CHIKV": vocab.CHIKV_KITS}
DISEASES = {"DENV": "dengue", "CHIKV": "chikungunya"}


@dataclass(frozen=True)
class Summary:
    """Input of the builders: wide rows (or the cube and its count column) and parameters."""

    rows: DataFrame
    weight: str | None = None
    min_tests: int = vocab.MIN_TESTS
    estimates: DataFrame | None = None
    macroregions: DataFrame | None = None
    map_start: dict[str, str] = field(default_factory=lambda: dict(MAP_START))
    state_fill: float = 0.5
    history_fill: float = 0.7
    year_fill: float = 0.7
    years: tuple[int, ...] = tuple(YEARS)


CUBE_KEYS = [
    "lab_id",
    "test_kit",
    "epiweek_enddate",
    "epiweek_number",
    "month",
    "quarter_start",
    "age_group",
    "location_ibge_code",
    "location",
    "region",
    "state",
    "state_code",
    "lat",
    "long",
]


def summary_cube(rows: DataFrame) -> DataFrame:
    """Counts by everything the summaries group on; shared by all of them.

    Days are cut to the first day of their quarter, the only use of the day in any summary.
    """
    quarter = F.date_trunc("quarter", F.col("date_testing")).cast("date")
    return (
        rows.withColumn("quarter_start", quarter)
        .groupBy(*CUBE_KEYS, *vocab.RESULT_COLUMNS)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumnRenamed("quarter_start", "date_testing")
    )


def summary_from_cube(s: Summary) -> Summary:
    return replace(s, rows=summary_cube(s.rows), weight="n")


# --- shared steps ---------------------------------------------------------------------------


def result_of(pathogen: str) -> Column:
    return F.col(vocab.RESULT_OF[pathogen])


def direct(s: Summary, pathogen: str, *conditions: Column) -> DataFrame:
    """Rows tested for a pathogen by the kits that count for it."""
    rows = s.rows.filter(tested(result_of(pathogen)) & F.col("test_kit").isin(*KITS[pathogen]))
    for condition in conditions:
        rows = rows.filter(condition)
    return rows


def metrics(s: Summary, rows: DataFrame, pathogen: str, keys: list) -> DataFrame:
    return rows.groupBy(*keys).agg(*positivity_metrics(result_of(pathogen), s.min_tests, s.weight))


def percent(name: str = "posrate") -> Column:
    return F.col(name) * 100


def known(name: str) -> Column:
    return F.col(name) != vocab.MISSING


def since(name: str, text: str) -> Column:
    return F.col(name) >= F.lit(text).cast("date")


def kit_rule(rule: list[tuple[str, list[str]]], otherwise: bool) -> Column:
    """The first tested pathogen of a row selects its admissible kits."""
    out = None
    for pathogen, kits in rule:
        allowed = F.col("test_kit").isin(*kits)
        hit = tested(result_of(pathogen))
        out = F.when(hit, allowed) if out is None else out.when(hit, allowed)
    return out.otherwise(F.lit(otherwise))


def positives(s: Summary, pathogen: str) -> Column:
    return count_where(result_of(pathogen) == "Pos", s.weight)


# --- builders -------------------------------------------------------------------------------


def week_by_year(s: Summary, pathogen: str) -> DataFrame:
    """Positivity per week label, one column per epidemiological year."""
    keyed = metrics(
        s,
        direct(s, pathogen),
        pathogen,
        [week_month_label(F.col("epiweek_number")).alias("year"), epi_year("epiweek_enddate").alias("y")],
    )
    return pivot_fixed(keyed.withColumn("rate", percent()), ["year"], "y", {y: str(y) for y in s.years}, "rate")


def week_country(s: Summary, pathogen: str) -> DataFrame:
    return metrics(s, direct(s, pathogen), pathogen, ["epiweek_enddate"]).select(
        F.col("epiweek_enddate").alias(WEEKS),
        percent().alias(RATE),
        F.col("Pos").alias(POSITIVES),
        F.col("Neg").alias(NEGATIVES),
        F.col("totaltests").alias(CASES),
    )


def total_by_region(s: Summary, pathogen: str, period: str) -> DataFrame:
    """Tests per month or week, one column per region, 0 where there are none."""
    rows = direct(s, pathogen, known("region"))
    name = WEEKS
    if period == "month":
        rows, name = rows.filter(F.col("month") >= MONTH_START), "Ano-Mês"
    totals = metrics(s, rows, pathogen, [F.col(period).alias(name), "region"])
    return pivot_fixed(totals, [name], "region", {r: r for r in vocab.REGION_NAMES}, "totaltests", fill=0)


def week_by_state(s: Summary, pathogen: str = "DENV") -> DataFrame:
    """Positivity per week, one column per state filled in enough weeks."""
    rates = metrics(s, direct(s, pathogen), pathogen, ["epiweek_enddate", "state_code"])
    # The labels are needed before the pivot can be planned; the facts are read once for both.
    rates = stored(rates.select("epiweek_enddate", "state_code", percent().alias("rate")), "week-by-state")
    filled = fill_rate(rates, "state_code", "epiweek_enddate", F.col("rate") > 0)
    states = observed_values(filled.filter(F.col("fill_rate") >= s.state_fill), "state_code")
    reported = rates.filter(known("state_code")).withColumnRenamed("epiweek_enddate", WEEKS)
    return pivot_fixed(reported, [WEEKS], "state_code", {c: c for c in states}, "rate")


def week_by_age(s: Summary, pathogen: str, names: dict[str, str]) -> DataFrame:
    """Rate and counts per age band and week; ``names`` maps week, age, rate, pos, neg, total."""
    cells = metrics(s, direct(s, pathogen, known("age_group")), pathogen, ["epiweek_enddate", "age_group"])
    columns = {
        "age": F.col("age_group"),
        "week": F.col("epiweek_enddate"),
        "rate": percent(),
        "pos": F.col("Pos"),
        "neg": F.col("Neg"),
        "total": F.col("totaltests"),
    }
    return cells.select(*[columns[k].alias(v) for k, v in names.items()])


AGE_WEEK_LOWER = {
    "age": "faixas etárias",
    "week": "semana epidemiológica",
    "rate": "percentual",
    "pos": "positivos",
    "neg": "negativos",
    "total": "totaltests",
}
AGE_WEEK_UPPER = {
    "week": WEEK,
    "age": "Faixa etária",
    "rate": RATE,
    "pos": POSITIVES,
    "neg": NEGATIVES,
    "total": CASES,
}


def month_by_age(s: Summary, pathogen: str = "DENV") -> DataFrame:
    rows = direct(s, pathogen, known("age_group"))
    return rows.groupBy("month", F.col("age_group").alias("faixas_etárias")).agg(
        positives(s, pathogen).alias(DISEASE_NAMES[pathogen])
    )


def month_by_age_six(s: Summary) -> DataFrame:
    rows = s.rows.filter(kit_rule(SIX_PATHOGEN_RULE, True) & known("age_group"))
    order = ["CHIKV", "OROV", "ZIKV", "YFV", "MAYV", "WNV"]
    return rows.groupBy("month", F.col("age_group").alias("faixas_etárias")).agg(
        *[positives(s, p).alias(DISEASE_NAMES[p]) for p in order]
    )


def _cumulative(s: Summary, pathogen: str, entity: list[str], partition: str) -> DataFrame:
    start = s.map_start[pathogen]
    counts = F.coalesce(tested(result_of(pathogen)) & F.col("test_kit").isin(*KITS[pathogen]), F.lit(False))
    cells = s.rows.filter(since("epiweek_enddate", start)).groupBy("epiweek_enddate", *entity).agg(
        count_where(counts & (result_of(pathogen) == "Pos"), s.weight).alias("cases"), F.bool_or(counts).alias("__counts")
    )
    # The weeks of all rows and the places' counts come from one pass.
    cells = stored(cells, "weeks-of-map")
    weeks, facts = cells.select("epiweek_enddate").distinct(), cells.filter("__counts").drop("__counts")
    grid = dense_grid(facts, "epiweek_enddate", weeks, entity, ["cases"])
    return running_total(grid, [partition], "epiweek_enddate", "cases", "total")


def _population(s: Summary) -> DataFrame:
    """Population per municipality, keyed by the code behind ``BR``."""
    rows = s.macroregions.filter(F.col("ADM2_PCODE").ilike("BR%"))
    code = F.regexp_replace("ADM2_PCODE", "^BR", "").cast("int")
    return rows.select(
        code.alias("location_ibge_code"),
        F.col("DS_UF_SIGLA").alias("state_code"),
        F.col("Populacao").cast("int").alias("population"),
    )


def _map_numbers() -> list[Column]:
    return [
        F.col("cases").cast("int").alias("Exames positivos da última semana"),
        F.col("total").cast("int").alias("Exames positivos cumulativos"),
        per_100k("total", "population").alias("Positivos cumul. por 100.000 hab."),
    ]


def city_map(s: Summary, pathogen: str) -> DataFrame:
    """Weekly and cumulative positives of every city with a test, zero weeks included."""
    entity = ["location_ibge_code", "location", "state_code", "state", "lat", "long"]
    cells = _cumulative(s, pathogen, entity, "location_ibge_code")
    cells = cells.filter((F.col("total") > 0) & known("location") & known("state"))
    return cells.join(_population(s).drop("state_code"), "location_ibge_code", "left").select(
        F.col("epiweek_enddate").alias(WEEK),
        "location_ibge_code",
        F.col("location").alias("Nome do município"),
        F.col("state_code").alias("UF"),
        F.col("state").alias("Nome do estado"),
        "lat",
        "long",
        F.col("population").alias("População do município"),
        *_map_numbers(),
    )


def state_map(s: Summary, pathogen: str) -> DataFrame:
    cells = _cumulative(s, pathogen, ["state_code", "state"], "state_code")
    people = _population(s).groupBy("state_code").agg(F.sum("population").alias("population"))
    cells = cells.filter((F.col("total") > 0) & known("state"))
    return cells.join(people, "state_code", "left").select(
        F.col("epiweek_enddate").alias(WEEK),
        F.col("state_code").alias("UF"),
        F.col("state").alias("Nome do estado"),
        F.col("population").alias("População do estado"),
        *_map_numbers(),
    )


def _quarter_grid(s: Summary, rows: DataFrame, pathogens: list[str]) -> DataFrame:
    rows = rows.filter(known("age_group") & since("date_testing", DAY_START))
    facts = rows.groupBy(
        quarter_label("date_testing").alias("trimestre"), F.col("age_group").alias("faixas_etarias")
    ).agg(*[positives(s, p).cast("int").alias(DISEASE_NAMES[p]) for p in pathogens])
    # The quarters are read apart from the counts; made once, a row per quarter and band serves both.
    facts = stored(facts, "quarters")
    names = [DISEASE_NAMES[p] for p in pathogens]
    grid = dense_grid(facts, "trimestre", facts.select("trimestre"), ["faixas_etarias"], names, fill=None)
    return grid.select("trimestre", "faixas_etarias", *[F.col(n).cast("int").alias(n) for n in names])


def quarter_by_age(s: Summary, pathogen: str) -> DataFrame:
    """Positives per quarter and age band; every combination appears, NULL without tests."""
    return _quarter_grid(s, direct(s, pathogen), [pathogen])


def quarter_by_age_others(s: Summary) -> DataFrame:
    rows = s.rows.filter(F.col("test_kit").isin(*vocab.OTHER_KITS))
    return _quarter_grid(s, rows, ["OROV", "ZIKV", "YFV", "MAYV", "WNV"])


def state_quality(s: Summary, pathogen: str = "DENV") -> DataFrame:
    """Weekly positivity per state with the completeness classes of the state."""
    cells = metrics(
        s,
        direct(s, pathogen, since("epiweek_enddate", DAY_START)),
        pathogen,
        ["epiweek_enddate", "state_code", "region"],
    ).withColumn("rate", percent())
    classed = completeness(
        cells, "state_code", "epiweek_enddate", "rate", s.history_fill, s.year_fill, YEAR_DAYS
    )
    return (
        classed.filter(known("state_code") & known("region"))
        .select(
            F.col("epiweek_enddate").alias("semanas_epidemiologicas"),
            F.col("state_code").alias("Estado"),
            F.col("region").alias("Região"),
            F.col("rate").alias("Taxa de positividade"),
            F.col("totaltests").cast("int").alias("Total de testes realizados"),
            F.col("Pos").cast("int").alias("Total de positivos"),
            F.col("Neg").cast("int").alias("Total de negativos"),
            F.col("history_class").alias("Completude do histórico"),
            F.col("year_class").alias("Completude do ano"),
            F.col("final_class").alias("Completude final"),
        )
    )


def state_quality_history(s: Summary) -> DataFrame:
    return state_quality(s).filter(F.col("Completude final").isin("Apenas histórico", "Alta qualidade"))


def state_quality_recent(s: Summary) -> DataFrame:
    rows = recent_days(state_quality(s), "semanas_epidemiologicas", YEAR_DAYS)
    return rows.filter(F.col("Completude final").isin("Apenas 12 meses", "Alta qualidade"))


def against_estimates(s: Summary, pathogen: str, suffix: str = "") -> DataFrame:
    """Laboratory positivity beside national case estimates, per week; either side may be missing."""
    start = since("epiweek_enddate", DAY_START)
    cells = metrics(s, direct(s, pathogen, start), pathogen, ["epiweek_enddate", "region"])
    tests = F.sum("totaltests")
    country = F.when(tests >= s.min_tests, F.sum("Pos").cast("double") / tests * 100)
    regional = [
        F.max(F.when(F.col("region") == r, percent())).alias(f"{r} (Positividade)") for r in vocab.REGION_NAMES
    ]
    lab = cells.groupBy(F.col("epiweek_enddate").alias(WEEKS)).agg(
        country.alias("Brasil (Positividade)"), *regional
    )
    # The labels are needed before the pivot can be planned; the estimates are read once for both.
    dated = stored(s.estimates.filter(start), "estimates")
    states = observed_values(dated, "state_code")
    cases = F.col("casos_estimados").cast("long")

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, cases).otherwise(0))

    sums = {f"{r} (InfoDengue)": share(F.col("region") == r) for r in vocab.REGION_NAMES}
    sums.update({f"{c}{suffix}": share(F.col("state_code") == c) for c in states})
    national = (
        dated.filter(F.col("disease") == DISEASES[pathogen])
        .groupBy(F.col("epiweek_enddate").alias(WEEKS))
        .agg(*[v.alias(k) for k, v in sums.items()])
    )
    both = lab.join(national, WEEKS, "full_outer")
    return both.select(*lab.columns, *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(k) for k in sums])


def _two_rates(s: Summary) -> DataFrame:
    rows = s.rows.filter(since("epiweek_enddate", TWO_PATHOGEN_START) & kit_rule(TWO_PATHOGEN_RULE, False))
    rates = []
    for pathogen in ("DENV", "CHIKV"):
        rates.append(
            (positivity_metrics(result_of(pathogen), s.min_tests, s.weight)[3] * 100).alias(DISEASE_NAMES[pathogen])
        )
    return rows.groupBy("epiweek_enddate", "epiweek_number").agg(*rates)


def two_pathogens_week(s: Summary) -> DataFrame:
    return _two_rates(s).select(F.col("epiweek_enddate").alias("Semana"), "Dengue", "Chikungunya")


def two_pathogens_aligned(s: Summary) -> DataFrame:
    """Weeks of all years on one calendar year; one column per pathogen and year."""
    week = F.col("epiweek_enddate")
    columns = [
        F.when(F.year(week) == year, F.col(DISEASE_NAMES[p])).alias(f"{DISEASE_NAMES[p]} - {year}")
        for p in ("DENV", "CHIKV")
        for year in s.years
    ]
    return _two_rates(s).select(
        week.alias("semana_correta"),
        F.date_format(align_year(week, 2022), "yyyy-MM-dd").alias("semana_ajustada"),
        label(F.date_format(week, "dd"), "/", month_name(week)).alias("Semana"),
        *columns,
    )


def two_pathogens_label(s: Summary) -> DataFrame:
    return _two_rates(s).select(
        "epiweek_enddate",
        week_month_label(F.col("epiweek_number"), F.col("epiweek_enddate")).alias("semana"),
        "Dengue",
        "Chikungunya",
    )


def counts_by_lab(s: Summary) -> DataFrame:
    """Tested results per laboratory, kit, pathogen and result."""
    pairs = F.array(
        *[F.struct(F.lit(p).alias("pathogen"), F.col(c).alias("result")) for p, c in vocab.RESULT_OF.items()]
    )
    weight = F.lit(1) if s.weight is None else F.col(s.weight)
    # Count the wide rows first: the seven-fold spread then touches only their distinct patterns.
    packed = s.rows.groupBy("lab_id", "test_kit", *vocab.RESULT_COLUMNS).agg(F.sum(weight).alias("n"))
    long = packed.select("lab_id", "test_kit", "n", F.inline(pairs)).filter(F.col("result") != "NT")
    return long.groupBy("lab_id", "test_kit", "pathogen", "result").agg(F.sum("n").alias("count"))


# --- registry -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """A summary: its rows, the order of its export, and columns used only for that order."""

    rows: Callable[[Summary], DataFrame]
    order: tuple[str, ...]
    exported: bool = True
    hidden: tuple[str, ...] = ()

    def build(self, s: Summary) -> DataFrame:
        return self.rows(s).drop(*self.hidden)

    def ordered(self, s: Summary) -> DataFrame:
        """Rows in export order; a leading ``-`` sorts descending."""
        keys = [(F.col(f"`{c.lstrip('-')}`"), c.startswith("-")) for c in self.order]
        return self.rows(s).orderBy(*[k.desc() if down else k.asc() for k, down in keys]).drop(*self.hidden)


def _recent(build: Callable[[Summary], DataFrame], date: str, days: int) -> Callable[[Summary], DataFrame]:
    return lambda s: recent_days(build(s), date, days)


def _latest(build: Callable[[Summary], DataFrame], period: str, n: int) -> Callable[[Summary], DataFrame]:
    return lambda s: recent_periods(build(s), period, n)


def _last(build: Callable[[Summary], DataFrame]) -> Callable[[Summary], DataFrame]:
    return lambda s: last_period(build(s), WEEK)


def _of(build: Callable, *args) -> Callable[[Summary], DataFrame]:
    return lambda s: build(s, *args)


def _tables() -> dict[str, Table]:
    dengue_week, chik_week = _of(week_country, "DENV"), _of(week_country, "CHIKV")
    dengue_month, chik_month = _of(total_by_region, "DENV", "month"), _of(total_by_region, "CHIKV", "month")
    age_week = _of(week_by_age, "DENV", AGE_WEEK_LOWER)
    cities = {p: _of(city_map, p) for p in KITS}
    states = {p: _of(state_map, p) for p in KITS}
    by_week, by_month, by_age = (WEEKS,), ("Ano-Mês",), ("month", "faixas_etárias")
    by_age_week = ("semana epidemiológica", "-faixas etárias")
    by_city, by_state = (WEEK, "UF", "Nome do município"), (WEEK, "UF")
    by_quarter = ("trimestre", "-faixas_etarias")
    by_quality = ("semanas_epidemiologicas", "Estado")
    labelled = two_pathogens_label

    def unlabelled(days: int | None) -> Table:
        rows = labelled if days is None else _recent(labelled, "epiweek_enddate", days)
        return Table(rows, ("epiweek_enddate",), hidden=("epiweek_enddate",))

    return {
        "01_DENV_line_posrate_direct_week_country_years": Table(_of(week_by_year, "DENV"), ("year",)),
        "02_DENV_line_bar_posrate_posneg_direct_week_country_h": Table(dengue_week, by_week),
        "02_DENV_line_bar_posrate_posneg_direct_week_country_r": Table(
            _recent(dengue_week, WEEKS, YEAR_DAYS), by_week
        ),
        "03_DENV_bar_total_direct_months_regions_h": Table(dengue_month, by_month),
        "03_DENV_bar_total_direct_months_regions_r": Table(_latest(dengue_month, "Ano-Mês", 12), by_month),
        "03_DENV_bar_total_direct_weeks_regions": Table(_of(_weeks_of_regions, "DENV"), by_week),
        "04_DENV_line_posrate_direct_weeks_states": Table(week_by_state, by_week),
        "06_DENV_heat_posrate_agegroups_week_country_h": Table(age_week, by_age_week),
        "06_DENV_heat_posrate_agegroups_week_country_r": Table(
            _recent(age_week, "semana epidemiológica", YEAR_DAYS), by_age_week
        ),
        "07_DENV_barH_pos_agegroups_month_country_h": Table(month_by_age, by_age),
        "07_DENV_barH_pos_agegroups_month_country_r": Table(_latest(month_by_age, "month", 6), by_age),
        "08_Arbo_barH_pos_agegroups_month_country_h": Table(month_by_age_six, by_age),
        "08_Arbo_barH_pos_agegroups_month_country_r": Table(_latest(month_by_age_six, "month", 6), by_age),
        "11_DENV_map_pos_direct_cities_h": Table(cities["DENV"], by_city),
        "11_DENV_map_pos_direct_cities_r": Table(_last(cities["DENV"]), by_city),
        "11_DENV_map_pos_direct_states_h": Table(states["DENV"], by_state),
        "11_DENV_map_pos_direct_states_r": Table(_last(states["DENV"]), by_state),
        "12_CHIKV_map_pos_direct_cities_h": Table(cities["CHIKV"], by_city),
        "12_CHIKV_map_pos_direct_cities_r": Table(_last(cities["CHIKV"]), by_city),
        "12_CHIKV_map_pos_direct_states_h": Table(states["CHIKV"], by_state),
        "12_CHIKV_map_pos_direct_states_r": Table(_last(states["CHIKV"]), by_state),
        "14_CHIKV_line_posrate_direct_indirect_week_country_years": Table(_of(week_by_year, "CHIKV"), ("year",)),
        "15_CHIKV_line_bar_posrate_posneg_direct_indirect_week_country_h": Table(chik_week, by_week),
        "15_CHIKV_line_bar_posrate_posneg_direct_indirect_week_country_r": Table(
            _recent(chik_week, WEEKS, YEAR_DAYS), by_week
        ),
        "16_CHIKV_bar_total_direct_indirect_months_regions_h": Table(chik_month, by_month),
        "16_CHIKV_bar_total_direct_indirect_months_regions_r": Table(_latest(chik_month, "Ano-Mês", 12), by_month),
        "16_CHIKV_bar_total_direct_indirect_weeks_regions": Table(_of(_weeks_of_regions, "CHIKV"), by_week),
        "17_CHIKV_heat_posrate_direct_indirect_agegroups_week_country": Table(
            _of(week_by_age, "CHIKV", AGE_WEEK_UPPER), (WEEK, "Faixa etária")
        ),
        "18_DENV_barH_pos_agegroups_quarter_country": Table(_of(quarter_by_age, "DENV"), by_quarter),
        "19_CHIKV_barH_pos_agegroups_quarter_country": Table(_of(quarter_by_age, "CHIKV"), by_quarter),
        "20_ARBO_barH_pos_agegroups_quarter_country": Table(quarter_by_age_others, by_quarter),
        "21_DENV_heat_posrate_direct_weeks_states": Table(state_quality, by_quality),
        "21_DENV_heat_posrate_direct_weeks_states_h": Table(state_quality_history, by_quality),
        "21_DENV_heat_posrate_direct_weeks_states_r": Table(state_quality_recent, by_quality),
        "22_DENV_line_posrate_bar_pos_direct_week_country_infodengue": Table(
            _of(against_estimates, "DENV"), by_week
        ),
        "23_CHIKV_line_posrate_bar_pos_direct_week_country_infodengue": Table(
            _of(against_estimates, "CHIKV", " (InfoDengue)"), by_week
        ),
        "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_h": Table(two_pathogens_week, ("Semana",)),
        "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_r": Table(
            _recent(two_pathogens_week, "Semana", YEAR_DAYS), ("Semana",)
        ),
        "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_c": Table(
            _recent(two_pathogens_week, "Semana", SHORT_DAYS), ("Semana",)
        ),
        "25_DENV_CHIKV_line_posrate_direct_indirect_week_country_years": Table(
            two_pathogens_aligned, ("semana_ajustada",)
        ),
        "26_DENV_CHIKV_line_posrate_direct_week_country_years": Table(
            labelled, ("epiweek_enddate",), exported=False
        ),
        "26_DENV_CHIKV_line_posrate_direct_week_country_years_h": unlabelled(None),
        "26_DENV_CHIKV_line_posrate_direct_week_country_years_r": unlabelled(YEAR_DAYS),
        "26_DENV_CHIKV_line_posrate_direct_week_country_years_c": unlabelled(SHORT_DAYS),
        "matrix_ALL_count_by_labid_testkit_pathogen_result": Table(
            counts_by_lab, ("lab_id", "test_kit", "pathogen", "result")
        ),
    }


def _weeks_of_regions(s: Summary, pathogen: str) -> DataFrame:
    return total_by_region(s, pathogen, "epiweek_enddate")


TABLES = _tables()


def exported_tables(s: Summary) -> dict[str, Callable[[], DataFrame]]:
    """The exported summaries, in order, built on demand."""
    return {name: (lambda t=table: t.ordered(s)) for name, table in TABLES.items() if table.exported}
