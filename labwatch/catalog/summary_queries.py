"""Summary tables on the bridge data; weekly cells are small there, so the minimum is five tests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame

from labwatch.catalog.aggregate_queries import melted
from labwatch.catalog.base import ORACLES, Tables, query
from labwatch.catalog.bridge import AS_OF, MIN_TESTS, raw_estimates, sql, summary
from labwatch.plans.combine import estimates_by_week
from labwatch.plans.matrices import TABLES, WEEKS, Summary, summary_cube, summary_from_cube
from labwatch.session import stored
from labwatch.sources.readers import cast_estimates

KITS = {"denv": "('arbo_pcr_3', 'ns1_antigen', 'denv_pcr')", "chikv": "('arbo_pcr_3', 'chikv_pcr', 'igm_serum')"}
REGIONS = ["Centro-Oeste", "Nordeste", "Norte", "Sudeste", "Sul"]
MAP_START = {"denv": "2025-12-21", "chikv": "2026-02-01"}
MONTHS = "['Jan', 'Fev', 'Mar', 'Abr', 'Mai', 'Jun', 'Jul', 'Ago', 'Set', 'Out', 'Nov', 'Dez']"
WEEK_LABEL = f"""concat('SE', lpad(CAST(epiweek_number AS VARCHAR), 2, '0'), ' - ',
    ({MONTHS})[len(list_filter([1, 5, 9, 13, 18, 22, 26, 31, 35, 39, 44, 48], lambda f: f <= epiweek_number))])"""
EPI_YEAR = "year(epiweek_enddate - 3)"


def rate(pathogen: str, minimum: int = MIN_TESTS, where: str = "") -> str:
    """Positivity in percent over the long rows of one pathogen."""
    scope = f"pathogen = '{pathogen.upper()}'{where}"
    tests = f"count(*) FILTER (result IN ('Pos', 'Neg') AND {scope})"
    return f"CASE WHEN {tests} >= {minimum} THEN count(*) FILTER (result = 'Pos' AND {scope}) / {tests} * 100 END"


def tally(pathogen: str, *results: str) -> str:
    listed = ", ".join(f"'{r}'" for r in results)
    return f"count(*) FILTER (result IN ({listed}) AND pathogen = '{pathogen.upper()}')"


def direct(pathogen: str, extra: str = "") -> str:
    return f"FROM long WHERE {pathogen}_test_result IN ('Pos', 'Neg') AND test_kit IN {KITS[pathogen]}{extra}"


def on_long(body: str, *views: str, **extra: str) -> str:
    return sql(body, "long", *views, **extra)


def recent(body: str, column: str, days: int) -> str:
    return f'SELECT * FROM ({body}) WHERE "{column}" > (SELECT max("{column}") FROM ({body})) - {days}'


def latest(body: str, column: str, n: int) -> str:
    months = f'SELECT DISTINCT "{column}" AS period FROM ({body})'
    return f'SELECT * FROM ({body}) WHERE "{column}" IN (SELECT period FROM ({months}) ORDER BY period DESC LIMIT {n})'


def last(body: str) -> str:
    column = "Semana epidemiológica"
    return f'SELECT * FROM ({body}) WHERE "{column}" = (SELECT max("{column}") FROM ({body}))'


def by_year(p: str) -> str:
    columns = ", ".join(f'{rate(p, where=f" AND {EPI_YEAR} = {y}")} AS "{y}"' for y in range(2022, 2027))
    return f"SELECT {WEEK_LABEL} AS year, {columns} {direct(p)} GROUP BY 1"


def week_country(p: str) -> str:
    return f"""SELECT epiweek_enddate AS "Semanas epidemiológicas", {rate(p)} AS "Positividade (%)", {tally(p, "Pos")} AS "Positivos",
        {tally(p, "Neg")} AS "Negativos", {tally(p, "Pos", "Neg")} AS "Total de casos" {direct(p)} GROUP BY 1"""


def by_region(p: str, period: str, name: str, extra: str = "") -> str:
    tests = tally(p, "Pos", "Neg")
    columns = ", ".join(f"""{tests[:-1]} AND region = '{r}') AS "{r}" """ for r in REGIONS)
    return f"""SELECT {period} AS "{name}", {columns} {direct(p, f" AND region <> 'NOT REPORTED'{extra}")} GROUP BY 1"""


def by_age_week(p: str, names: list[str]) -> str:
    columns = ["age_group", "epiweek_enddate", rate(p), tally(p, "Pos"), tally(p, "Neg"), tally(p, "Pos", "Neg")]
    listed = ", ".join(f'{c} AS "{n}"' for c, n in zip(columns, names))
    return f"SELECT {listed} {direct(p, chr(32) + 'AND age_group <> ' + chr(39) + 'NOT REPORTED' + chr(39))} GROUP BY age_group, epiweek_enddate"


def by_age_month() -> str:
    return f"""SELECT month, age_group AS "faixas_etárias", {tally("denv", "Pos")} AS "Dengue"
        {direct("denv", " AND age_group <> 'NOT REPORTED'")} GROUP BY 1, 2"""


def six_pathogens() -> str:
    order = [("MAYV", "mayv_pcr"), ("OROV", "orov_pcr"), ("CHIKV", "chikv_pcr"), ("ZIKV", "zika_pcr")]
    cases = " ".join(
        f"WHEN {p}_test_result IN ('Pos', 'Neg') THEN test_kit IN ('{kit}', 'ns1_antigen', 'igm_serum', 'arbo_pcr_3')"
        for p, kit in order
    )
    cases += " WHEN wnv_test_result IN ('Pos', 'Neg') THEN test_kit IN ('ns1_antigen', 'igm_serum', 'arbo_pcr_3')"
    cases += " WHEN yfv_test_result IN ('Pos', 'Neg') THEN test_kit IN ('yfv_pcr', 'igm_serum')"
    names = {"chikv": "Chikungunya", "orov": "Oropouche", "zikv": "Zika", "yfv": "Febre amarela", "mayv": "Mayaro", "wnv": "West Nile"}
    columns = ", ".join(f'{tally(p, "Pos")} AS "{n}"' for p, n in names.items())
    return f"""SELECT month, age_group AS "faixas_etárias", {columns} FROM long
        WHERE CASE {cases} ELSE TRUE END AND age_group <> 'NOT REPORTED' GROUP BY 1, 2"""


NUMBERS = """CAST(cases AS INTEGER) AS "Exames positivos da última semana", CAST(total AS INTEGER) AS "Exames positivos cumulativos",
    CASE WHEN population <> 0 THEN CAST(total AS DOUBLE) / population * 100000 END AS "Positivos cumul. por 100.000 hab." """


def cumulative(p: str, entity: str, key: str) -> str:
    start = f"epiweek_enddate >= DATE '{MAP_START[p]}'"
    return f"""SELECT w.epiweek_enddate AS week, e.*, coalesce(f.cases, 0) AS cases,
        sum(coalesce(f.cases, 0)) OVER (PARTITION BY e.{key} ORDER BY w.epiweek_enddate) AS total
        FROM (SELECT DISTINCT epiweek_enddate FROM weekly WHERE {start}) w
        CROSS JOIN (SELECT DISTINCT {entity} {direct(p, f" AND {start}")}) e
        LEFT JOIN (SELECT epiweek_enddate, {key}, {tally(p, "Pos")} AS cases {direct(p, f" AND {start}")} GROUP BY 1, 2) f
            ON f.epiweek_enddate = w.epiweek_enddate AND f.{key} = e.{key}"""


def city_map(p: str) -> str:
    cells = cumulative(p, "location_ibge_code, location, state_code, state, lat, long", "location_ibge_code")
    return f"""SELECT week AS "Semana epidemiológica", location_ibge_code, location AS "Nome do município", state_code AS "UF",
        state AS "Nome do estado", lat, long, population AS "População do município", {NUMBERS}
        FROM ({cells}) LEFT JOIN (SELECT "ADM2_PCODE" AS code, "Populacao" AS population FROM macros) m
            ON m.code = 'BR' || CAST(location_ibge_code AS VARCHAR)
        WHERE total > 0 AND location <> 'NOT REPORTED' AND state <> 'NOT REPORTED'"""


def state_map(p: str) -> str:
    cells = cumulative(p, "state_code, state", "state_code")
    return f"""SELECT week AS "Semana epidemiológica", state_code AS "UF", state AS "Nome do estado",
        population AS "População do estado", {NUMBERS}
        FROM ({cells}) LEFT JOIN (SELECT "DS_UF_SIGLA" AS uf, CAST(sum("Populacao") AS BIGINT) AS population FROM macros GROUP BY 1) m
            ON m.uf = state_code WHERE total > 0 AND state <> 'NOT REPORTED'"""


QUARTER = "concat(year(date_testing), ' - ', quarter(date_testing), 'º Trimestre')"


def quarter_grid(source: str, names: dict[str, str]) -> str:
    """``source`` is the FROM ... WHERE part of the rows that take part."""
    columns = ", ".join(f'CAST({tally(p, "Pos")} AS INTEGER) AS "{n}"' for p, n in names.items())
    scope = f"{source} AND age_group <> 'NOT REPORTED' AND date_testing >= DATE '2022-01-01'"
    picked = ", ".join(f'f."{n}"' for n in names.values())
    return f"""SELECT q.trimestre, a.age_group AS faixas_etarias, {picked}
        FROM (SELECT DISTINCT {QUARTER} AS trimestre {scope}) q CROSS JOIN (SELECT DISTINCT age_group {scope}) a
        LEFT JOIN (SELECT {QUARTER} AS trimestre, age_group, {columns} {scope} GROUP BY 1, 2) f
            ON f.trimestre = q.trimestre AND f.age_group = a.age_group"""


STATE_MIN, STATE_FILL = 1, 0.4
YEAR_FILL = 0.5


def state_cells() -> str:
    return f"SELECT epiweek_enddate, state_code, region, {rate('denv', STATE_MIN)} AS rate, {tally('denv', 'Pos')} AS pos, {tally('denv', 'Neg')} AS neg {direct('denv')} GROUP BY 1, 2, 3"


def week_states() -> str:
    return """SELECT w.epiweek_enddate AS "Semanas epidemiológicas", g.state_code AS label,
        max(CASE WHEN c.state_code <> 'NOT REPORTED' THEN rate END) AS value
        FROM (SELECT DISTINCT epiweek_enddate FROM cells WHERE state_code <> 'NOT REPORTED') w CROSS JOIN good g
        LEFT JOIN cells c ON c.epiweek_enddate = w.epiweek_enddate AND c.state_code = g.state_code GROUP BY ALL"""


GOOD_STATES = f"""SELECT state_code FROM cells GROUP BY 1
    HAVING count(*) FILTER (rate > 0) / (SELECT count(DISTINCT epiweek_enddate) FROM cells) >= {STATE_FILL}"""


def state_quality() -> str:
    h = f"(SELECT count(rate) FROM cells x WHERE x.state_code = c.state_code) / (SELECT count(DISTINCT epiweek_enddate) FROM cells)"
    since = "epiweek_enddate >= (SELECT max(epiweek_enddate) FROM cells) - 364"
    y = f"""(SELECT CASE WHEN count(*) > 0 THEN count(rate) END FROM cells x WHERE x.state_code = c.state_code AND x.{since})
        / (SELECT count(DISTINCT epiweek_enddate) FROM cells WHERE {since})"""
    return f"""SELECT epiweek_enddate AS semanas_epidemiologicas, state_code AS "Estado", region AS "Região", rate AS "Taxa de positividade",
        CAST(pos + neg AS INTEGER) AS "Total de testes realizados", CAST(pos AS INTEGER) AS "Total de positivos",
        CAST(neg AS INTEGER) AS "Total de negativos",
        CASE WHEN h >= {YEAR_FILL} THEN 'Bom Histórico' ELSE 'Ruim histórico' END AS "Completude do histórico",
        CASE WHEN y >= {YEAR_FILL} THEN 'Bom 12 meses' ELSE 'Ruim 12 meses' END AS "Completude do ano",
        CASE WHEN h >= {YEAR_FILL} AND y >= {YEAR_FILL} THEN 'Alta qualidade' WHEN h < {YEAR_FILL} AND y < {YEAR_FILL} THEN 'Baixa qualidade'
            WHEN h >= {YEAR_FILL} AND y < {YEAR_FILL} THEN 'Apenas histórico' ELSE 'Apenas 12 meses' END AS "Completude final"
        FROM cells JOIN (SELECT state_code, {h} AS h, {y} AS y FROM (SELECT DISTINCT state_code FROM cells) c) USING (state_code)
        WHERE state_code <> 'NOT REPORTED' AND region <> 'NOT REPORTED'"""


def against_estimates(p: str, disease: str, suffix: str) -> str:
    """Plain rows (week, label, value) of what the wide table has as columns."""
    week = "Semanas epidemiológicas"
    rates = {"Brasil": rate(p)} | {r: rate(p, where=f" AND region = '{r}'") for r in REGIONS}
    lab = ", ".join(f'{body} AS "{name}"' for name, body in rates.items())
    lab = f"SELECT epiweek_enddate, {lab} {direct(p)} GROUP BY 1"
    shown = " UNION ALL ".join(
        f"""SELECT w.epiweek_enddate, '{name} (Positividade)' AS label, CAST("{name}" AS DOUBLE) AS value
            FROM weeks w LEFT JOIN lab l ON l.epiweek_enddate = w.epiweek_enddate"""
        for name in rates
    )
    cases = f"""SELECT epiweek_enddate, region, state_code, casos_estimados AS n FROM estimates_weekly WHERE disease = '{disease}'"""
    labels = " UNION ALL ".join(f"SELECT '{r} (InfoDengue)' AS label, '{r}' AS region, NULL AS state_code" for r in REGIONS)
    states = f"SELECT DISTINCT concat(state_code, '{suffix}') AS label, NULL AS region, state_code FROM estimates_weekly WHERE state_code IS NOT NULL"
    return f"""SELECT epiweek_enddate AS "{week}", label, value FROM (
        WITH lab AS ({lab}), cases AS ({cases}),
        weeks AS (SELECT epiweek_enddate FROM lab UNION SELECT epiweek_enddate FROM cases),
        labels AS ({labels} UNION ALL {states})
        {shown} UNION ALL
        SELECT w.epiweek_enddate, l.label, CAST(coalesce(sum(c.n), 0) AS DOUBLE) AS value FROM weeks w CROSS JOIN labels l
        LEFT JOIN cases c ON c.epiweek_enddate = w.epiweek_enddate AND (c.region = l.region OR c.state_code = l.state_code)
        GROUP BY 1, 2)"""


TWO = """FROM long WHERE epiweek_enddate >= DATE '2022-01-08' AND CASE
    WHEN denv_test_result IN ('Pos', 'Neg') THEN test_kit IN ('arbo_pcr_3', 'denv_pcr', 'ns1_antigen')
    WHEN chikv_test_result IN ('Pos', 'Neg') THEN test_kit IN ('arbo_pcr_3', 'chikv_pcr', 'igm_serum') ELSE FALSE END"""


def two_week() -> str:
    return f"""SELECT epiweek_enddate AS "Semana", {rate("denv")} AS "Dengue", {rate("chikv")} AS "Chikungunya" {TWO} GROUP BY 1"""


def two_aligned() -> str:
    columns = ", ".join(
        f'CASE WHEN year(epiweek_enddate) = {y} THEN {rate(p)} END AS "{n} - {y}"'
        for p, n in (("denv", "Dengue"), ("chikv", "Chikungunya"))
        for y in range(2022, 2027)
    )
    return f"""SELECT epiweek_enddate AS semana_correta, CASE strftime(epiweek_enddate, '%m-%d') WHEN '02-29' THEN '2022-02-28'
        ELSE strftime(epiweek_enddate, '2022-%m-%d') END AS semana_ajustada,
        strftime(epiweek_enddate, '%d/') || ({MONTHS})[month(epiweek_enddate)] AS "Semana", {columns} {TWO} GROUP BY epiweek_enddate"""


def two_label(days: int | None = None, dated: bool = False) -> str:
    body = f"""SELECT epiweek_enddate, concat({WEEK_LABEL}, strftime(epiweek_enddate, '%y')) AS semana, {rate("denv")} AS "Dengue",
        {rate("chikv")} AS "Chikungunya" {TWO} GROUP BY epiweek_enddate, epiweek_number"""
    if days is not None:
        body = recent(body, "epiweek_enddate", days)
    return body if dated else f"SELECT * EXCLUDE (epiweek_enddate) FROM ({body})"


BY_LAB = "SELECT lab_id, test_kit, pathogen, result, count(*) AS count FROM long WHERE result <> 'NT' GROUP BY ALL"
LOWER = ["faixas etárias", "semana epidemiológica", "percentual", "positivos", "negativos", "totaltests"]
UPPER = ["Faixa etária", "Semana epidemiológica", "Positividade (%)", "Positivos", "Negativos", "Total de casos"]
WEEKS = "Semanas epidemiológicas"
MONTH_FLOOR = " AND month >= '2022-01'"
OTHERS = """FROM long WHERE test_kit IN ('arbo_pcr_3', 'igm_serum', 'orov_pcr', 'mayv_pcr', 'yfv_pcr', 'zikv_pcr')"""
OTHER_NAMES = {"orov": "Oropouche", "zikv": "Zika", "yfv": "Febre amarela", "mayv": "Mayaro", "wnv": "West Nile"}

# (query name, table name, statement)
PLAIN = [
    ("M01_week_by_year", "01_DENV_line_posrate_direct_week_country_years", by_year("denv")),
    ("M02h_week", "02_DENV_line_bar_posrate_posneg_direct_week_country_h", week_country("denv")),
    ("M02r_week_recent", "02_DENV_line_bar_posrate_posneg_direct_week_country_r", recent(week_country("denv"), WEEKS, 364)),
    ("M03mh_month_region", "03_DENV_bar_total_direct_months_regions_h", by_region("denv", "month", "Ano-Mês", MONTH_FLOOR)),
    (
        "M03mr_month_region_recent",
        "03_DENV_bar_total_direct_months_regions_r",
        latest(by_region("denv", "month", "Ano-Mês", MONTH_FLOOR), "Ano-Mês", 12),
    ),
    ("M03w_week_region", "03_DENV_bar_total_direct_weeks_regions", by_region("denv", "epiweek_enddate", WEEKS)),
    ("M06h_age_week", "06_DENV_heat_posrate_agegroups_week_country_h", by_age_week("denv", LOWER)),
    (
        "M06r_age_week_recent",
        "06_DENV_heat_posrate_agegroups_week_country_r",
        recent(by_age_week("denv", LOWER), "semana epidemiológica", 364),
    ),
    ("M07h_age_month", "07_DENV_barH_pos_agegroups_month_country_h", by_age_month()),
    ("M07r_age_month_recent", "07_DENV_barH_pos_agegroups_month_country_r", latest(by_age_month(), "month", 6)),
    ("M08h_six_pathogens", "08_Arbo_barH_pos_agegroups_month_country_h", six_pathogens()),
    ("M08r_six_pathogens_recent", "08_Arbo_barH_pos_agegroups_month_country_r", latest(six_pathogens(), "month", 6)),
    ("M14_week_by_year", "14_CHIKV_line_posrate_direct_indirect_week_country_years", by_year("chikv")),
    ("M15h_week", "15_CHIKV_line_bar_posrate_posneg_direct_indirect_week_country_h", week_country("chikv")),
    (
        "M15r_week_recent",
        "15_CHIKV_line_bar_posrate_posneg_direct_indirect_week_country_r",
        recent(week_country("chikv"), WEEKS, 364),
    ),
    ("M16mh_month_region", "16_CHIKV_bar_total_direct_indirect_months_regions_h", by_region("chikv", "month", "Ano-Mês", MONTH_FLOOR)),
    (
        "M16mr_month_region_recent",
        "16_CHIKV_bar_total_direct_indirect_months_regions_r",
        latest(by_region("chikv", "month", "Ano-Mês", MONTH_FLOOR), "Ano-Mês", 12),
    ),
    ("M16w_week_region", "16_CHIKV_bar_total_direct_indirect_weeks_regions", by_region("chikv", "epiweek_enddate", WEEKS)),
    ("M17_age_week", "17_CHIKV_heat_posrate_direct_indirect_agegroups_week_country", by_age_week("chikv", UPPER)),
    ("M18_quarter_age", "18_DENV_barH_pos_agegroups_quarter_country", quarter_grid(direct("denv"), {"denv": "Dengue"})),
    ("M19_quarter_age", "19_CHIKV_barH_pos_agegroups_quarter_country", quarter_grid(direct("chikv"), {"chikv": "Chikungunya"})),
    ("M20_quarter_age_others", "20_ARBO_barH_pos_agegroups_quarter_country", quarter_grid(OTHERS, OTHER_NAMES)),
    ("M24h_two_rates", "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_h", two_week()),
    ("M24r_two_rates_recent", "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_r", recent(two_week(), "Semana", 364)),
    ("M24c_two_rates_short", "24_DENV_CHIKV_line_posrate_direct_indirect_week_country_c", recent(two_week(), "Semana", 70)),
    ("M25_two_rates_aligned", "25_DENV_CHIKV_line_posrate_direct_indirect_week_country_years", two_aligned()),
    ("M26_two_rates_label", "26_DENV_CHIKV_line_posrate_direct_week_country_years", two_label(dated=True)),
    ("M26h_two_rates_label", "26_DENV_CHIKV_line_posrate_direct_week_country_years_h", two_label()),
    ("M26r_two_rates_label_recent", "26_DENV_CHIKV_line_posrate_direct_week_country_years_r", two_label(364)),
    ("M26c_two_rates_label_short", "26_DENV_CHIKV_line_posrate_direct_week_country_years_c", two_label(70)),
    ("MALL_counts_by_lab", "matrix_ALL_count_by_labid_testkit_pathogen_result", BY_LAB),
]
# Summary table -> the entry that builds it.
ENTRY_OF = {table: name for name, table, _ in PLAIN}
for _name, _table, _body in PLAIN:

    @query(_name, on_long(_body))
    def _(t: Tables, table=_table):
        return TABLES[table].build(summary(t))


for _id, _pathogen, _prefix in (("M11", "denv", "11_DENV"), ("M12", "chikv", "12_CHIKV")):
    for _kind, _letter, _body in (("cities", "c", city_map(_pathogen)), ("states", "s", state_map(_pathogen))):
        for _form, _statement in (("h", _body), ("r", last(_body))):
            ENTRY_OF[f"{_prefix}_map_pos_direct_{_kind}_{_form}"] = f"{_id}{_letter}{_form}_{_kind}_map"

            @query(f"{_id}{_letter}{_form}_{_kind}_map", on_long(_statement, "macros"))
            def _(t: Tables, table=f"{_prefix}_map_pos_direct_{_kind}_{_form}"):
                return TABLES[table].build(summary(t))


@query("M04_week_states", on_long(week_states(), cells=state_cells(), good=GOOD_STATES))
def _(t: Tables):
    s = summary(t, min_tests=STATE_MIN, state_fill=STATE_FILL)
    return melted(TABLES["04_DENV_line_posrate_direct_weeks_states"].build(s), [WEEKS], "double")


_quality = state_quality()
_SUBSETS = {
    "": _quality,
    "_h": f"""SELECT * FROM ({_quality}) WHERE "Completude final" IN ('Apenas histórico', 'Alta qualidade')""",
    "_r": f"""SELECT * FROM ({recent(_quality, "semanas_epidemiologicas", 364)})
        WHERE "Completude final" IN ('Apenas 12 meses', 'Alta qualidade')""",
}
for _form, _statement in _SUBSETS.items():
    ENTRY_OF[f"21_DENV_heat_posrate_direct_weeks_states{_form}"] = f"M21{_form.strip('_')}_state_quality"

    @query(f"M21{_form.strip('_')}_state_quality", on_long(_statement, cells=state_cells()))
    def _(t: Tables, table=f"21_DENV_heat_posrate_direct_weeks_states{_form}"):
        s = summary(t, min_tests=STATE_MIN, history_fill=YEAR_FILL, year_fill=YEAR_FILL)
        return TABLES[table].build(s)


def _with_estimates(t: Tables) -> Summary:
    return summary(t, estimates=estimates_by_week(cast_estimates(raw_estimates(t)), AS_OF))


@query("M22_against_estimates", on_long(against_estimates("denv", "dengue", ""), "estimates_weekly"))
def _(t: Tables):
    table = TABLES["22_DENV_line_posrate_bar_pos_direct_week_country_infodengue"]
    return melted(table.build(_with_estimates(t)), [WEEKS], "double")


@query("M23_against_estimates", on_long(against_estimates("chikv", "chikungunya", " (InfoDengue)"), "estimates_weekly"))
def _(t: Tables):
    table = TABLES["23_CHIKV_line_posrate_bar_pos_direct_week_country_infodengue"]
    return melted(table.build(_with_estimates(t)), [WEEKS], "double")


@query("MCUBE_week_from_cube", on_long(week_country("denv")))
def _(t: Tables):
    return TABLES["02_DENV_line_bar_posrate_posneg_direct_week_country_h"].build(summary_from_cube(summary(t)))


@query("MCUBE_quarter_from_cube", on_long(quarter_grid(OTHERS, OTHER_NAMES)))
def _(t: Tables):
    return TABLES["20_ARBO_barH_pos_agegroups_quarter_country"].build(summary_from_cube(summary(t)))


# Tables with a column per state or year come from their entries one row per cell.
MELTED = {
    "04_DENV_line_posrate_direct_weeks_states": "M04_week_states",
    "22_DENV_line_posrate_bar_pos_direct_week_country_infodengue": "M22_against_estimates",
    "23_CHIKV_line_posrate_bar_pos_direct_week_country_infodengue": "M23_against_estimates",
}


def whole_release(t: Tables) -> dict[str, Callable[[], DataFrame]]:
    """All exported tables in order, from one stored cube."""
    whole = _with_estimates(t)
    cube = stored(summary_cube(whole.rows), "cube")
    base = replace(whole, rows=cube, weight="n")
    states = replace(base, min_tests=STATE_MIN, state_fill=STATE_FILL)
    quality = replace(base, min_tests=STATE_MIN, history_fill=YEAR_FILL, year_fill=YEAR_FILL)
    of = {n: states for n in MELTED if n.startswith("04")} | {n: quality for n in TABLES if n.startswith("21_")}
    return {n: (lambda n=n: TABLES[n].ordered(of.get(n, base))) for n, table in TABLES.items() if table.exported}


def sizes_sql() -> str:
    """``name, rows`` of every exported table."""
    parts = []
    for name, table in TABLES.items():
        if not table.exported:
            continue
        count = "count(*)"
        if name in MELTED:
            count = f'count(DISTINCT "{WEEKS}")'
        parts.append(f"SELECT '{name}' AS name, {count} AS rows FROM ({ORACLES[MELTED.get(name) or ENTRY_OF[name]]})")
    return " UNION ALL ".join(parts)
