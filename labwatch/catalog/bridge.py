"""Surveillance-shaped views of the shared test tables.

Column expressions are written in the common dialect of Spark SQL and DuckDB, so both sides start
from the same rows; everything after that is stated independently on each side. Dates move 9497
days (26 years) so that they cover 2021 to 2027.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables
from labwatch.functions.dates import epi_number, epi_year, week_end, week_start
from labwatch.functions.text import sample_key
from labwatch.operators.shaping import one_hot
from labwatch.operators.windows import collapse_samples
from labwatch.plans.combine import Dimensions, enrich, summary_rows
from labwatch.plans.matrices import Summary
from labwatch.schema import CARRIED

AS_OF = "2026-12-31"
STAMP = "2026-12-31 10:00:00"
SHIFT = 9497
MIN_TESTS = 5

SEGMENT = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 "
    "WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END"
)

# --- laboratory lines ------------------------------------------------------------------------

LINES = {
    "lab_id": "concat('LAB', cast(o_custkey % 8 as string))",
    "test_id": "cast(l_orderkey as string)",
    "exame": "p_type",
    "analyte": """CASE p_type
        WHEN 'STANDARD' THEN CASE l_linenumber % 3 WHEN 0 THEN 'DENV' WHEN 1 THEN 'ZIKV' ELSE 'CHIKV' END
        WHEN 'ECONOMY' THEN 'DENV'
        WHEN 'PROMO' THEN 'DENV'
        WHEN 'MEDIUM' THEN CASE l_partkey % 7 WHEN 0 THEN 'DENV' WHEN 1 THEN 'ZIKV' WHEN 2 THEN 'CHIKV'
            WHEN 3 THEN 'YFV' WHEN 4 THEN 'MAYV' WHEN 5 THEN 'OROV' ELSE 'WNV' END
        WHEN 'SMALL' THEN 'CHIKV'
        ELSE CASE p_size % 5 WHEN 0 THEN 'OROV' WHEN 1 THEN 'MAYV' WHEN 2 THEN 'YFV' WHEN 3 THEN 'ZIKV'
            ELSE 'WNV' END
        END""",
    "test_kit": """CASE p_type WHEN 'STANDARD' THEN 'arbo_pcr_3' WHEN 'ECONOMY' THEN 'ns1_antigen'
        WHEN 'PROMO' THEN 'denv_pcr' WHEN 'MEDIUM' THEN 'igm_serum' WHEN 'SMALL' THEN 'chikv_pcr'
        ELSE CASE p_size % 5 WHEN 0 THEN 'orov_pcr' WHEN 1 THEN 'mayv_pcr' WHEN 2 THEN 'yfv_pcr'
            WHEN 3 THEN 'zikv_pcr' ELSE 'UNKNOWN' END
        END""",
    "result": """CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0
        ELSE CASE WHEN l_linestatus = 'O' THEN -3
            ELSE CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN -2 ELSE 0 END END
        END""",
    "sex": "CASE o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE NULL END",
    "age": "CASE WHEN l_tax = 0 THEN NULL ELSE cast(l_quantity * 2 as int) - 1 END",
    "location": """CASE WHEN o_custkey % 10 = 0 OR o_custkey % 20 = 12 THEN concat('city ', lower(c_mktsegment))
        WHEN o_custkey % 10 = 1 THEN NULL
        WHEN o_custkey % 10 = 4 THEN 'Vila Nova'
        ELSE concat('  ', replace(lower(c_mktsegment), 'i', 'í'), ' nation', cast(c_nationkey as string), ' ') END""",
    "date_testing": f"cast(l_shipdate as date) + {SHIFT}",
    "state": """CASE o_custkey % 10 WHEN 2 THEN concat('Ex Nation', cast(c_nationkey as string))
        WHEN 3 THEN 'value'
        ELSE concat('nation', cast(c_nationkey as string)) END""",
    "patient_id": "concat('P', cast(o_custkey as string))",
    "file_name": "concat('batch_', cast(l_suppkey % 5 as string), '.csv')",
}


def wide_lines(t: Tables) -> DataFrame:
    """Order lines with their order, customer and part: each side gets its own lookup first, so the wide rows move once."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    columns = [*t.lineitem.columns, *t.orders.columns, *t.customer.columns, *t.part.columns]
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*columns)


WIDE_SQL = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey"""


def columns_sql(columns: dict[str, str]) -> str:
    return ",\n".join(f'{expr} AS "{name}"' for name, expr in columns.items())


# Columns that an order's customer alone decides, and those that a line alone decides and that are smaller than their parts.
OF_CUSTOMER = ["lab_id", "sex", "location", "state", "patient_id"]
OF_LINE = ["result", "age", "date_testing"]


def lab_lines(t: Tables) -> DataFrame:
    """The laboratories' lines. Customers' columns are made once per customer, before they meet orders and lines.

    The lines' own codes, ages and dates are made before the lines move, in place of what they are made of.
    """
    made = [F.expr(LINES[name]).alias(name) for name in OF_CUSTOMER]
    customers = t.customer.withColumn("o_custkey", F.col("c_custkey")).select("c_custkey", *made)
    orders = t.orders.select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    own = t.lineitem.select("*", *[F.expr(LINES[name]).alias(name) for name in OF_LINE])
    lines = own.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    made = {*OF_CUSTOMER, *OF_LINE}
    return rows.select(*[F.col(n) if n in made else F.expr(e).alias(n) for n, e in LINES.items()])


def coded_lines(t: Tables) -> DataFrame:
    """Usable lines with their sample id and one column per pathogen."""
    usable = lab_lines(t).filter(F.coalesce(F.col("result"), F.lit(0)) != vocab.INDETERMINATE)
    sample = sample_key("lab_id", "test_id", "exame")
    codes = {p: [p] for p in vocab.PATHOGENS}
    return usable.select(sample.alias("sample_id"), "*", *one_hot("analyte", "result", codes))


SAMPLE_COLUMNS = ["lab_id", *CARRIED]


def samples(t: Tables) -> DataFrame:
    return collapse_samples(coded_lines(t), "sample_id", SAMPLE_COLUMNS)


def dimensions(t: Tables) -> Dimensions:
    return _dimensions(t).verified()


def _dimensions(t: Tables) -> Dimensions:
    def view(of: DataFrame, columns: dict[str, str]) -> DataFrame:
        return of.selectExpr(*[f"{e} as {n}" for n, e in columns.items()])

    customers = t.customer.withColumnRenamed("c_nationkey", "n_nationkey")
    pairs = customers.select("n_nationkey", "c_mktsegment").distinct()
    places = pairs.join(t.nation, "n_nationkey").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    people = customers.filter("NOT (n_nationkey = 3 AND c_mktsegment = 'FURNITURE')")
    macro = people.groupBy("n_nationkey", "c_mktsegment").agg(F.expr(POPULATION).alias("Populacao"))
    return Dimensions(
        municipalities=view(places, MUNICIPALITIES),
        macroregions=macro.selectExpr(*[f"{e} as {n}" for n, e in MACRO.items()], "Populacao"),
        fix_state=view(t.nation, FIX_STATE).unionByName(view(t.spark.range(1), FIX_STATE_VOID)),
        fix_location=view(pairs, FIX_LOCATION),
    )


MUNICIPALITIES = {
    "CD_MUN": f"3300000 + n_nationkey * 10 + {SEGMENT}",
    "CD_UF": "11 + n_nationkey",
    "SIGLA_UF": "concat('N', cast(n_nationkey as string))",
    "NM_UF": "n_name",
    "NM_UF_NORM": "replace(upper(n_name), '_', '')",
    "NM_MUN": "concat(c_mktsegment, '-', n_name)",
    "NM_MUN_NORM": "concat(c_mktsegment, ' ', replace(upper(n_name), '_', ''))",
    "REGIAO": """CASE r_name WHEN 'AFRICA' THEN 'NORTE' WHEN 'AMERICA' THEN 'NORDESTE'
        WHEN 'ASIA' THEN 'CENTRO-OESTE' WHEN 'EUROPE' THEN 'SUDESTE' ELSE 'SUL' END""",
    "lat": "cast(n_nationkey as double) - 30.5",
    "long": f"cast({SEGMENT} as double) - 50.25",
}
POPULATION = "cast(CASE WHEN n_nationkey = 0 AND c_mktsegment = 'MACHINERY' THEN 0 ELSE sum(floor(abs(c_acctbal))) END as int)"
MACRO = {
    "CO_UF": "11 + n_nationkey",
    "CO_MACSAUD": f"cast((11 + n_nationkey) * 100 + {SEGMENT} % 2 as string)",
    "DS_NOMEPAD_macsaud": f"concat('MACRO ', cast({SEGMENT} % 2 as string))",
    "ADM2_PCODE": f"concat('BR', cast(3300000 + n_nationkey * 10 + {SEGMENT} as string))",
    "DS_UF_SIGLA": "concat('N', cast(n_nationkey as string))",
}
FIX_STATE = {
    "source_state": "concat('EX NATION', cast(n_nationkey as string))",
    "target_state": "concat('NATION', cast(n_nationkey as string))",
    "description": "'old name'",
}
FIX_STATE_VOID = {"source_state": "'VALUE'", "target_state": "'NOT REPORTED'", "description": "'entry error'"}
FIX_LOCATION = {
    "source_location": "concat('CITY ', c_mktsegment)",
    "source_state": "concat('NATION', cast(n_nationkey as string))",
    "target_location": "concat(c_mktsegment, ' NATION', cast(n_nationkey as string))",
    "description": "'short name'",
}


def combined(t: Tables) -> DataFrame:
    return enrich(samples(t), dimensions(t))


def summary(t: Tables, **params) -> Summary:
    dims = dimensions(t)
    rows = summary_rows(enrich(samples(t), dims), AS_OF)
    return Summary(rows, min_tests=params.pop("min_tests", MIN_TESTS), macroregions=dims.macroregions, **params)


# --- case estimates --------------------------------------------------------------------------

# One reported week per customer place and disease, from the orders of that week.
ESTIMATE_KEYS = {
    "week_day": f"cast(o_orderdate as date) + {SHIFT}",
    "disease": "CASE WHEN o_orderpriority < '3' THEN 'dengue' ELSE 'chikungunya' END",
    "city": "concat(c_mktsegment, '-', n_name)",
    "city_ibge_code": f"cast(3300000 + n_nationkey * 10 + {SEGMENT} as string)",
    "state_code": "concat('N', cast(n_nationkey as string))",
    "state": "n_name",
    "region": """CASE r_name WHEN 'AFRICA' THEN 'Norte' WHEN 'AMERICA' THEN 'Nordeste'
        WHEN 'ASIA' THEN 'Centro-Oeste' WHEN 'EUROPE' THEN 'Sudeste' ELSE NULL END""",
    "cases": "cast(floor(o_totalprice / 10000) as int)",
}
ESTIMATE_GROUP = ["disease", "city", "city_ibge_code", "state_code", "state", "region"]


def raw_estimates(t: Tables) -> DataFrame:
    """The feed as delivered: text columns, one row per key."""
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(*[F.expr(e).alias(n) for n, e in ESTIMATE_KEYS.items()])
    )
    weekly = rows.groupBy(week_start("week_day").alias("first"), *ESTIMATE_GROUP).agg(F.sum("cases").alias("cases"))
    first, cases = F.col("first"), F.col("cases")
    return weekly.select(
        F.concat(epi_year(first).cast("string"), F.lpad(epi_number(first).cast("string"), 2, "0")).alias("SE"),
        (cases * 2).cast("string").alias("casos_est"),
        cases.cast("string").alias("casos_est_min"),
        (cases * 3).cast("string").alias("casos_est_max"),
        cases.cast("string").alias("casos"),
        *ESTIMATE_GROUP,
        first.cast("string").alias("data_iniSE"),
        week_end("first").cast("string").alias("data_fimSE"),
        F.concat(F.lit("estimates_"), "disease", F.lit(".csv")).alias("file_name"),
    )


# --- the same views in SQL -------------------------------------------------------------------

RESULT_CASE = " ".join(f"WHEN {code} THEN '{text}'" for code, text in vocab.RESULT_TEXT.items())


def one_hot_sql(code: str, codes: dict[str, list[str]], result: str = "result") -> str:
    out = []
    for pathogen, column in vocab.RESULT_OF.items():
        own = codes.get(pathogen, [])
        if own:
            listed = ", ".join("'" + c.replace("'", "''") + "'" for c in own)
            out.append(f"CASE WHEN {code} IN ({listed}) THEN {result} ELSE -1 END AS {column}")
        else:
            out.append(f"-1 AS {column}")
    return ",\n".join(out)


def order_sql(columns: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def collapse_sql(source: str, carried: list[str], count: str = "CAST(line_count AS BIGINT)") -> str:
    """One row per sample_id of ``source``, in window form."""
    best = ", ".join(f"max({c}) OVER s AS best_{c}" for c in vocab.RESULT_COLUMNS)
    texts = ", ".join(f"CASE best_{c} {RESULT_CASE} END AS {c}" for c in vocab.RESULT_COLUMNS)
    return f"""SELECT sample_id, {", ".join(carried)}, {texts}, {count} AS qty_original_lines
    FROM (SELECT sample_id, {", ".join(carried)}, {best}, count(*) OVER s AS line_count,
            row_number() OVER (PARTITION BY sample_id ORDER BY {order_sql(carried)}) AS line_rank
        FROM {source} WINDOW s AS (PARTITION BY sample_id)) AS ranked
    WHERE line_rank = 1"""


_BANDS = ", ".join(f"('{name}', {low}, {high})" for name, low, high in vocab.AGE_BANDS)
_PLACES = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_REGION_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.REGIONS.items())

# Sundays are found by stepping from a known one; a week belongs to the year of its Wednesday.
CALENDAR_SQL = """SELECT wed_year AS year,
        CAST(row_number() OVER (PARTITION BY wed_year ORDER BY start_date) AS INTEGER) AS week_num,
        start_date + 6 AS end_date, start_date
    FROM (SELECT *, CAST(year(start_date + 3) AS INTEGER) AS wed_year
        FROM (SELECT DATE '2017-12-31' + CAST(7 * i AS INTEGER) AS start_date FROM range(0, 522) AS r(i)) AS s) AS w"""

CTES = {
    "lines": f"SELECT {columns_sql(LINES)} FROM {WIDE_SQL}",
    "coded": f"""SELECT md5(concat(lab_id, test_id, exame)) AS sample_id, *,
        {one_hot_sql("analyte", {p: [p] for p in vocab.PATHOGENS})}
        FROM lines WHERE result IS DISTINCT FROM -3""",
    "samples": collapse_sql("coded", SAMPLE_COLUMNS),
    "bands": f"SELECT * FROM (VALUES {_BANDS}) AS b(age_group, min_age, max_age)",
    "calendar": CALENDAR_SQL,
    "municipalities": f"SELECT DISTINCT {columns_sql(MUNICIPALITIES)} FROM {_PLACES}",
    "macros": f"""SELECT {columns_sql(MACRO)}, {POPULATION} AS "Populacao"
        FROM {_PLACES} WHERE NOT (n_nationkey = 3 AND c_mktsegment = 'FURNITURE')
        GROUP BY n_nationkey, c_mktsegment""",
    "fix_state": f"""SELECT DISTINCT {columns_sql(FIX_STATE)} FROM nation
        UNION SELECT {columns_sql(FIX_STATE_VOID)}""",
    "fix_location": f"SELECT DISTINCT {columns_sql(FIX_LOCATION)} FROM {_PLACES}",
    "dated": """SELECT s.*, b.age_group, k.end_date AS epiweek_enddate, k.week_num AS epiweek_number,
        strftime(date_testing, '%Y-%m') AS month
        FROM samples s LEFT JOIN bands b ON s.age BETWEEN b.min_age AND b.max_age
        LEFT JOIN calendar k ON s.date_testing BETWEEN k.start_date AND k.end_date""",
    "cleaned": """SELECT * REPLACE (upper(strip_accents(trim(location))) AS location,
        upper(strip_accents(trim(state))) AS state) FROM dated""",
    "placed": """SELECT c.* REPLACE (
        CASE WHEN l.source_location IS NULL THEN c.location ELSE l.target_location END AS location,
        CASE WHEN f.source_state IS NULL THEN c.state ELSE f.target_state END AS state)
        FROM cleaned c LEFT JOIN fix_state f ON c.state = f.source_state
        LEFT JOIN fix_location l ON c.location = l.source_location
            AND (c.state = l.source_state OR f.target_state = l.source_state)""",
    "combined": f"""SELECT p.* EXCLUDE (location, state), 'Brasil' AS country, m."NM_MUN" AS location,
        m."NM_UF" AS state, CASE m."REGIAO" {_REGION_CASE} END AS region,
        a."DS_NOMEPAD_macsaud" AS macroregion, a."CO_MACSAUD" AS macroregion_code,
        m."SIGLA_UF" AS state_code, m."CD_UF" AS state_ibge_code, m."CD_MUN" AS location_ibge_code,
        m.lat, m.long
        FROM placed p LEFT JOIN municipalities m ON p.location = m."NM_MUN_NORM" AND p.state = m."NM_UF_NORM"
        LEFT JOIN macros a ON a."CO_UF" = m."CD_UF" AND a."ADM2_PCODE" = 'BR' || CAST(m."CD_MUN" AS VARCHAR)""",
    "weekly": f"""SELECT sample_id, test_kit, epiweek_enddate, epiweek_number, lab_id, month, date_testing,
        location_ibge_code, lat, long, {", ".join(vocab.RESULT_COLUMNS)},
        {", ".join(f"coalesce({c}, 'NOT REPORTED') AS {c}"
                   for c in ["location", "region", "state", "state_code", "country", "age_group"])}
        FROM combined WHERE epiweek_enddate >= DATE '2022-01-01' AND epiweek_enddate < DATE '{AS_OF}'""",
    "long": f"""SELECT w.*, u.pathogen, u.result FROM weekly w, LATERAL (
        {" UNION ALL ".join(f"SELECT '{p}' AS pathogen, w.{c} AS result" for p, c in vocab.RESULT_OF.items())}) u""",
    "estimate_lines": f"""SELECT {columns_sql(ESTIMATE_KEYS)} FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "estimates": f"""SELECT concat(k.year, lpad(CAST(k.week_num AS VARCHAR), 2, '0')) AS "SE",
        CAST(sum(cases) * 2 AS INTEGER) AS casos_estimados, CAST(sum(cases) AS INTEGER) AS casos_est_min,
        CAST(sum(cases) * 3 AS INTEGER) AS casos_est_max, CAST(sum(cases) AS INTEGER) AS casos_confirmados,
        disease, city, city_ibge_code, state_code, state, region, k.start_date AS "data_iniSE",
        k.end_date AS "data_fimSE", concat('estimates_', disease, '.csv') AS file_name,
        k.end_date AS epiweek_enddate, k.week_num AS epiweek_number, strftime(k.end_date, '%Y-%m') AS month
        FROM estimate_lines JOIN calendar k ON week_day BETWEEN k.start_date AND k.end_date
        GROUP BY ALL""",
    "estimates_weekly": f"""SELECT disease, epiweek_enddate, epiweek_number, month, "data_fimSE", casos_estimados,
        city_ibge_code, city, state_code, state, region FROM estimates
        WHERE epiweek_enddate >= DATE '2022-01-01' AND epiweek_enddate < DATE '{AS_OF}'""",
}

NEEDS = {
    "lines": [],
    "coded": ["lines"],
    "samples": ["coded"],
    "bands": [],
    "calendar": [],
    "municipalities": [],
    "macros": [],
    "fix_state": [],
    "fix_location": [],
    "dated": ["samples", "bands", "calendar"],
    "cleaned": ["dated"],
    "placed": ["cleaned", "fix_state", "fix_location"],
    "combined": ["placed", "municipalities", "macros"],
    "weekly": ["combined"],
    "long": ["weekly"],
    "estimate_lines": [],
    "estimates": ["estimate_lines", "calendar"],
    "estimates_weekly": ["estimates"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for item in [*_closure(NEEDS[name]), name]:
            if item not in out:
                out.append(item)
    return out


def sql(body: str, *views: str, **extra: str) -> str:
    """``body`` behind the bridge views it names; ``extra`` adds views of its own."""
    parts = [f"{v} AS MATERIALIZED ({CTES[v]})" for v in _closure(list(views))]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def case_sql(column: str, table: dict, default: str = "NULL") -> str:
    """CASE over a literal dictionary."""
    def quoted(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {default} END"


def list_sql(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def any_of(conditions: list[str]) -> str:
    return reduce(lambda a, b: f"{a} OR {b}", conditions)
