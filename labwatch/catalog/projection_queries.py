"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import AS_OF, WIDE_SQL, combined, lab_lines, samples, sql, wide_lines
from labwatch.functions.results import classify, lookup, plausible_age
from labwatch.functions.text import region_name
from labwatch.operators import shaping as S
from labwatch.operators.windows import last_period, recent_days
from labwatch.plans.combine import PRIVATE, ReportCity, city_report, for_sharing
from labwatch.plans.matrices import SIX_PATHOGEN_RULE, TWO_PATHOGEN_RULE, kit_rule

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEYS_SQL = ", ".join(LINE_KEYS)
# Numbers as text, some of them broken.
DIRTY = "CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE cast(l_suppkey as string) END"


@query(
    "P01_rename_cast",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS test_id, try_cast({DIRTY} AS INTEGER) AS age,
        CAST(l_shipdate AS DATE) AS date_testing FROM lineitem""",
)
def _(t: Tables):
    return S.cast_columns(
        t.lineitem,
        {
            "test_id": ("l_orderkey", "string"),
            "age": (F.expr(DIRTY), "int"),
            "date_testing": ("l_shipdate", "date"),
        },
    )


@query(
    "P01_rejected_rows",
    f"SELECT {KEYS_SQL}, 'age' AS rejected_columns FROM lineitem WHERE l_linenumber = 3",
)
def _(t: Tables):
    rows = t.lineitem.selectExpr(*LINE_KEYS, f"{DIRTY} as age_text", "cast(l_orderkey as string) as id_text")
    bad = S.rejected_rows(rows, {"test_id": ("id_text", "bigint"), "age": ("age_text", "int")})
    return bad.select(*LINE_KEYS, F.concat_ws(",", "rejected_columns").alias("rejected_columns"))


@query("P02_normalise_id", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def _(t: Tables):
    padded = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    return t.customer.select("c_custkey", S.normalise_id(padded).alias("id"))


@query(
    "P03_constant_columns",
    "SELECT n_nationkey, 'EINSTEIN' AS lab_id, 'Brasil' AS country, 'NT' AS wnv_test_result, CAST(1 AS BIGINT) AS qty FROM nation",
)
def _(t: Tables):
    return t.nation.select(
        "n_nationkey",
        F.lit("EINSTEIN").alias("lab_id"),
        F.lit(vocab.COUNTRY).alias("country"),
        F.lit("NT").alias("wnv_test_result"),
        F.lit(1).cast("long").alias("qty"),
    )


@query("P04_all_but", "SELECT * EXCLUDE (o_totalprice, o_orderpriority) FROM orders")
def _(t: Tables):
    return S.without(t.orders, "o_totalprice", "o_orderpriority")


@query("P05_for_sharing", sql(f"SELECT * EXCLUDE ({', '.join(PRIVATE)}) FROM combined", "combined"))
def _(t: Tables):
    return for_sharing(combined(t))


@query(
    "P06_ordered_rules",
    f"""SELECT {KEYS_SQL}, CASE WHEN p_type IN ('STANDARD', 'PROMO') AND lower(p_name) LIKE '%ring' THEN 'arbo_pcr_3'
        WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'igg_serum' WHEN p_type = 'PROMO' THEN 'igm_serum'
        ELSE 'UNKNOWN' END AS test_kit FROM {WIDE_SQL}""",
)
def _(t: Tables):
    rules = [
        (F.col("p_type").isin("STANDARD", "PROMO") & F.col("p_name").ilike("%RING"), "arbo_pcr_3"),
        (F.col("p_type").isin("STANDARD", "ECONOMY"), "igg_serum"),
        (F.col("p_type") == "PROMO", "igm_serum"),
    ]
    return wide_lines(t).select(*LINE_KEYS, classify(rules, "UNKNOWN").alias("test_kit"))


@query(
    "P07_nested_rules",
    """SELECT p_partkey, CASE p_type WHEN 'MEDIUM' THEN CASE WHEN p_size % 3 = 0 THEN 'igg_serum'
        WHEN p_size % 3 = 1 THEN 'igm_serum' ELSE 'UNKNOWN' END WHEN 'SMALL' THEN 'chikv_pcr' ELSE 'UNKNOWN' END AS test_kit
        FROM part""",
)
def _(t: Tables):
    third = (F.col("p_size") % 3).cast("string")
    nested = lookup(third, {"0": "igg_serum", "1": "igm_serum"}, "UNKNOWN")
    plain = lookup("p_type", {"SMALL": "chikv_pcr"}, "UNKNOWN")
    return t.part.select("p_partkey", classify([(F.col("p_type") == "MEDIUM", nested)], plain).alias("test_kit"))


@query(
    "P08_none_of",
    sql("SELECT lab_id, sex, analyte, count(*) AS n FROM lines WHERE sex NOT IN ('M', 'X') GROUP BY ALL", "lines"),
)
def _(t: Tables):
    rows = lab_lines(t).filter(S.none_of("sex", ["M", "X"]))
    return rows.groupBy("lab_id", "sex", "analyte").agg(F.count(F.lit(1)).alias("n"))


@query("P09_allow_list", "SELECT * FROM part WHERE p_type IN ('STANDARD', 'PROMO') AND p_brand IN ('Brand#2', 'Brand#17', 'Brand#9')")
def _(t: Tables):
    return t.part.filter(
        F.col("p_type").isin("STANDARD", "PROMO") & F.col("p_brand").isin("Brand#2", "Brand#17", "Brand#9")
    )


@query(
    "P10_like",
    "SELECT doc_id, text ILIKE '%den%' AS has_den, text LIKE '_e%' AS second_e FROM documents",
)
def _(t: Tables):
    return t.documents.select(
        "doc_id", F.col("text").ilike("%den%").alias("has_den"), F.col("text").like("_e%").alias("second_e")
    )


@query(
    "P11_regex",
    "SELECT doc_id, regexp_matches(text, '[0-9]+[,.]*[0-9]*') AS number, regexp_matches(text, '^[A-D]') AS head FROM documents",
)
def _(t: Tables):
    return t.documents.select(
        "doc_id", F.col("text").rlike("[0-9]+[,.]*[0-9]*").alias("number"), F.col("text").rlike("^[A-D]").alias("head")
    )


@query(
    "P12_any_present",
    sql("SELECT lab_id, count(*) AS n FROM lines WHERE location IS NOT NULL OR sex IS NOT NULL OR result IS NOT NULL GROUP BY 1", "lines"),
)
def _(t: Tables):
    rows = lab_lines(t).filter(S.any_present("location", "sex", F.col("result").cast("string")))
    return rows.groupBy("lab_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P13_negated_any",
    sql("SELECT exame, count(*) AS n FROM lines WHERE NOT (sex = 'M' OR location = 'Vila Nova' OR result = -2) GROUP BY 1", "lines"),
)
def _(t: Tables):
    bad = (F.col("sex") == "M") | (F.col("location") == "Vila Nova") | (F.col("result") == -2)
    return lab_lines(t).filter(~bad).groupBy("exame").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P14_date_floor",
    sql("SELECT lab_id, date_testing, count(*) AS n FROM lines WHERE date_testing >= DATE '2025-08-01' GROUP BY ALL", "lines"),
)
def _(t: Tables):
    rows = lab_lines(t).filter(F.col("date_testing") >= F.lit("2025-08-01").cast("date"))
    return rows.groupBy("lab_id", "date_testing").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P15_completed_weeks",
    sql("SELECT epiweek_enddate, count(*) AS n FROM dated WHERE epiweek_enddate >= DATE '2022-01-01' "
        f"AND epiweek_enddate < DATE '{AS_OF}' GROUP BY 1", "dated"),
)
def _(t: Tables):
    rows = combined(t).filter(S.completed_weeks("epiweek_enddate", AS_OF))
    return rows.groupBy("epiweek_enddate").agg(F.count(F.lit(1)).alias("n"))


def _rule_sql(rule, otherwise: str) -> str:
    out = " ".join(
        f"WHEN {vocab.RESULT_OF[p]} IN ('Pos', 'Neg') THEN test_kit IN ({', '.join(repr(k) for k in kits)})" for p, kits in rule
    )
    return f"CASE {out} ELSE {otherwise} END"


@query(
    "P16_kit_rule",
    sql(
        f"""SELECT test_kit, count(*) FILTER ({_rule_sql(SIX_PATHOGEN_RULE, 'TRUE')}) AS six,
        count(*) FILTER ({_rule_sql(TWO_PATHOGEN_RULE, 'FALSE')}) AS two FROM samples GROUP BY 1""",
        "samples",
    ),
)
def _(t: Tables):
    return samples(t).groupBy("test_kit").agg(
        F.count_if(kit_rule(SIX_PATHOGEN_RULE, True)).alias("six"),
        F.count_if(kit_rule(TWO_PATHOGEN_RULE, False)).alias("two"),
    )


@query("P17_between", "SELECT * FROM part WHERE p_size BETWEEN 9 AND 11")
def _(t: Tables):
    return t.part.filter(F.col("p_size").between(9, 11))


@query(
    "P18_or_missing",
    sql("SELECT CASE WHEN state IS NULL THEN 'NOT REPORTED' ELSE state END AS state, count(*) AS n FROM combined GROUP BY 1", "combined"),
)
def _(t: Tables):
    return combined(t).groupBy(S.or_missing("state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "P19_bad_ids",
    "SELECT * FROM customer WHERE c_name <> 'Customer#000000007' AND c_name <> 'Customer#000000011'",
)
def _(t: Tables):
    return t.customer.filter(S.none_of("c_name", ["Customer#000000007", "Customer#000000011"]))


CITY = ReportCity(code=3300071, name="BUILDING-NATION_7", state_code="N7")


@query("P20_single_place", sql(f"SELECT sample_id, date_testing, test_kit FROM combined WHERE location_ibge_code = {CITY.code}", "combined"))
def _(t: Tables):
    return combined(t).filter(F.col("location_ibge_code") == CITY.code).select("sample_id", "date_testing", "test_kit")


@query(
    "P21_recent_days",
    "SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 364 DAY",
)
def _(t: Tables):
    return recent_days(t.orders, "o_orderdate", 364)


@query("P22_last_period", "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _(t: Tables):
    return last_period(t.orders, "o_orderdate")


@query(
    "P23_plausible_age",
    "SELECT p_partkey, CASE WHEN a BETWEEN 0 AND 120 THEN a END AS age, CASE WHEN a <= 120 THEN a END AS age_upper "
    "FROM (SELECT p_partkey, p_size * 5 - 20 AS a FROM part)",
)
def _(t: Tables):
    age = F.col("p_size") * 5 - 20
    return t.part.select("p_partkey", plausible_age(age).alias("age"), plausible_age(age, low=None).alias("age_upper"))


@query("P24_drop_sentinel", sql("SELECT result, count(*) AS n FROM lines WHERE result <> -3 GROUP BY 1", "lines"))
def _(t: Tables):
    rows = lab_lines(t).filter(F.col("result") != vocab.INDETERMINATE)
    return rows.groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query(
    "P25_display_literals",
    sql(
        f"""SELECT date_testing, test_kit, age_group, '{CITY.name}' AS location, '{CITY.state_code}' AS state_code,
        count(*) AS n FROM combined WHERE location_ibge_code = {CITY.code} AND denv_test_result IN ('Pos', 'Neg') GROUP BY ALL""",
        "combined",
    ),
)
def _(t: Tables):
    report = city_report(combined(t), CITY).filter((F.col("pathogen") == "DENV"))
    keys = ["date_testing", "test_kit", "age_group", "location", "state_code"]
    return report.groupBy(*keys).agg(F.sum("count").alias("n"))


@query(
    "P26_region_names",
    """SELECT n_nationkey, CASE r_name WHEN 'AFRICA' THEN 'Norte' WHEN 'AMERICA' THEN 'Nordeste'
        WHEN 'ASIA' THEN 'Centro-Oeste' WHEN 'EUROPE' THEN 'Sudeste' END AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    code = F.expr(
        "CASE r_name WHEN 'AFRICA' THEN 'NORTE' WHEN 'AMERICA' THEN 'NORDESTE' WHEN 'ASIA' THEN 'CENTRO-OESTE' "
        "WHEN 'EUROPE' THEN 'SUDESTE' ELSE 'LESTE' END"
    )
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", region_name(code).alias("region"))
