"""Scalar functions over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import SHIFT, case_sql, lab_lines, list_sql, sql
from labwatch.feeds.labs import SABIN_LEGACY, SABIN_NEGATIVE, SABIN_POSITIVE
from labwatch.functions import dates as D
from labwatch.functions import results as R
from labwatch.functions import text as X

PLAIN = "replace(strip_accents(text), 'ß', 'ss')"
DAY = f"cast(o_orderdate as date) + {SHIFT}"

# A state abbreviation per customer: known, unknown and missing ones.
STATE_CODE = "CASE c_nationkey % 6 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'XX' WHEN 3 THEN 'AM' WHEN 4 THEN 'GO' ELSE NULL END"
STATE_TEXT = "CASE c_nationkey % 4 WHEN 0 THEN 'SAO PAULO' WHEN 1 THEN 'PARA' WHEN 2 THEN 'Atlantis' ELSE NULL END"
SEX_TEXT = "CASE c_custkey % 5 WHEN 0 THEN 'feminino' WHEN 1 THEN 'F' WHEN 2 THEN 'Masc' WHEN 3 THEN 'x' ELSE NULL END"
AGE_TEXT = """CASE l_linenumber % 8 WHEN 0 THEN cast(cast(l_quantity as int) as string)
    WHEN 1 THEN concat(cast(cast(l_quantity as int) as string), 'A')
    WHEN 2 THEN concat(cast(cast(l_quantity as int) as string), 'A10M')
    WHEN 3 THEN concat(cast(cast(l_quantity as int) as string), 'A5D')
    WHEN 4 THEN concat(cast(cast(l_quantity as int) as string), 'M')
    WHEN 5 THEN concat(cast(cast(l_quantity as int) as string), 'D')
    WHEN 6 THEN '' ELSE NULL END"""
# Index text: 0,NN / NN / ,NN / N:NNN / N,N,N / words.
INDEX_TEXT = """CASE l_linenumber % 7 WHEN 0 THEN concat('0,', cast(l_suppkey % 90 + 10 as string))
    WHEN 1 THEN cast(l_partkey % 3 as string)
    WHEN 2 THEN concat(',', cast(l_partkey % 100 as string))
    WHEN 3 THEN concat('1:', cast(l_suppkey as string))
    WHEN 4 THEN concat('1,', cast(l_suppkey % 10 as string), ',3')
    WHEN 5 THEN concat('1,', cast(l_suppkey % 20 as string))
    ELSE 'REAGENTE' END"""
LINE_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def lines(t: Tables, **exprs: str):
    return t.lineitem.selectExpr(*LINE_KEYS.split(", "), *[f"{e} as {n}" for n, e in exprs.items()])


@query("F01_normalize_text", rf"SELECT doc_id, md5(trim(trim(upper({PLAIN}), ' '), '\t')) AS key FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(X.normalize_text("text").cast("binary")).alias("key"))


@query("F02_unaccent", f"SELECT doc_id, md5({PLAIN}) AS key, length({PLAIN}) AS n FROM documents")
def _(t: Tables):
    plain = X.strip_accents("text")
    return t.documents.select("doc_id", F.md5(plain.cast("binary")).alias("key"), F.length(plain).cast("long").alias("n"))


@query(
    "F03_drop_punctuation",
    rf"SELECT doc_id, md5(regexp_replace(upper({PLAIN}), '[^\w\s]', '', 'g')) AS key FROM documents",
)
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(X.drop_punctuation("text").cast("binary")).alias("key"))


@query(
    "F04_replace_first",
    "SELECT doc_id, md5(regexp_replace(text, ',', '.')) AS key FROM documents",
)
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(X.replace_first("text", ",", ".").cast("binary")).alias("key"))


@query(
    "F05_first_group",
    r"SELECT doc_id, nullif(regexp_extract(text, '(\d+)', 1), '') AS digits FROM documents",
)
def _(t: Tables):
    return t.documents.select("doc_id", X.first_group("text", r"(\d+)").alias("digits"))


@query("F06_split_part", "SELECT p_partkey, split_part(p_name, ' ', 1) AS head, split_part(p_brand, '#', 2) AS tail FROM part")
def _(t: Tables):
    return t.part.select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("head"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("tail"),
    )


@query(
    "F07_replace_upper_trim",
    "SELECT doc_id, md5(upper(trim(replace(text, ',', ' ; '), ' '))) AS key FROM documents WHERE strpos(text, 'ß') = 0 "
    "UNION ALL SELECT doc_id, md5(replace(upper(trim(replace(text, ',', ' ; '), ' ')), 'ẞ', 'SS')) FROM documents "
    "WHERE strpos(text, 'ß') > 0",
)
def _(t: Tables):
    out = F.upper(F.btrim(F.replace("text", F.lit(","), F.lit(" ; ")), F.lit(" ")))
    return t.documents.select("doc_id", F.md5(out.cast("binary")).alias("key"))


@query(
    "F08_sample_key",
    sql(
        "SELECT md5(concat(test_id, location, analyte)) AS sample_key, count(*) AS n FROM lines GROUP BY 1",
        "lines",
    ),
)
def _(t: Tables):
    key = X.sample_key("test_id", "location", "analyte").alias("sample_key")
    return lab_lines(t).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


@query(
    "F09_concat_label",
    "SELECT o_orderkey, concat('SE', o_orderpriority, ' - ', o_orderstatus) AS label FROM orders",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", X.label("SE", F.col("o_orderpriority"), " - ", F.col("o_orderstatus")).alias("label"))


@query("F10_two_digits", "SELECT p_partkey, format('{:02d}', p_size) AS padded FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", X.two_digits("p_size").alias("padded"))


@query(
    "F11_date_parts",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%y') AS yy, "
    "strftime(o_orderdate, '%d') AS dd, strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%Y') AS yyyy FROM orders",
)
def _(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        D.year_month(day).alias("ym"),
        F.date_format(day, "yy").alias("yy"),
        F.date_format(day, "dd").alias("dd"),
        F.date_format(day, "MM").alias("mm"),
        F.date_format(day, "yyyy").alias("yyyy"),
    )


@query(
    "F12_quarter_label",
    "SELECT o_orderkey, year(o_orderdate) || ' - ' || quarter(o_orderdate) || 'º Trimestre' AS trimestre FROM orders",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", D.quarter_label(F.col("o_orderdate")).alias("trimestre"))


@query(
    "F13_align_year",
    f"""SELECT o_orderkey, CASE WHEN strftime(d, '%m-%d') = '02-29' THEN DATE '2022-02-28'
        ELSE make_date(2022, month(d), day(d)) END AS aligned
        FROM (SELECT o_orderkey, {DAY} AS d FROM orders)""",
)
def _(t: Tables):
    return t.orders.selectExpr("o_orderkey", f"{DAY} as d").select("o_orderkey", D.align_year("d").alias("aligned"))


ISO = "cast(cast(o_orderdate as date) as string)"
DATE_TEXT = f"""CASE o_custkey % 5
    WHEN 0 THEN concat(substr({ISO}, 9, 2), '/', substr({ISO}, 6, 2), '/', substr({ISO}, 1, 4))
    WHEN 1 THEN concat(cast(day(o_orderdate) as string), '/', cast(month(o_orderdate) as string), '/', substr({ISO}, 1, 4))
    WHEN 2 THEN {ISO}
    WHEN 3 THEN concat({ISO}, ' 00:00:00')
    ELSE 'sem data' END"""


@query(
    "F14_parse_date",
    """SELECT o_orderkey, CASE WHEN o_custkey % 5 < 2 THEN cast(o_orderdate AS DATE) END AS dmy,
        CASE WHEN o_custkey % 5 = 2 THEN cast(o_orderdate AS DATE) END AS ymd FROM orders""",
)
def _(t: Tables):
    return t.orders.selectExpr("o_orderkey", f"{DATE_TEXT} as d").select(
        "o_orderkey", D.try_date("d", "d/M/yyyy").alias("dmy"), D.try_date("d", "yyyy-M-d").alias("ymd")
    )


@query(
    "F15_completed_years",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        CAST(sign(ship - born) * ((greatest(ship, born) - least(ship, born)) // 10000) AS INTEGER) AS years
        FROM (SELECT *, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS ship,
                CAST(strftime(o_orderdate - INTERVAL 3 YEAR, '%Y%m%d') AS BIGINT) AS born
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def _(t: Tables):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    born = F.add_months(F.col("o_orderdate").cast("date"), -36)
    years = D.completed_years(F.col("l_shipdate").cast("date"), born)
    return both.select(*LINE_KEYS.split(", "), years.alias("years"))


EPI_SQL = sql(
    """SELECT o_orderkey, k.year AS epi_year, k.week_num AS epi_week, k.start_date AS week_start,
        k.end_date AS week_end, 'SE' || lpad(CAST(k.week_num AS VARCHAR), 2, '0') || '.' || k.year AS epi_label
        FROM orders LEFT JOIN calendar k ON """
    + DAY
    + " BETWEEN k.start_date AND k.end_date",
    "calendar",
)


@query("F16_epi_year", sql(f"SELECT o_orderkey, k.year AS epi_year FROM orders LEFT JOIN calendar k ON {DAY} BETWEEN k.start_date AND k.end_date", "calendar"))
def _(t: Tables):
    return t.orders.selectExpr("o_orderkey", f"{DAY} as d").select("o_orderkey", D.epi_year("d").alias("epi_year"))


@query("F17_epi_week", EPI_SQL)
def _(t: Tables):
    week = F.col("w")
    return (
        t.orders.selectExpr("o_orderkey", f"{DAY} as d")
        .withColumn("w", D.epi_week("d"))
        .select(
            "o_orderkey",
            week["year"].alias("epi_year"),
            week["week"].alias("epi_week"),
            week["start"].alias("week_start"),
            week["end"].alias("week_end"),
            D.epi_label("d").alias("epi_label"),
        )
    )


_FIRST = ", ".join(f"({w}, '{m}')" for m, w in zip(vocab.MONTHS, vocab.MONTH_FIRST_WEEK))


@query(
    "F18_epi_month_name",
    f"""SELECT p_partkey, (SELECT arg_max(m, w) FROM (VALUES {_FIRST}) AS b(w, m) WHERE w <= p_size) AS month_name
        FROM part""",
)
def _(t: Tables):
    return t.part.select("p_partkey", D.epi_month_name("p_size").alias("month_name"))


@query(
    "F19_month_name",
    f"SELECT o_orderkey, ([{list_sql(vocab.MONTHS)}])[month(o_orderdate)] AS month_name FROM orders",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", D.month_name("o_orderdate").alias("month_name"))


STATE_NAMES = {code: X.plain_name(entry[0]) for code, entry in vocab.STATES.items()}


@query(
    "F20_state_name",
    f"""SELECT c_custkey, {case_sql("code", STATE_NAMES)} AS or_null, {case_sql("code", STATE_NAMES, "code")} AS or_same,
        {case_sql("code", STATE_NAMES, "'NOT REPORTED'")} AS or_missing
        FROM (SELECT c_custkey, {STATE_CODE} AS code FROM customer)""",
)
def _(t: Tables):
    return t.customer.selectExpr("c_custkey", f"{STATE_CODE} as code").select(
        "c_custkey",
        X.state_name("code").alias("or_null"),
        X.state_name("code", "keep").alias("or_same"),
        X.state_name("code", "missing").alias("or_missing"),
    )


@query(
    "F21_known_state",
    f"""SELECT c_custkey, CASE WHEN name IN ({list_sql(STATE_NAMES.values())}) THEN name ELSE 'NOT_REPORTED' END AS state
        FROM (SELECT c_custkey, {STATE_TEXT} AS name FROM customer)""",
)
def _(t: Tables):
    return t.customer.selectExpr("c_custkey", f"{STATE_TEXT} as name").select("c_custkey", X.known_state("name").alias("state"))


@query(
    "F22_sex",
    f"""SELECT c_custkey, CASE upper(left(s, 1)) WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' END AS sex,
        CASE upper(left(s, 1)) WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' ELSE 'UNKNOWN' END AS sex_or_unknown
        FROM (SELECT c_custkey, {SEX_TEXT} AS s FROM customer)""",
)
def _(t: Tables):
    return t.customer.selectExpr("c_custkey", f"{SEX_TEXT} as s").select(
        "c_custkey", X.normalize_sex("s").alias("sex"), X.normalize_sex("s", "UNKNOWN").alias("sex_or_unknown")
    )


@query(
    "F23_age_text",
    f"""SELECT {LINE_KEYS},
        CASE WHEN regexp_matches(a, '.D') THEN 0 WHEN regexp_matches(a, '^[0-9]+A')
            THEN CAST(regexp_extract(a, '^[0-9]+') AS INTEGER) WHEN regexp_matches(a, '^[0-9]+$') THEN CAST(a AS INTEGER)
            END AS days_years,
        CASE WHEN a = '' THEN NULL WHEN regexp_matches(a, '^[0-9]+$') THEN CAST(a AS INTEGER)
            WHEN strpos(a, 'A') > 0 THEN CAST(split_part(a, 'A', 1) AS INTEGER)
            WHEN right(a, 1) IN ('M', 'D') THEN 0 END AS units
        FROM (SELECT *, {AGE_TEXT} AS a FROM lineitem)""",
)
def _(t: Tables):
    return lines(t, a=AGE_TEXT).select(
        *LINE_KEYS.split(", "), R.age_days_years("a").alias("days_years"), R.age_units("a").alias("units")
    )


@query(
    "F24_cutoff_result",
    f"""SELECT {LINE_KEYS}, CASE WHEN v = 'REAGENTE' THEN NULL WHEN x IS NULL THEN -2 WHEN x < 0.8 THEN 0 ELSE 1 END AS code
        FROM (SELECT *, CASE WHEN left(v, 1) = ',' THEN try_cast(substr(v, 2) AS DOUBLE) / 100
                ELSE try_cast(regexp_replace(v, ',', '.') AS DOUBLE) END AS x
            FROM (SELECT *, {INDEX_TEXT} AS v FROM lineitem))""",
)
def _(t: Tables):
    return lines(t, v=INDEX_TEXT).select(*LINE_KEYS.split(", "), R.cutoff_result("v", 0.80).alias("code"))


@query(
    "F25_band_with_indeterminate",
    f"""SELECT {LINE_KEYS}, CASE WHEN i < 0.8 THEN 0 WHEN i <= 1.0 THEN -3 WHEN i > 1.0 THEN 1 ELSE -2 END AS code
        FROM (SELECT *, l_quantity / 40 AS i FROM lineitem)""",
)
def _(t: Tables):
    index = F.col("l_quantity") / 40
    return t.lineitem.select(
        *LINE_KEYS.split(", "),
        R.band_result(index, 0.80, 1.00, vocab.INDETERMINATE, vocab.UNRECOGNISED).alias("code"),
    )


@query(
    "F26_band_or_null",
    f"""SELECT {LINE_KEYS}, CASE WHEN i < 0.9 THEN 0 WHEN i > 1.1 THEN 1 END AS code
        FROM (SELECT *, l_quantity / 40 AS i FROM lineitem)""",
)
def _(t: Tables):
    index = F.col("l_quantity") / 40
    return t.lineitem.select(*LINE_KEYS.split(", "), R.band_result(index, 0.9, 1.1, None).alias("code"))


RESULT_WORDS = {**{w: 1 for w in SABIN_POSITIVE}, **{w: 0 for w in SABIN_NEGATIVE}}
WORD = """CASE l_linenumber % 6 WHEN 0 THEN 'DETECTADO' WHEN 1 THEN 'NAO DETECTADO' WHEN 2 THEN 'REAGENTE 1:200'
    WHEN 3 THEN concat('DETECTADO VIRUS DENGUE TIPO ', cast(l_suppkey % 6 as string)) WHEN 4 THEN 'NAO RE' ELSE NULL END"""


@query(
    "F27_result_words",
    f"SELECT {LINE_KEYS}, {case_sql('w', RESULT_WORDS, '-2')} AS code FROM (SELECT *, {WORD} AS w FROM lineitem)",
)
def _(t: Tables):
    return lines(t, w=WORD).select(*LINE_KEYS.split(", "), R.lookup("w", RESULT_WORDS, vocab.UNRECOGNISED).alias("code"))


OLD_WORD = """CASE l_linenumber % 5 WHEN 0 THEN 'nao reativo' WHEN 1 THEN 'INFERIOR A 1' WHEN 2 THEN 'REAGENTE FRACO'
    WHEN 3 THEN 'DETECTADO TIPO 9' ELSE 'ILEGIVEL' END"""


@query(
    "F28_legacy_words",
    f"""SELECT {LINE_KEYS}, CASE WHEN d >= DATE '2024-01-01' THEN -2 WHEN l_linenumber % 5 IN (0, 1) THEN 0
        WHEN l_linenumber % 5 IN (2, 3) THEN 1 ELSE -2 END AS code
        FROM (SELECT *, cast(l_shipdate as date) + {SHIFT} AS d FROM lineitem)""",
)
def _(t: Tables):
    early = F.col("d") < F.lit("2024-01-01").cast("date")
    rules = [(early & F.col("w").ilike(p), code) for p, code in SABIN_LEGACY]
    return lines(t, w=OLD_WORD, d=f"cast(l_shipdate as date) + {SHIFT}").select(
        *LINE_KEYS.split(", "), R.classify(rules, vocab.UNRECOGNISED).alias("code")
    )


@query(
    "F29_coalesce_nullif",
    sql(
        "SELECT lab_id, coalesce(location, 'NOT REPORTED') AS location, nullif(sex, 'M') AS sex, count(*) AS n FROM lines GROUP BY ALL",
        "lines",
    ),
)
def _(t: Tables):
    return lab_lines(t).groupBy(
        "lab_id",
        F.coalesce("location", F.lit(vocab.MISSING)).alias("location"),
        F.nullif("sex", F.lit("M")).alias("sex"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "F30_date_arithmetic",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 6 AS later, CAST(o_orderdate AS DATE) - 364 AS earlier FROM orders",
)
def _(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", F.date_add(day, 6).alias("later"), F.date_sub(day, 364).alias("earlier"))


@query(
    "F31_place_key",
    "SELECT doc_id, md5(regexp_replace(replace(replace(upper(strip_accents(text)), '-', ' '), 'ß', 'SS'), '[^A-Z0-9 ]', '', 'g')) AS key "
    "FROM (SELECT doc_id, replace(text, 'ß', 'ss') AS text FROM documents)",
)
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(X.place_key("text").cast("binary")).alias("key"))


@query(
    "F32_id_prefix",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN substr(c_name, 10) ELSE c_name END AS id, "
    "c_name LIKE 'Customer#00000%' AS starts FROM customer",
)
def _(t: Tables):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 10 == 0, F.substring(name, F.lit(10), F.length(name))).otherwise(name).alias("id"),
        F.startswith(name, F.lit("Customer#00000")).alias("starts"),
    )
