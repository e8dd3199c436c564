"""Aggregations and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import (
    MIN_TESTS,
    coded_lines,
    dimensions,
    lab_lines,
    samples,
    sql,
)
from labwatch.functions.dates import year_month
from labwatch.operators import aggregates as A
from labwatch.operators.shaping import unpivot_results
from labwatch.session import stored

UNPIVOTED = (
    "SELECT * FROM (SELECT sample_id, lab_id, test_kit, date_testing, state, "
    + ", ".join(f"{c} AS {p}" for p, c in vocab.RESULT_OF.items())
    + f" FROM samples) UNPIVOT INCLUDE NULLS (result FOR pathogen IN ({', '.join(vocab.PATHOGENS)}))"
)


def long_samples(t: Tables):
    return unpivot_results(samples(t), ["sample_id", "lab_id", "test_kit", "date_testing", "state"])


def metrics_sql(min_tests: int) -> str:
    return f"""count(*) FILTER (result = 'Pos') AS "Pos", count(*) FILTER (result = 'Neg') AS "Neg",
        count(*) FILTER (result IN ('Pos', 'Neg')) AS totaltests,
        CASE WHEN count(*) FILTER (result IN ('Pos', 'Neg')) >= {min_tests}
            THEN count(*) FILTER (result = 'Pos') / count(*) FILTER (result IN ('Pos', 'Neg')) END AS posrate"""


@query(
    "A01_positivity_by_month",
    sql(
        f"SELECT strftime(date_testing, '%Y-%m') AS month, pathogen, {metrics_sql(50)} FROM long_samples GROUP BY 1, 2",
        "samples",
        long_samples=UNPIVOTED,
    ),
)
def _(t: Tables):
    return A.positivity(long_samples(t).withColumn("month", year_month("date_testing")), ["month", "pathogen"])


@query(
    "A02_conditional_counts",
    """SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS pos,
        sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)::BIGINT AS neg FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_suppkey").agg(
        A.count_where(flag == "A").alias("pos"), A.count_where(flag == "N").alias("neg")
    )


@query(
    "A03_pivot_max",
    """SELECT p_brand, max(CASE p_type WHEN 'STANDARD' THEN p_size END) AS standard,
        max(CASE p_type WHEN 'PROMO' THEN p_size END) AS promo,
        max(CASE p_type WHEN 'NONE' THEN p_size END) AS absent FROM part GROUP BY 1""",
)
def _(t: Tables):
    return A.pivot_fixed(
        t.part, ["p_brand"], "p_type", {"STANDARD": "standard", "PROMO": "promo", "NONE": "absent"}, "p_size"
    )


@query(
    "A04_pivot_sum",
    """SELECT p_brand, coalesce(sum(p_size) FILTER (p_type = 'STANDARD'), 0)::BIGINT AS standard,
        coalesce(sum(p_size) FILTER (p_type = 'NONE'), 0)::BIGINT AS absent FROM part GROUP BY 1""",
)
def _(t: Tables):
    sizes = t.part.withColumn("p_size", F.col("p_size").cast("long"))
    return A.pivot_fixed(sizes, ["p_brand"], "p_type", {"STANDARD": "standard", "NONE": "absent"}, "p_size", "sum", 0)


def melted(df, keys: list[str], dtype: str):
    """A wide table as plain rows (keys, label, value), so that a fixed statement can state it."""
    labels = [c for c in df.columns if c not in keys]
    if not labels:
        return df.limit(0).select(*keys, F.lit(None).cast("string").alias("label"), F.lit(None).cast(dtype).alias("value"))
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").cast(dtype).alias("value")) for c in labels])
    return df.select(*[F.col(f"`{k}`") for k in keys], F.inline(pairs))


_PART_GRID = """(SELECT DISTINCT p_brand FROM part) b CROSS JOIN (SELECT DISTINCT p_type AS label FROM part WHERE p_type IS NOT NULL) y"""


@query(
    "A05_pivot_observed",
    f"""SELECT b.p_brand, label, coalesce(sum(p_size), 0)::BIGINT AS value FROM {_PART_GRID}
        LEFT JOIN part p ON p.p_brand = b.p_brand AND p.p_type = label GROUP BY ALL""",
)
def _(t: Tables):
    sizes = t.part.withColumn("p_size", F.col("p_size").cast("long"))
    return melted(A.pivot_observed(sizes, ["p_brand"], "p_type", "p_size", "sum", 0), ["p_brand"], "long")


@query(
    "A06_pivot_well_filled",
    f"""WITH cells AS (SELECT p_brand, p_type, max(p_size) AS top FROM part GROUP BY 1, 2),
        good AS (SELECT p_type FROM cells GROUP BY 1
            HAVING count(*) FILTER (top > 40) / (SELECT count(DISTINCT p_brand) FROM cells) >= 0.8)
        SELECT b.p_brand, label, max(top)::INTEGER AS value FROM {_PART_GRID} JOIN good g ON g.p_type = label
        LEFT JOIN cells c ON c.p_brand = b.p_brand AND c.p_type = label GROUP BY ALL""",
)
def _(t: Tables):
    cells = t.part.groupBy("p_brand", "p_type").agg(F.max("p_size").alias("top"))
    filled = A.fill_rate(cells, "p_type", "p_brand", F.col("top") > 40)
    labels = A.observed_values(filled.filter("fill_rate >= 0.8"), "p_type")
    return melted(A.pivot_observed(cells, ["p_brand"], "p_type", "top", labels=labels), ["p_brand"], "int")


@query(
    "A07_two_levels",
    sql(
        """SELECT month, max(posrate) FILTER (pathogen = 'DENV') AS denv_rate, sum("Pos")::BIGINT AS pos, sum("Neg")::BIGINT AS neg
        FROM (SELECT strftime(date_testing, '%Y-%m') AS month, pathogen, """
        + metrics_sql(MIN_TESTS)
        + " FROM long_samples GROUP BY 1, 2) GROUP BY 1",
        "samples",
        long_samples=UNPIVOTED,
    ),
)
def _(t: Tables):
    monthly = A.positivity(
        long_samples(t).withColumn("month", year_month("date_testing")), ["month", "pathogen"], MIN_TESTS
    )
    return monthly.groupBy("month").agg(
        F.max(F.when(F.col("pathogen") == "DENV", F.col("posrate"))).alias("denv_rate"),
        F.sum("Pos").alias("pos"),
        F.sum("Neg").alias("neg"),
    )


@query(
    "A08_group_count",
    sql(
        "SELECT lab_id, test_kit, pathogen, result, count(*) AS n FROM long_samples WHERE result <> 'NT' GROUP BY ALL",
        "samples",
        long_samples=UNPIVOTED,
    ),
)
def _(t: Tables):
    tested = long_samples(t).filter(F.col("result") != "NT")
    return tested.groupBy("lab_id", "test_kit", "pathogen", "result").agg(F.count(F.lit(1)).alias("n"))


@query(
    "A09_count_distinct",
    sql("SELECT lab_id, count(DISTINCT patient_id) AS patients, count(DISTINCT date_testing) AS days FROM lines GROUP BY 1", "lines"),
)
def _(t: Tables):
    return lab_lines(t).groupBy("lab_id").agg(
        F.countDistinct("patient_id").alias("patients"), F.countDistinct("date_testing").alias("days")
    )


@query(
    "A09_distinct_from_states",
    sql(
        """SELECT lab_id, CAST(NULL AS VARCHAR) AS exame, count(DISTINCT patient_id) AS patients FROM lines GROUP BY lab_id
        UNION ALL SELECT NULL, exame, count(DISTINCT patient_id) FROM lines GROUP BY exame
        UNION ALL SELECT lab_id, exame, count(DISTINCT patient_id) FROM lines GROUP BY lab_id, exame""",
        "lines",
    ),
)
def _(t: Tables):
    """Patients per laboratory, per test and per both, from one table of states by both."""
    states = stored(A.distinct_states(lab_lines(t), ["lab_id", "exame"], "patient_id"), "states")
    none = F.lit(None).cast("string")
    parts = [A.distinct_counts(states, by, "patients") for by in (["lab_id"], ["exame"], ["lab_id", "exame"])]
    rows = [p.select(*[F.col(c) if c in p.columns else none.alias(c) for c in ("lab_id", "exame")], "patients") for p in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "A10_fill_count",
    sql("SELECT state, count(location) AS filled, count(*) AS n FROM samples GROUP BY 1", "samples"),
)
def _(t: Tables):
    return samples(t).groupBy("state").agg(F.count("location").alias("filled"), F.count(F.lit(1)).alias("n"))


CELLS = """SELECT date_trunc('month', o_orderdate)::DATE AS period, c_nationkey,
    CASE WHEN count(*) >= 8 THEN sum(o_totalprice) END AS value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


@query(
    "A11_completeness",
    f"""WITH cells AS (SELECT * FROM ({CELLS}) WHERE c_nationkey <> 5 OR period < DATE '1999-01-01'),
        weeks AS (SELECT count(DISTINCT period) AS total, max(period) AS newest,
            count(DISTINCT period) FILTER (period >= (SELECT max(period) FROM cells) - 364) AS recent FROM cells),
        h AS (SELECT c_nationkey, count(value) / any_value(total) AS h FROM cells, weeks GROUP BY 1),
        y AS (SELECT c_nationkey, count(value) / any_value(recent) AS y FROM cells, weeks WHERE period >= newest - 364 GROUP BY 1)
        SELECT c_nationkey, h, y, CASE WHEN h >= 0.7 THEN 'Bom Histórico' ELSE 'Ruim histórico' END AS history_class,
        CASE WHEN y >= 0.7 THEN 'Bom 12 meses' ELSE 'Ruim 12 meses' END AS year_class,
        CASE WHEN h >= 0.7 AND y >= 0.7 THEN 'Alta qualidade' WHEN h < 0.7 AND y < 0.7 THEN 'Baixa qualidade'
            WHEN h >= 0.7 AND y < 0.7 THEN 'Apenas histórico' ELSE 'Apenas 12 meses' END AS final_class
        FROM h LEFT JOIN y USING (c_nationkey)""",
)
def _(t: Tables):
    month = F.date_trunc("month", "o_orderdate").cast("date").alias("period")
    cells = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(month, "c_nationkey")
        .agg(F.when(F.count(F.lit(1)) >= 8, F.sum("o_totalprice")).alias("value"))
        .filter((F.col("c_nationkey") != 5) | (F.col("period") < F.lit("1999-01-01").cast("date")))
    )
    out = A.completeness(cells, "c_nationkey", "period", "value")
    return out.select("c_nationkey", "h", "y", "history_class", "year_class", "final_class").distinct()


@query("A12_scalar_max", "SELECT max(CAST(l_shipdate AS DATE)) AS newest, min(CAST(l_shipdate AS DATE)) AS oldest FROM lineitem")
def _(t: Tables):
    day = F.col("l_shipdate").cast("date")
    return t.lineitem.agg(F.max(day).alias("newest"), F.min(day).alias("oldest"))


@query("A13_sum_of_dimension", sql('SELECT "DS_UF_SIGLA" AS state_code, sum("Populacao")::BIGINT AS population FROM macros GROUP BY 1', "macros"))
def _(t: Tables):
    return dimensions(t).macroregions.groupBy(F.col("DS_UF_SIGLA").alias("state_code")).agg(
        F.sum("Populacao").alias("population")
    )


@query("A14_distinct", sql("SELECT DISTINCT lab_id, exame, analyte, test_kit FROM lines", "lines"))
def _(t: Tables):
    return lab_lines(t).select("lab_id", "exame", "analyte", "test_kit").distinct()


@query("A15_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("A16_global_having", "SELECT count(*) AS n FROM lineitem HAVING count(*) > 10")
def _(t: Tables):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n")).filter("n > 10")


@query(
    "A17_rate_per_100k",
    sql(
        """SELECT "ADM2_PCODE" AS code, CASE WHEN "Populacao" <> 0 THEN CAST("CO_UF" AS DOUBLE) / "Populacao" * 100000 END AS rate
        FROM macros""",
        "macros",
    ),
)
def _(t: Tables):
    return dimensions(t).macroregions.select(
        F.col("ADM2_PCODE").alias("code"), A.per_100k("CO_UF", "Populacao").alias("rate")
    )


@query(
    "A18_distinct_ratio",
    "SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) / count(*) AS ratio FROM lineitem",
)
def _(t: Tables):
    return A.distinct_ratio(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "A19_one_hot",
    sql(
        "SELECT lab_id, analyte, result, " + ", ".join(vocab.RESULT_COLUMNS) + ", count(*) AS n FROM coded GROUP BY ALL",
        "coded",
    ),
)
def _(t: Tables):
    return coded_lines(t).groupBy("lab_id", "analyte", "result", *vocab.RESULT_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
