"""Data-quality checks on the bridge stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import AS_OF, MIN_TESTS, coded_lines, combined, dimensions, lab_lines, list_sql, samples, sql
from labwatch.functions.dates import epi_calendar
from labwatch.functions.text import state_names
from labwatch.operators import windows as W
from labwatch.plans import quality as Q
from labwatch.plans.combine import add_epiweek, fix_place

KITS = ["arbo_pcr_3", "denv_pcr", "ns1_antigen", "igm_serum", "chikv_pcr"]
SMALL = [*vocab.RESULT_COLUMNS]
ROW = ["sample_id", "test_id", "test_kit", "age", "date_testing"]
ROW_SQL = ", ".join(ROW)
BRAZIL = f"({list_sql([*state_names(), vocab.MISSING])})"


@query("Q01_not_null", sql(f"SELECT {ROW_SQL} FROM samples WHERE age IS NULL AND date_testing >= DATE '2024-01-01'", "samples"))
def _(t: Tables):
    recent = F.col("date_testing") >= F.lit("2024-01-01").cast("date")
    return Q.failing(samples(t), Q.is_null("age"), recent).select(*ROW)


@query("Q02_unique", "SELECT l_orderkey AS key0, l_linenumber AS key1, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t: Tables):
    return Q.repeated_values(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "Q02_unique_expression",
    sql("SELECT concat(test_id, analyte) AS key0, count(*) AS n FROM lines GROUP BY 1 HAVING count(*) > 1", "lines"),
)
def _(t: Tables):
    return Q.repeated_values(lab_lines(t), F.concat("test_id", "analyte"))


@query("Q03_accepted_values", sql(f"SELECT test_kit, count(*) AS n FROM samples WHERE test_kit NOT IN ({list_sql(KITS)}) GROUP BY 1", "samples"))
def _(t: Tables):
    return Q.unexpected_values(samples(t), "test_kit", KITS)


@query(
    "Q04_relationships",
    "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1",
)
def _(t: Tables):
    return Q.orphans(t.orders, "o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey")


@query("Q05_not_accepted_values", sql(f"SELECT {ROW_SQL} FROM samples WHERE test_kit IN ('UNKNOWN')", "samples"))
def _(t: Tables):
    return Q.failing(samples(t), F.col("test_kit").isin("UNKNOWN")).select(*ROW)


@query(
    "Q06_accepted_range",
    sql(f"SELECT {ROW_SQL}, qty_original_lines FROM samples WHERE age > 90 OR age < 3 OR qty_original_lines > 3", "samples"),
)
def _(t: Tables):
    bad = Q.outside("age", 3, 90) | Q.outside("qty_original_lines", 1, 3)
    return Q.failing(samples(t), bad).select(*ROW, "qty_original_lines")


@query(
    "Q07_not_null_share",
    sql(f"SELECT count(age) / count(*) AS share FROM samples WHERE date_testing >= DATE '{AS_OF}' - 15 HAVING count(age) / count(*) < 0.95", "samples"),
)
def _(t: Tables):
    recent = F.col("date_testing") >= F.date_sub(F.lit(AS_OF).cast("date"), 15)
    return Q.not_null_share(samples(t), "age", 0.95, recent)


@query("Q08_equal_rowcount", "SELECT (SELECT count(*) FROM orders)::BIGINT AS rows_a, (SELECT count(*) FROM lineitem)::BIGINT AS rows_b")
def _(t: Tables):
    return Q.unequal_counts(t.orders, t.lineitem)


@query(
    "Q09_expression_is_true",
    sql(f"SELECT {ROW_SQL} FROM samples WHERE NOT coalesce(date_testing <= DATE '{AS_OF}' AND regexp_matches(test_id, '^[0-9]+$'), FALSE)", "samples"),
)
def _(t: Tables):
    return Q.failing(samples(t), Q.violates(f"date_testing <= date '{AS_OF}' and test_id rlike '^[0-9]+$'")).select(*ROW)


@query("Q10_value_length", "SELECT c_custkey, c_name FROM customer WHERE length(c_mktsegment) <> 9")
def _(t: Tables):
    return Q.wrong_length(t.customer, "c_mktsegment", 9).select("c_custkey", "c_name")


@query("Q11_state_names", sql(f"SELECT state, count(*) AS n FROM placed WHERE state NOT IN {BRAZIL} GROUP BY 1", "placed"))
def _(t: Tables):
    dims = dimensions(t)
    placed = fix_place(samples(t), dims.fix_state, dims.fix_location)
    return Q.failing(placed, Q.unknown_state("state")).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "Q12_some_result_coded",
    sql(f"SELECT sample_id, analyte, result FROM coded WHERE {' AND '.join(f'{c} = -1' for c in SMALL)}", "coded"),
)
def _(t: Tables):
    return Q.failing(coded_lines(t), Q.no_result_coded()).select("sample_id", "analyte", "result")


@query(
    "Q12_some_result_text",
    sql(f"SELECT {ROW_SQL} FROM samples WHERE {' AND '.join(f'{c} = {chr(39)}NT{chr(39)}' for c in SMALL)}", "samples"),
)
def _(t: Tables):
    return Q.failing(samples(t), Q.no_result_text()).select(*ROW)


@query(
    "Q13_one_result",
    sql(f"SELECT sample_id, analyte, result FROM coded WHERE {' + '.join(SMALL)} NOT IN (-6, -5)", "coded"),
)
def _(t: Tables):
    return Q.failing(coded_lines(t), Q.not_exactly_one_result()).select("sample_id", "analyte", "result")


@query(
    "Q14_repeated_sets",
    "SELECT count(*) AS repeated_sets FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) HAVING count(*) > 100",
)
def _(t: Tables):
    return Q.too_many_repeats(t.lineitem, ["l_orderkey", "l_linenumber"], 100)


@query(
    "Q15_distinct_share",
    "SELECT (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) / count(*) AS ratio FROM lineitem "
    "HAVING (SELECT count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)) / count(*) NOT BETWEEN 0.9 AND 1",
)
def _(t: Tables):
    return Q.distinct_share_outside(t.lineitem, ["l_orderkey"], 0.9, 1.0)


@query("Q16_more_rows_than", "SELECT count(*) AS rows FROM region HAVING count(*) < 10")
def _(t: Tables):
    return Q.fewer_rows_than(t.region, 10)


@query("Q17_repetitions", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING NOT count(*) BETWEEN 2 AND 8")
def _(t: Tables):
    return Q.repetitions_outside(t.lineitem, "l_orderkey", 2, 8)


@query(
    "Q18_weekly_volume",
    sql(
        f"""SELECT * FROM (SELECT k.end_date AS epiweek_end_date, k.start_date AS epiweek_start_date, k.week_num AS epiweek_number,
        count(s.sample_id) AS test_count FROM calendar k LEFT JOIN samples s ON s.date_testing BETWEEN k.start_date AND k.end_date
        WHERE k.start_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY ALL) WHERE test_count NOT BETWEEN 500 AND 3000""",
        "samples",
        "calendar",
    ),
)
def _(t: Tables):
    return Q.weekly_volume_outside(samples(t), epi_calendar(t.spark), AS_OF, 500, 3000)


@query(
    "Q19_line_counts",
    sql(
        """SELECT CAST((SELECT sum(qty_original_lines) FROM samples) - (SELECT count(*) FROM coded WHERE age IS NOT NULL) AS BIGINT)
        AS diff_qty_lines""",
        "samples",
        "coded",
    ),
)
def _(t: Tables):
    return Q.line_counts_exceed(samples(t), coded_lines(t).filter("age IS NOT NULL"))


def _has(p: str) -> str:
    return f"coalesce({p}_test_result IN ('Pos', 'Neg'), NULL)"


_SINGLE = {"ns1_antigen": "denv", "denv_pcr": "denv", "zikv_pcr": "zikv", "chikv_pcr": "chikv", "mayv_pcr": "mayv", "orov_pcr": "orov", "yfv_pcr": "yfv"}
_ANY = " OR ".join(_has(p.lower()) for p in vocab.PATHOGENS)
_KIT_SQL = " OR ".join(f"(test_kit = '{k}' AND NOT {_has(p)})" for k, p in _SINGLE.items())


@query(
    "Q20_kit_agrees",
    sql(
        f"""SELECT {ROW_SQL} FROM samples WHERE (test_kit = 'arbo_pcr_3' AND NOT ({_has("denv")} AND {_has("zikv")} AND {_has("chikv")}
        AND mayv_test_result = 'NT' AND wnv_test_result = 'NT' AND orov_test_result = 'NT' AND yfv_test_result = 'NT'))
        OR (test_kit IN ('igg_serum', 'igm_serum') AND NOT ({_ANY})) OR {_KIT_SQL}""",
        "samples",
    ),
)
def _(t: Tables):
    return Q.failing(samples(t), Q.kit_disagrees()).select(*ROW)


@query("Q21_same_lines", sql("SELECT (SELECT count(*) FROM samples)::BIGINT AS rows_a, (SELECT count(*) FROM coded)::BIGINT AS rows_b", "samples", "coded"))
def _(t: Tables):
    return Q.unequal_counts(samples(t), coded_lines(t))


@query("Q21_no_fan_out", sql("SELECT 1::BIGINT AS rows_a, 1::BIGINT AS rows_b FROM samples WHERE (SELECT count(*) FROM samples) <> (SELECT count(*) FROM combined)", "samples", "combined"))
def _(t: Tables):
    return Q.unequal_counts(samples(t), combined(t))


@query("Q22_freshness", sql("SELECT max(date_testing) AS newest FROM samples HAVING max(date_testing) < DATE '2030-01-01' - 5", "samples"))
def _(t: Tables):
    return Q.stale(samples(t), "date_testing", "2030-01-01")


@query("Q23_future_dates", sql(f"SELECT {ROW_SQL} FROM samples WHERE date_testing > DATE '{AS_OF}'", "samples"))
def _(t: Tables):
    return Q.failing(samples(t), F.col("date_testing") > F.lit(AS_OF).cast("date")).select(*ROW)


@query("Q23_unknown_kit", sql(f"SELECT {ROW_SQL} FROM samples WHERE test_kit = 'UNKNOWN' OR test_kit IS NULL", "samples"))
def _(t: Tables):
    return Q.failing(samples(t), Q.is_null("test_kit") | (F.col("test_kit") == "UNKNOWN")).select(*ROW)


@query("Q23_null_results", sql("SELECT sample_id, analyte, date_testing FROM coded WHERE result IS NULL", "coded"))
def _(t: Tables):
    return Q.failing(coded_lines(t), Q.is_null("result")).select("sample_id", "analyte", "date_testing")


@query("Q23_lines_per_sample", sql("SELECT sample_id, count(*) AS n FROM coded GROUP BY 1 HAVING count(*) > 3", "coded"))
def _(t: Tables):
    return coded_lines(t).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 3")


@query(
    "Q23_allowed_line_counts",
    sql("SELECT DISTINCT count(*) AS count_lines FROM coded GROUP BY sample_id HAVING count(*) NOT IN (1, 2, 3)", "coded"),
)
def _(t: Tables):
    return Q.group_sizes_other_than(coded_lines(t), "sample_id", [1, 2, 3])


def suite(t: Tables):
    rows = add_epiweek(samples(t))
    return rows, [
        Q.Check("sample_present", Q.is_null("sample_id")),
        Q.Check("age_range", Q.outside("age", 0, 90), warn_above=10, error_above=100_000_000),
        Q.Check("age_present", Q.is_null("age"), where="date_testing >= date '2024-01-01'", severity="warn"),
        Q.Check("kit_known", Q.not_in("test_kit", KITS)),
        Q.Check("some_result", Q.no_result_text()),
        Q.Check("sample_unique", keys=Q.Keys(("sample_id",), unique=True)),
        Q.Check("volume", total=(F.count(F.lit(1)) < MIN_TESTS).cast("long")),
    ]


@query(
    "Q24_suite",
    sql(
        f"""SELECT "check", failures, CASE WHEN "check" = 'age_range' THEN CASE WHEN failures > 100000000 THEN 'error' WHEN failures > 10 THEN 'warn' ELSE 'pass' END
            WHEN "check" = 'age_present' THEN CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END
            WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status
        FROM (SELECT 'sample_present' AS "check", count(*) FILTER (sample_id IS NULL) AS failures FROM samples
            UNION ALL SELECT 'age_range', count(*) FILTER (age < 0 OR age > 90) FROM samples
            UNION ALL SELECT 'age_present', count(*) FILTER (age IS NULL AND date_testing >= DATE '2024-01-01') FROM samples
            UNION ALL SELECT 'kit_known', count(*) FILTER (test_kit NOT IN ({list_sql(KITS)})) FROM samples
            UNION ALL SELECT 'some_result', count(*) FILTER ({' AND '.join(f"{c} = 'NT'" for c in SMALL)}) FROM samples
            UNION ALL SELECT 'sample_unique', count(*) - count(DISTINCT sample_id) FROM samples
            UNION ALL SELECT 'volume', CASE WHEN count(*) < {MIN_TESTS} THEN 1 ELSE 0 END FROM samples)""",
        "samples",
    ),
)
def _(t: Tables):
    return Q.run_checks(*suite(t))


@query(
    "Q24_suite_of_keys",
    """SELECT "check", failures, CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status FROM (
        SELECT 'line_unique' AS "check", count(*) AS failures FROM
            (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'order_unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'order_share', CASE WHEN count(DISTINCT l_orderkey) / count(*) NOT BETWEEN 0.9 AND 1 THEN 1 ELSE 0 END FROM lineitem
        UNION ALL SELECT 'line_share', CASE WHEN (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) / count(*)
            NOT BETWEEN 0.9 AND 1 THEN 1 ELSE 0 END FROM lineitem
        UNION ALL SELECT 'few_repeats', CASE WHEN count(*) > 100 THEN 1 ELSE 0 END FROM
            (SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1)
        UNION ALL SELECT 'quantity', count(*) FROM lineitem WHERE l_quantity > 45)""",
)
def _(t: Tables):
    """Five checks of keys and one of rows: two scans and one shuffle of fingerprints."""
    return Q.run_checks(
        t.lineitem,
        [
            Q.Check("line_unique", keys=Q.Keys(("l_orderkey", "l_linenumber"), unique=True)),
            Q.Check("order_unique", keys=Q.Keys(("l_orderkey",), unique=True)),
            Q.Check("order_share", keys=Q.Keys(("l_orderkey",), share=(0.9, 1))),
            Q.Check("line_share", keys=Q.Keys(("l_orderkey", "l_linenumber"), share=(0.9, 1))),
            Q.Check("few_repeats", keys=Q.Keys(("l_partkey", "l_suppkey"), at_most=100)),
            Q.Check("quantity", Q.outside("l_quantity", None, 45)),
        ],
    )


@query(
    "Q12_some_result_of_two",
    sql("SELECT sample_id, analyte, result FROM coded WHERE denv_test_result = -1 AND chikv_test_result = -1", "coded"),
)
def _(t: Tables):
    """Lines that tell nothing of two pathogens: the check on a narrower list of results."""
    return Q.failing(coded_lines(t), Q.none_of(["denv_test_result", "chikv_test_result"], -1)).select("sample_id", "analyte", "result")


@query(
    "Q21_fan_out",
    """SELECT count(*)::BIGINT AS rows_a, (SELECT count(*) FROM orders)::BIGINT AS rows_b FROM orders LEFT JOIN
        (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0) ON o_custkey = c_custkey""",
)
def _(t: Tables):
    """A lookup whose key repeats makes rows: the check tells both counts."""
    keys = t.customer.select("c_custkey")
    looked_up = t.orders.join(keys.union(keys.filter("c_custkey % 7 = 0")), F.col("o_custkey") == F.col("c_custkey"), "left")
    return Q.unequal_counts(looked_up, t.orders)


@query(
    "Q25_lines_lost_by_a_stage",
    sql(
        """SELECT count(*)::BIGINT AS rows_a, (SELECT count(*) FROM (SELECT DISTINCT sample_id, analyte FROM coded))::BIGINT AS rows_b
        FROM coded""",
        "coded",
    ),
)
def _(t: Tables):
    """A stage that takes repeated lines out is told by both counts."""
    lines = coded_lines(t).select("sample_id", "analyte", *vocab.RESULT_COLUMNS)
    return Q.unequal_counts(lines, W.dedupe(lines, ["sample_id", "analyte"]))


@query("Q25_stage_line_counts", sql("SELECT CAST(1 AS BIGINT) AS rows_a, CAST(1 AS BIGINT) AS rows_b FROM lines WHERE FALSE", "lines"))
def _(t: Tables):
    lines = coded_lines(t).select("sample_id", *vocab.RESULT_COLUMNS)
    return Q.unequal_counts(lines, W.propagate(lines))
