"""Joins."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import (
    AS_OF,
    dimensions,
    lab_lines,
    samples,
    sql,
    summary,
)
from labwatch.functions.dates import epi_calendar
from labwatch.operators.joins import band_join, covering_join, dense_grid, interval_join, join_back, pattern_join
from labwatch.operators.merge import upsert
from labwatch.operators.shaping import unpivot_results
from labwatch.plans.combine import add_geography, combine_feeds, fix_place
from labwatch.plans.matrices import city_map, state_map
from labwatch.plans.quality import orphans, weekly_volume
from labwatch.schema import LAB_COLUMNS
from labwatch.session import stored
from labwatch.sources.dims import age_groups, test_methods

METHODS = ", ".join(f"('{k}', '{v}')" for k, v in vocab.KIT_METHODS.items())


def rows_n():
    return F.count(F.lit(1)).alias("n")


@query(
    "J01_kit_method",
    sql(
        f"""SELECT s.test_kit, m.test_method, count(*) AS n FROM samples s
        LEFT JOIN (VALUES {METHODS}) AS m(test_kit, test_method) ON s.test_kit = m.test_kit GROUP BY ALL""",
        "samples",
    ),
)
def _(t: Tables):
    joined = samples(t).join(test_methods(t.spark), "test_kit", "left")
    return joined.groupBy("test_kit", "test_method").agg(rows_n())


@query("J01_kit_method_map", sql(
    f"""SELECT s.test_kit, m.test_method, count(*) AS n FROM samples s
    LEFT JOIN (VALUES {METHODS}) AS m(test_kit, test_method) ON s.test_kit = m.test_kit GROUP BY ALL""", "samples"))
def _(t: Tables):
    rows = samples(t).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    )
    return combine_feeds({"ALL": rows.select(*LAB_COLUMNS)}, distinct=False).groupBy("test_kit", "test_method").agg(rows_n())


@query(
    "J02_band_join",
    sql("SELECT s.sample_id, s.age, b.age_group FROM samples s LEFT JOIN bands b ON s.age BETWEEN b.min_age AND b.max_age", "samples", "bands"),
)
def _(t: Tables):
    joined = band_join(samples(t), age_groups(t.spark), "age", "min_age", "max_age", width=10)
    return joined.select("sample_id", "age", "age_group")


@query(
    "J02_band_join_wide_bands",
    """SELECT o_orderkey, n_name FROM orders JOIN nation
        ON o_totalprice BETWEEN n_nationkey * 20000 AND n_nationkey * 20000 + 30000""",
)
def _(t: Tables):
    """Bands that overlap, but each price lies in two at most: the output grows with the orders only."""
    low = F.col("n_nationkey") * 20000
    bands = t.nation.select("n_name", low.alias("low"), (low + 30000).alias("high"))
    return band_join(t.orders, bands, "o_totalprice", "low", "high", "inner", width=10_000).select("o_orderkey", "n_name")


@query(
    "J02_bands_of_any_width",
    """SELECT s_suppkey, count(o_orderkey) AS n, count(DISTINCT o_custkey) AS customers FROM supplier
        JOIN orders ON o_totalprice BETWEEN s_suppkey * 700 AND s_suppkey * 700 + CAST(10 ** (s_suppkey % 7) AS BIGINT) GROUP BY 1""",
)
def _(t: Tables):
    """Bands of width 1 to 1,000,000 that overlap: no band is spread over buckets of its width.

    A customer counts in a band with the first of their orders there, the one whose predecessor by price lies below the
    band, so pairs of band and customer are not shuffled.
    """
    low = F.col("s_suppkey") * 700
    suppliers = t.supplier.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("copies"))
    high = low + F.pow(F.lit(10), F.col("s_suppkey") % 7).cast("long")
    bands = suppliers.select("s_suppkey", "copies", low.alias("low"), high.alias("high"))
    # Orders without a customer count for none; their own keys keep them out of one large group.
    of = F.when(F.col("o_custkey").isNull(), F.col("o_orderkey"))
    by_price = W.partitionBy("o_custkey", of).orderBy("o_totalprice")
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice").where("o_totalprice is not null")
    orders = orders.withColumn("before", F.lag("o_totalprice").over(by_price)).drop("o_orderkey")
    held = covering_join(orders, bands, "o_totalprice", "low", "high", "inner")
    first = F.col("o_custkey").isNotNull() & (F.col("before").isNull() | (F.col("before") < F.col("low")))
    return held.groupBy("s_suppkey").agg(F.sum("copies").alias("n"), F.count_if(first).alias("customers"))


@query(
    "J03_interval_join",
    sql(
        """SELECT s.sample_id, s.date_testing, k.end_date, k.week_num FROM samples s
        LEFT JOIN calendar k ON s.date_testing >= k.start_date AND s.date_testing <= k.end_date""",
        "samples",
        "calendar",
    ),
)
def _(t: Tables):
    joined = interval_join(samples(t), epi_calendar(t.spark), "date_testing", "start_date", "end_date")
    return joined.select("sample_id", "date_testing", "end_date", "week_num")


@query(
    "J04_pattern_join",
    sql(
        """SELECT c.sample_id, f.target_state FROM cleaned c LEFT JOIN fix_state f ON lower(c.state) = lower(f.source_state)""",
        "cleaned",
        "fix_state",
    ),
)
def _(t: Tables):
    rows = samples(t).withColumn("state", F.lower("state"))
    joined = pattern_join(rows, dimensions(t).fix_state, {"state": "source_state"})
    return joined.select("sample_id", "target_state")


@query(
    "J04_wildcard_join",
    """SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_name LIKE concat('%', right(n_name, 1), '_')""",
)
def _(t: Tables):
    patterns = t.nation.select("n_name", F.concat(F.lit("%"), F.substring("n_name", -1, 1), F.lit("_")).alias("pattern"))
    return pattern_join(t.customer, patterns, {"c_name": "pattern"}, ignore_case=False).select("c_custkey", "n_name")


@query(
    "J04_inner_wildcards",
    """SELECT o_orderkey, count(*) AS n, min(c_custkey) AS first FROM
        (SELECT o_orderkey, substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 12) AS code FROM orders) JOIN
        (SELECT c_custkey, '%' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 2 + CAST(c_custkey % 4 AS INTEGER)) || '%'
            || CASE WHEN c_custkey % 5 = 0 THEN '_' ELSE '' END AS pattern FROM customer)
        ON code LIKE pattern GROUP BY 1""",
)
def _(t: Tables):
    """As many patterns as customers, all with a wildcard first, two letters at least; equal ones are met once."""
    codes = t.orders.select("o_orderkey", F.substring(F.md5(F.col("o_orderkey").cast("string").cast("binary")), 1, 12).alias("code"))
    key = F.md5(F.col("c_custkey").cast("string").cast("binary"))
    inner = F.substring(key, F.lit(1), (2 + F.col("c_custkey") % 4).cast("int"))
    tail = F.when(F.col("c_custkey") % 5 == 0, "_").otherwise("")
    patterns = t.customer.select("c_custkey", F.concat(F.lit("%"), inner, F.lit("%"), tail).alias("pattern"))
    kinds = patterns.groupBy("pattern").agg(rows_n(), F.min("c_custkey").alias("first"))
    found = pattern_join(codes, kinds, {"code": "pattern"}, "inner", ignore_case=False)
    return found.groupBy("o_orderkey").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


@query("J05_either_key", sql("SELECT sample_id, location, state FROM placed", "placed"))
def _(t: Tables):
    dims = dimensions(t)
    return fix_place(samples(t), dims.fix_state, dims.fix_location).select("sample_id", "location", "state")


@query(
    "J06_place_names",
    sql(
        """SELECT p.sample_id, m."CD_MUN" AS location_ibge_code FROM placed p LEFT JOIN municipalities m
        ON p.location LIKE m."NM_MUN_NORM" AND p.state LIKE m."NM_UF_NORM" """,
        "placed",
        "municipalities",
    ),
)
def _(t: Tables):
    dims = dimensions(t)
    placed = fix_place(samples(t), dims.fix_state, dims.fix_location)
    return add_geography(placed, dims.municipalities, dims.macroregions).select("sample_id", "location_ibge_code")


@query("J07_expression_key", sql("SELECT sample_id, macroregion, macroregion_code FROM combined", "combined"))
def _(t: Tables):
    dims = dimensions(t)
    placed = fix_place(samples(t), dims.fix_state, dims.fix_location)
    out = add_geography(placed, dims.municipalities, dims.macroregions)
    return out.select("sample_id", "macroregion", "macroregion_code")


MONTHLY = "SELECT date_trunc('month', o_orderdate)::DATE AS month, c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"


def _monthly(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    month = F.date_trunc("month", "o_orderdate").cast("date").alias("month")
    return rows.groupBy(month, "c_nationkey").agg(rows_n())


@query(
    "J08_dense_grid",
    f"""WITH m AS ({MONTHLY}) SELECT a.month, b.c_nationkey, CAST(coalesce(sum(m.n), 0) AS BIGINT) AS n
        FROM (SELECT DISTINCT month FROM m) a CROSS JOIN (SELECT DISTINCT c_nationkey FROM m) b
        LEFT JOIN m ON m.month = a.month AND m.c_nationkey = b.c_nationkey GROUP BY ALL""",
)
def _(t: Tables):
    monthly = stored(_monthly(t), "monthly")  # read for its months and for its counts
    return dense_grid(monthly, "month", monthly.select("month"), ["c_nationkey"], ["n"])


@query(
    "J09_grid_without_fill",
    f"""WITH m AS (SELECT * FROM ({MONTHLY}) WHERE n > 5) SELECT a.month, b.c_nationkey, CAST(sum(m.n) AS BIGINT) AS n
        FROM (SELECT DISTINCT month FROM m) a CROSS JOIN (SELECT DISTINCT c_nationkey FROM m) b
        LEFT JOIN m ON m.month = a.month AND m.c_nationkey = b.c_nationkey GROUP BY ALL""",
)
def _(t: Tables):
    monthly = stored(_monthly(t).filter("n > 5"), "monthly")
    return dense_grid(monthly, "month", monthly.select("month"), ["c_nationkey"], ["n"], fill=None)


@query(
    "J10_one_row_totals",
    "SELECT c_nationkey, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) AS share FROM customer GROUP BY 1",
)
def _(t: Tables):
    total = t.customer.agg(F.count(F.lit(1))).scalar()
    return t.customer.groupBy("c_nationkey").agg(rows_n(), (F.count(F.lit(1)).cast("double") / total).alias("share"))


@query(
    "J11_left_using",
    "SELECT n_nationkey, n_name, k.customers FROM nation LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS customers "
    "FROM customer WHERE c_acctbal > 9000 GROUP BY 1) k USING (n_nationkey)",
)
def _(t: Tables):
    rich = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return t.nation.join(rich, ["n_nationkey"], "left").select("n_nationkey", "n_name", "customers")


def _weeks(t: Tables):
    lab = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("lines"))
    estimates = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return lab, estimates


@query(
    "J12_full_outer",
    """SELECT coalesce(a.day, b.day) AS day, a.lines, b.orders
        FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem GROUP BY 1) a
        FULL JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1) b ON a.day = b.day""",
)
def _(t: Tables):
    lab, estimates = _weeks(t)
    return lab.join(estimates, "day", "full_outer").select("day", "lines", "orders")


@query(
    "J13_total_of_left_side",
    """SELECT coalesce(a.day, b.day) AS day, a.lines, b.orders, c.quantity
        FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS lines FROM lineitem GROUP BY 1) a
        FULL JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1) b ON a.day = b.day
        LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) c
        ON a.day = c.day""",
)
def _(t: Tables):
    _, estimates = _weeks(t)
    # The total belongs to the left side's days, so it is taken with them in one aggregation.
    lab = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")
    )
    return lab.join(estimates, "day", "full_outer").select("day", "lines", "orders", "quantity")


@query(
    "J14_recent_week_counts",
    sql(
        f"""SELECT k.end_date AS epiweek_end_date, k.start_date AS epiweek_start_date, k.week_num AS epiweek_number,
        count(l.date_testing) AS test_count FROM lines l RIGHT JOIN (SELECT * FROM calendar
            WHERE start_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}') k
        ON l.date_testing BETWEEN k.start_date AND k.end_date GROUP BY ALL""",
        "lines",
        "calendar",
    ),
)
def _(t: Tables):
    return weekly_volume(lab_lines(t), epi_calendar(t.spark), AS_OF)


@query(
    "J15_unpivot",
    sql(
        "SELECT sample_id, pathogen, result FROM (SELECT sample_id, "
        + ", ".join(f"{c} AS {p}" for p, c in vocab.RESULT_OF.items())
        + f" FROM samples) UNPIVOT INCLUDE NULLS (result FOR pathogen IN ({', '.join(vocab.PATHOGENS)}))",
        "samples",
    ),
)
def _(t: Tables):
    return unpivot_results(samples(t), ["sample_id"])


@query("J16_semi_join", "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def _(t: Tables):
    rich = t.customer.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(rich, "o_custkey", "left_semi").select(*t.orders.columns)


@query(
    "J17_orphans",
    "SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1",
)
def _(t: Tables):
    return orphans(t.lineitem, "l_suppkey", t.supplier.filter("s_acctbal > 0"), "s_suppkey")


POPULATION_SQL = """SELECT DISTINCT location_ibge_code, "Populacao" AS population FROM weekly
    LEFT JOIN macros ON "ADM2_PCODE" = 'BR' || location_ibge_code
    WHERE denv_test_result = 'Pos' AND test_kit IN ('arbo_pcr_3', 'ns1_antigen', 'denv_pcr')
        AND epiweek_enddate >= DATE '2025-12-21' AND location_ibge_code IS NOT NULL"""


@query("J18_population_of_places", sql(POPULATION_SQL, "weekly", "macros"))
def _(t: Tables):
    rows = city_map(summary(t), "DENV")
    return rows.select("location_ibge_code", F.col("População do município").alias("population")).distinct()


@query(
    "J18_population_of_states",
    sql(
        """SELECT DISTINCT state_code, p.population FROM weekly LEFT JOIN (SELECT "DS_UF_SIGLA" AS s,
            CAST(sum("Populacao") AS BIGINT) AS population FROM macros GROUP BY 1) p ON p.s = state_code
        WHERE denv_test_result = 'Pos' AND test_kit IN ('arbo_pcr_3', 'ns1_antigen', 'denv_pcr')
        AND epiweek_enddate >= DATE '2025-12-21' AND state <> 'NOT REPORTED'""",
        "weekly",
        "macros",
    ),
)
def _(t: Tables):
    rows = state_map(summary(t), "DENV")
    return rows.select(F.col("UF").alias("state_code"), F.col("População do estado").alias("population")).distinct()


@query(
    "J19_upsert_join",
    """SELECT o_orderkey, CASE WHEN o_orderpriority < '3' THEN 'changed' ELSE o_orderstatus END AS status,
        CASE WHEN o_orderstatus <> 'F' THEN 'old' ELSE 'new' END AS created_at FROM orders
        WHERE o_orderstatus <> 'F' OR o_orderpriority < '3'""",
)
def _(t: Tables):
    old = t.orders.filter("o_orderstatus <> 'F'").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.lit("old").alias("created_at")
    )
    new = t.orders.filter("o_orderpriority < '3'").select(
        "o_orderkey", F.lit("changed").alias("status"), F.lit("new").alias("created_at")
    )
    return upsert(old, new, ["o_orderkey"])


@query(
    "J20_statistics_on_lines",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, count(*) OVER w AS lines, max(l_quantity) OVER w AS top
        FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)""",
)
def _(t: Tables):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    stats = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"), F.max("l_quantity").alias("top"))
    # A low floor, so that the larger suppliers take the way of hot keys.
    return join_back(t.lineitem.select(*keys), stats, ["l_suppkey"], "lines", floor=600)
