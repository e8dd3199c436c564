"""Windows, ordering, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import (
    SAMPLE_COLUMNS,
    coded_lines,
    lab_lines,
    order_sql,
    samples,
    sql,
)
from labwatch.functions.text import sample_key
from labwatch.operators import windows as W
from labwatch.operators.merge import release_diff, shared_ids, split_feeds, strip_zero_prefix, union_feeds
from labwatch.session import scratch_dir

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
ALL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


@query(
    "W01_dedupe",
    f"""SELECT {", ".join(ALL)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {order_sql(ALL[2:])}) AS r FROM lineitem) WHERE r = 1""",
)
def _(t: Tables):
    return W.dedupe(t.lineitem.select(*ALL), ["l_orderkey", "l_linenumber"])


@query(
    "W02_dedupe_by_hash",
    sql(
        f"""SELECT * EXCLUDE (r) FROM (SELECT md5(concat(test_id, exame, patient_id)) AS key, test_id, exame, analyte, result,
        date_testing, row_number() OVER (PARTITION BY md5(concat(test_id, exame, patient_id))
            ORDER BY {order_sql(["test_id", "exame", "analyte", "result", "date_testing"])}) AS r FROM lines) WHERE r = 1""",
        "lines",
    ),
)
def _(t: Tables):
    rows = lab_lines(t).select(
        sample_key("test_id", "exame", "patient_id").alias("key"), "test_id", "exame", "analyte", "result", "date_testing"
    )
    return W.dedupe(rows, ["key"])


@query(
    "W03_first_by_order",
    """SELECT l_suppkey, l_shipdate, l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (
        PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""",
)
def _(t: Tables):
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber"]
    return W.dedupe(t.lineitem.select("l_suppkey", *order), ["l_suppkey"], order)


_TEXTS = ", ".join(
    f"CASE max({c}) OVER s WHEN 1 THEN 'Pos' WHEN 0 THEN 'Neg' WHEN -1 THEN 'NT' END AS {c}" for c in vocab.RESULT_COLUMNS
)


@query(
    "W04_propagate",
    sql(
        f"""SELECT sample_id, analyte, result, date_testing, {_TEXTS}, count(*) OVER s AS qty_original_lines
        FROM coded WINDOW s AS (PARTITION BY sample_id)""",
        "coded",
    ),
)
def _(t: Tables):
    lines = coded_lines(t).select("sample_id", "analyte", "result", "date_testing", *vocab.RESULT_COLUMNS)
    return W.propagate(lines)


@query(
    "W05_line_counts",
    sql("SELECT sample_id, test_id, count(*) OVER (PARTITION BY sample_id) AS lines FROM coded", "coded"),
)
def _(t: Tables):
    return W.propagate(coded_lines(t), count="lines").select("sample_id", "test_id", "lines")


@query(
    "W06_drop_redundant",
    sql(
        """SELECT sample_id, analyte, result, age, date_testing FROM (SELECT *,
            count(*) FILTER (analyte IN ('DENV', 'ZIKV')) OVER t AS first_pair,
            count(*) FILTER (analyte IN ('CHIKV', 'MAYV')) OVER t AS second_pair FROM coded WINDOW t AS (PARTITION BY test_id))
        WHERE NOT (analyte = 'ZIKV' AND first_pair = 2) AND NOT (analyte = 'MAYV' AND second_pair = 2)""",
        "coded",
    ),
)
def _(t: Tables):
    lines = coded_lines(t).select("sample_id", "test_id", "analyte", "result", "age", "date_testing")
    return W.drop_redundant(lines, "test_id", "analyte", [("DENV", "ZIKV"), ("CHIKV", "MAYV")]).drop("test_id")


@query(
    "W07_running_total",
    """SELECT c_nationkey, day, n, CAST(sum(n) OVER (PARTITION BY c_nationkey ORDER BY day) AS BIGINT) AS total FROM (
        SELECT c_nationkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2)""",
)
def _(t: Tables):
    daily = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return W.running_total(daily, ["c_nationkey"], "day", "n", "total")


@query(
    "W07_national_total",
    """SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total FROM
        (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)""",
)
def _(t: Tables):
    """One entity for the whole country: ranges of days are summed apart, then their totals."""
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return W.running_total_by_range(daily, [], "day", "n", "total")


@query(
    "W07_line_total",
    """SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_returnflag
        ORDER BY l_orderkey) AS BIGINT) AS total FROM lineitem""",
)
def _(t: Tables):
    """Three entities hold all lines; rows of one order share a total."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    out = W.running_total_by_range(lines, ["l_returnflag"], "l_orderkey", "q", "total")
    return out.select("l_orderkey", "l_linenumber", "total")


MONTHLY = "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2"


@query(
    "W08_latest_months",
    f"""WITH m AS ({MONTHLY}) SELECT * FROM m WHERE month IN (
        SELECT month FROM (SELECT month, rank() OVER (ORDER BY month DESC) AS r FROM (SELECT DISTINCT month FROM m)) WHERE r <= 12)""",
)
def _(t: Tables):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    monthly = t.orders.groupBy(month, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return W.recent_periods(monthly, "month", 12).select("month", "o_orderpriority", "n")


@query(
    "W09_collapse_samples",
    sql("SELECT * FROM samples", "samples"),
)
def _(t: Tables):
    return samples(t)


@query(
    "W10_staged_samples",
    sql("SELECT * FROM samples", "samples"),
)
def _(t: Tables):
    filled = W.propagate(coded_lines(t).select("sample_id", *SAMPLE_COLUMNS, *vocab.RESULT_COLUMNS))
    return W.dedupe(filled, ["sample_id"], SAMPLE_COLUMNS)


@query(
    "T01_ordered_output",
    f"WITH m AS ({MONTHLY}) SELECT month, o_orderpriority, n FROM m ORDER BY month, o_orderpriority DESC",
)
def _(t: Tables):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    monthly = t.orders.groupBy(month, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return monthly.orderBy(F.col("month").asc(), F.col("o_orderpriority").desc())


@query(
    "T01_order_of_a_written_table",
    f"WITH m AS ({MONTHLY}) SELECT month, o_orderpriority, n, row_number() OVER (ORDER BY month, o_orderpriority DESC) AS place FROM m",
)
def _(t: Tables):
    """Where each row stands in the table's files, one after another."""
    path = scratch_dir(t.spark, "ordered")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    monthly = t.orders.groupBy(month, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    monthly.orderBy(F.col("month").asc(), F.col("o_orderpriority").desc()).write.parquet(path)
    written = t.spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("line")
    )
    sizes = written.groupBy("file").agg(F.count(F.lit(1)).alias("lines")).collect()  # a row per file
    before, starts = 0, []
    for file, lines in sorted(sizes):
        starts.append((file, before))
        before += lines
    first = t.spark.createDataFrame(starts, "file string, before long")
    return written.join(first, "file").select("month", "o_orderpriority", "n", (F.col("before") + F.col("line") + 1).alias("place"))


@query(
    "T02_recent_days",
    "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 70",
)
def _(t: Tables):
    dated = t.orders.withColumn("__day", F.col("o_orderdate").cast("date"))
    return W.recent_days(dated, "__day", 70).drop("__day")


FEED = ["test_id", "exame", "analyte", "result", "date_testing"]


@query(
    "T03_union_distinct",
    sql(" UNION ".join(f"SELECT 'L{i}' AS lab_id, {', '.join(FEED)} FROM lines WHERE lab_id = 'LAB{i}'" for i in range(8)), "lines"),
)
def _(t: Tables):
    lines = lab_lines(t)
    return split_feeds(lines, {f"L{i}": F.col("lab_id") == f"LAB{i}" for i in range(8)}, FEED)


@query(
    "T03_union_of_feeds",
    sql(" UNION ".join(f"SELECT 'L{i}' AS lab_id, {', '.join(FEED)} FROM lines WHERE lab_id = 'LAB{i}'" for i in range(8)), "lines"),
)
def _(t: Tables):
    """The same for feeds with plans of their own."""
    lines = lab_lines(t)
    return union_feeds({f"L{i}": lines.filter(F.col("lab_id") == f"LAB{i}") for i in range(8)}, FEED)


OLD, NEW = "o_orderstatus <> 'F'", "o_orderstatus <> 'O'"


@query(
    "T04_shared_ids",
    f"SELECT o_custkey FROM orders WHERE {OLD} INTERSECT SELECT o_custkey FROM orders WHERE {NEW}",
)
def _(t: Tables):
    return shared_ids(t.orders.filter(OLD), t.orders.filter(NEW), "o_custkey")


ID_TEXT = """CASE WHEN o_orderpriority < '3' THEN concat('00000', cast(o_custkey + 1 as string))
    ELSE cast(o_custkey + 1 as string) END"""


@query(
    "T05_release_diff",
    f"""WITH ids AS (SELECT o_orderstatus, CAST(o_custkey + 1 AS VARCHAR) AS id FROM orders),
        o AS (SELECT DISTINCT id FROM ids WHERE {OLD}), n AS (SELECT DISTINCT id FROM ids WHERE {NEW})
        SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'removed' WHEN o.id IS NULL THEN 'added' ELSE 'kept' END AS status
        FROM o FULL JOIN n ON o.id = n.id""",
)
def _(t: Tables):
    ids = t.orders.withColumn("id", F.expr(ID_TEXT))
    return release_diff(ids.filter(OLD), ids.filter(NEW), "id", strip_zero_prefix)
