"""Sources, sinks, releases and streams. Files are written below the shared scratch folder first."""

from __future__ import annotations

import io
import zipfile
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labwatch import vocab
from labwatch.catalog.base import ORACLES, Tables, query
from labwatch.catalog.bridge import (
    STAMP,
    combined,
    raw_estimates,
    samples,
    sql,
    summary,
)
from labwatch.catalog.feed_queries import FILE, feed_sql, raw_feed
from labwatch.catalog.function_queries import DATE_TEXT
from labwatch.catalog.summary_queries import on_long, sizes_sql, week_country, whole_release
from labwatch.feeds.labs import ESTIMATE_KEYS, FLEURY
from labwatch.feeds.runner import run_feed, stamp
from labwatch.functions.dates import try_date
from labwatch.functions.text import repair_encoding
from labwatch.operators.merge import upsert
from labwatch.plans.combine import ReportCity, city_report
from labwatch.plans.matrices import TABLES
from labwatch.session import scratch_dir, stored
from labwatch.sources import readers, repair, sinks, snapshots
from labwatch.sources.workbook import parse_workbooks
from labwatch.streaming import ingest

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
CUSTOMER_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer"


def customer_text(t: Tables):
    return t.customer.select(*[F.col(c).cast("string").alias(c) for c in CUSTOMER])


def written(t: Tables, df, label: str, separator: str = ",", encoding: str = "UTF-8") -> str:
    path = scratch_dir(t.spark, label)
    df.write.option("header", "true").option("sep", separator).option("encoding", encoding).option(
        "escape", '"'
    ).csv(path)
    return path


@query("S01_read_comma", CUSTOMER_SQL)
def _(t: Tables):
    path = written(t, customer_text(t), "comma")
    return readers.read_delimited(t.spark, path, CUSTOMER, glob="*.csv").drop("file_name")


@query("S02_read_text_ids", "SELECT concat('000', CAST(o_orderkey AS VARCHAR)) AS id, o_orderstatus FROM orders")
def _(t: Tables):
    rows = t.orders.select(F.concat(F.lit("000"), F.col("o_orderkey").cast("string")).alias("id"), "o_orderstatus")
    path = written(t, rows, "ids")
    return readers.read_delimited(t.spark, path, ["id", "o_orderstatus"]).drop("file_name")


@query("S03_read_semicolon_latin1", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(replace(text, chr(10), ' ')) AS key FROM documents")
def _(t: Tables):
    rows = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    path = written(t, rows, "semicolon", ";", "ISO-8859-1")
    back = readers.read_delimited(t.spark, path, ["doc_id", "text"], ";", "ISO-8859-1")
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"))


@query("S04_read_tab_latin1", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, replace(p_name, 'e', 'é') AS p_name FROM part")
def _(t: Tables):
    rows = t.part.select(F.col("p_partkey").cast("string").alias("p_partkey"), F.translate("p_name", "e", "é").alias("p_name"))
    path = written(t, rows, "tab", "\t", "ISO-8859-1")
    return readers.read_delimited(t.spark, path, ["p_partkey", "p_name"], "\t", "ISO-8859-1").drop("file_name")


@query("S04_feed_from_files", feed_sql("FLEURY"))
def _(t: Tables):
    raw = raw_feed(t, "FLEURY")
    path = scratch_dir(t.spark, "fleury")
    raw.withColumnRenamed("file_name", "delivery").write.options(
        header="true", sep=FLEURY.separator, encoding=FLEURY.encoding
    ).csv(path)
    columns = readers.read_header(t.spark, path, FLEURY.separator, FLEURY.encoding, None)
    back = readers.read_delimited(t.spark, path, columns, FLEURY.separator, FLEURY.encoding)
    return run_feed(back.drop("file_name").withColumnRenamed("delivery", "file_name"), FLEURY, as_of=STAMP)


# A delivery whose headers vary: the canonical column is absent from it.
@query("S08_header_aliases", "SELECT c_custkey, c_mktsegment AS \"Cidade\", CAST(c_nationkey AS VARCHAR) AS \"UF\" FROM customer")
def _(t: Tables):
    delivered = t.customer.select(
        "c_custkey",
        F.col("c_mktsegment").alias("Cidade (Inst Saúde)"),
        F.col("c_nationkey").cast("string").alias("UF  (Inst Saúde)"),
    )
    aliases = {"Cidade": ("Cidade (Inst Saúde)", "Cidade  (Inst Saúde)"), "UF": ("UF (Inst Saúde)", "UF  (Inst Saúde)")}
    return repair.rename_aliases(delivered, aliases)


@query("S08_header_aliases_per_file", "SELECT c_name AS id, c_mktsegment AS \"Cidade\", CAST(c_nationkey AS VARCHAR) AS \"UF\", concat('file_', c_mktsegment) AS file_name FROM customer")
def _(t: Tables):
    own = F.col("c_mktsegment") == "BUILDING"
    city = F.when(own, F.lit("Cidade")).otherwise(F.lit("Cidade (Inst Saúde)"))
    rows = t.customer.select(
        F.concat(F.lit("file_"), F.col("c_mktsegment")).alias("file_name"),
        F.create_map(
            F.lit("id"), F.col("c_name"), city, F.col("c_mktsegment"), F.lit("UF"), F.col("c_nationkey").cast("string")
        ).alias("cells"),
    )
    return repair.named_columns(rows, ["id", "Cidade", "UF"], {"Cidade": ("Cidade (Inst Saúde)",)})


@query(
    "S09_tagged_columns",
    """SELECT concat('file_', CAST(l_linenumber AS VARCHAR)) AS file_name, CAST(row_no AS BIGINT) AS row_no,
        coalesce(CAST(l_suppkey AS VARCHAR), '') AS "CT_N",
        CASE WHEN l_linenumber <> 2 THEN CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END END AS "CT_I",
        CASE WHEN l_linenumber <> 4 THEN l_linestatus END AS "Resultado"
        FROM (SELECT *, l_orderkey * 100000 + l_partkey AS row_no FROM lineitem)""",
)
def _(t: Tables):
    number = F.col("l_linenumber")
    # Per file: a tag in every cell; tags with blank cells (absent from file 2); one untagged column
    # (absent from file 4); an empty column everywhere.
    untagged = F.when(number != 4, F.col("l_linestatus"))
    flagged = F.when((number != 2) & (F.col("l_returnflag") != "A"), F.concat(F.lit("CT_I: "), "l_returnflag"))
    rows = t.lineitem.select(
        F.concat(F.lit("file_"), number.cast("string")).alias("file_name"),
        (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("row_no"),
        F.create_map(
            F.lit("Resultado"),
            F.concat(F.lit("CT_N:  "), F.col("l_suppkey").cast("string")),
            F.lit("Resultado.1"),
            flagged,
            F.lit("Resultado.2"),
            untagged,
            F.lit("Resultado.3"),
            F.lit("  "),
        ).alias("cells"),
    )
    fixed = repair.tagged_columns(rows, "Resultado")
    cell = {n: F.try_element_at("cells", F.lit(n)).alias(n) for n in ("CT_N", "CT_I", "Resultado")}
    return fixed.select("file_name", "row_no", *cell.values())


@query(
    "S10_date_formats",
    f"""SELECT o_orderkey, CASE WHEN o_custkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS date_testing FROM orders""",
)
def _(t: Tables):
    parsed = try_date("d", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-M-d")
    return t.orders.selectExpr("o_orderkey", f"{DATE_TEXT} as d").select("o_orderkey", parsed.alias("date_testing"))


@query("S11_file_names", "SELECT n_regionkey, count(*) AS n, TRUE AS named FROM nation GROUP BY 1")
def _(t: Tables):
    path = written(t, t.nation.select(F.col("n_regionkey").cast("string").alias("k"), "n_name"), "named")
    rows = readers.read_delimited(t.spark, path, ["k", "n_name"])
    return rows.groupBy(F.col("k").cast("int").alias("n_regionkey")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("file_name").rlike(r"part-.*\.csv$")).alias("named")
    )


@query("S12_files_by_extension", "SELECT n_name FROM nation")
def _(t: Tables):
    base = scratch_dir(t.spark, "mixed")
    t.nation.select("n_name").write.option("header", "true").csv(f"{base}/a")
    t.region.select("r_name").write.option("header", "true").json(f"{base}/b")
    return readers.read_delimited(t.spark, base, ["n_name"], glob="*.csv", recursive=True).drop("file_name")


@query("S13_replace_table", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables):
    path = scratch_dir(t.spark, "raw")
    sinks.replace_table(t.orders, path)
    sinks.replace_table(t.orders.filter("o_orderstatus = 'F'"), path)
    return readers.read_table(t.spark, path=path)


@query("S14_scan", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(t: Tables):
    return t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


EARLIER = "2026-01-01 08:00:00"


@query(
    "S15_upsert",
    sql(
        f"""SELECT sample_id, test_kit, CASE WHEN date_testing < DATE '2025-01-01' THEN 'pending' ELSE sex END AS sex,
        CASE WHEN date_testing < DATE '2026-01-01' THEN TIMESTAMP '{EARLIER}' ELSE TIMESTAMP '{STAMP}' END AS created_at,
        CASE WHEN date_testing < DATE '2025-01-01' THEN TIMESTAMP '{EARLIER}' ELSE TIMESTAMP '{STAMP}' END AS updated_at FROM samples""",
        "samples",
    ),
)
def _(t: Tables):
    rows = stamp(samples(t), EARLIER).select("sample_id", "test_kit", "sex", "created_at", "updated_at", "date_testing")
    old = rows.filter("date_testing < date '2026-01-01'").withColumn("sex", F.lit("pending"))
    now = F.lit(STAMP).cast("timestamp_ntz")
    new = rows.filter("date_testing >= date '2025-01-01'").withColumns({"created_at": now, "updated_at": now})
    return upsert(old.drop("date_testing"), new.drop("date_testing"), ["sample_id"])


UPSERTED = ["sample_id", "test_kit", "sex", "created_at", "updated_at"]


def _merged_samples(t: Tables) -> str:
    """The load and the merge of ``S15_upsert`` in a snapshot table; both loads read the samples made once."""
    table = scratch_dir(t.spark, "samples")
    rows = stored(stamp(samples(t), EARLIER).select(*UPSERTED, "date_testing"), "samples-made")
    old = rows.filter("date_testing < date '2026-01-01'").withColumn("sex", F.lit("pending"))
    now = F.lit(STAMP).cast("timestamp_ntz")
    new = rows.filter("date_testing >= date '2025-01-01'").withColumns({"created_at": now, "updated_at": now})
    snapshots.merge_into(t.spark, old.drop("date_testing"), table, ["sample_id"], "load 1")
    snapshots.merge_into(t.spark, new.drop("date_testing"), table, ["sample_id"], "load 2")
    return table


@query("S15_upsert_table", ORACLES["S15_upsert"])
def _(t: Tables):
    return snapshots.read_snapshot(t.spark, _merged_samples(t))


@query(
    "S15_rows_of_keys",
    f"""WITH merged AS ({ORACLES["S15_upsert"]})
        SELECT * FROM merged WHERE sample_id IN (SELECT max(sample_id) FROM merged GROUP BY test_kit)""",
)
def _(t: Tables):
    """The last sample of each kit, looked up by key: only the buckets that hold these keys are opened."""
    table = _merged_samples(t)
    wanted = snapshots.read_snapshot(t.spark, table).groupBy("test_kit").agg(F.max("sample_id").alias("sample_id"))
    return snapshots.read_snapshot(t.spark, table, wanted=wanted.select("sample_id"))


@query(
    "S16_upsert_four_keys",
    sql(
        """SELECT "SE", city_ibge_code, state_code, disease, casos_estimados,
        CASE WHEN "data_fimSE" < DATE '2026-01-01' THEN 'old' ELSE 'new' END AS created_at FROM estimates""",
        "estimates",
    ),
)
def _(t: Tables):
    rows = readers.cast_estimates(raw_estimates(t)).select(*ESTIMATE_KEYS, "casos_estimados", "data_fimSE")
    old = rows.filter("data_fimSE < date '2026-01-01'").withColumns(
        {"casos_estimados": F.when(F.col("data_fimSE") < "2025-01-01", F.col("casos_estimados")), "created_at": F.lit("old")}
    )
    new = rows.filter("data_fimSE >= date '2025-01-01'").withColumn("created_at", F.lit("new"))
    return upsert(old.drop("data_fimSE"), new.drop("data_fimSE"), ESTIMATE_KEYS)


@query("S17_audit_stamps", sql(f"SELECT sample_id, TIMESTAMP '{STAMP}' AS created_at, TIMESTAMP '{STAMP}' AS updated_at FROM samples", "samples"))
def _(t: Tables):
    return stamp(samples(t), STAMP).select("sample_id", "created_at", "updated_at")


EXPORT = ["sample_id", "lab_id", "test_kit", "age", "location", "state", "epiweek_enddate", "denv_test_result"]
EXPORT_SQL = sql(f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in EXPORT)} FROM combined", "combined")


@query("S18_tab_export", EXPORT_SQL)
def _(t: Tables):
    path = scratch_dir(t.spark, "export")
    sinks.write_delimited(combined(t).select(*EXPORT), path)
    return readers.read_delimited(t.spark, path, EXPORT, "\t").drop("file_name")


@query("S19_compressed_export", EXPORT_SQL)
def _(t: Tables):
    path = scratch_dir(t.spark, "export-gz")
    sinks.write_delimited(combined(t).select(*EXPORT), path, compression="gzip")
    return readers.read_delimited(t.spark, path, EXPORT, "\t", glob="*.csv.gz").drop("file_name")


_WEEK = ["Semanas epidemiológicas", "Positividade (%)", "Positivos", "Negativos", "Total de casos"]


@query(
    "S20_export_tables",
    on_long(f"""SELECT "Semanas epidemiológicas"::VARCHAR AS week, "Positivos"::VARCHAR AS pos, "Total de casos"::VARCHAR AS total
        FROM ({week_country("denv")})"""),
)
def _(t: Tables):
    base = scratch_dir(t.spark, "matrices")
    s = summary(t)
    names = [
        "02_DENV_line_bar_posrate_posneg_direct_week_country_h",
        "matrix_ALL_count_by_labid_testkit_pathogen_result",
    ]
    done = sinks.export_tables({n: (lambda n=n: TABLES[n].ordered(s)) for n in names}, base, public_only=True)
    back = readers.read_delimited(t.spark, done[0][1], _WEEK)
    return back.select(
        F.col(_WEEK[0]).alias("week"), F.col("Positivos").alias("pos"), F.col("`Total de casos`").alias("total")
    )


def read_back(spark, done: list[tuple[str, str, int]]):
    """``name, rows`` of exported tables, from their files."""
    parts = [
        spark.read.option("header", "true").csv(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, path, _ in done
    ]
    return reduce(DataFrame.unionByName, parts)


@query("S20_export_all_tables", sizes_sql())
def _(t: Tables):
    """Every exported summary, written and read again: its name and number of rows."""
    done = sinks.export_tables(whole_release(t), scratch_dir(t.spark, "all-matrices"))
    return read_back(t.spark, done)


@query(
    "S23_publish_all_tables",
    f"""WITH sizes AS ({sizes_sql()}) SELECT 'current' AS place, * FROM sizes
        UNION ALL SELECT 'public_current', * FROM sizes WHERE regexp_matches(name, '^[0-9]')""",
)
def _(t: Tables):
    """A whole release: what stands in the two current folders."""
    base = scratch_dir(t.spark, "publish-all")
    done = sinks.publish(t.spark, whole_release(t), f"{base}/in", f"{base}/public", "2026-12-31_10h00_Arbo_SE51.2026_V1")
    places = [
        read_back(t.spark, done[place]).select(F.lit(place).alias("place"), "name", "rows")
        for place in ("current", "public_current")
    ]
    return places[0].unionByName(places[1])


CITY = ReportCity(code=3300071, name="Building Nation 7", state_code="N7")
REPORT = ["date_testing", "test_kit", "age_group", "location", "state_code", "location_ibge_code", "pathogen", "result", "count"]


@query(
    "S21_report_export",
    sql(
        f"""SELECT pathogen, result, CAST(count(*) AS BIGINT) AS tests FROM (SELECT {", ".join(f"{c} AS {p}" for p, c in vocab.RESULT_OF.items())}
        FROM combined WHERE location_ibge_code = {CITY.code}) UNPIVOT (result FOR pathogen IN ({", ".join(vocab.PATHOGENS)}))
        WHERE result <> 'NT' GROUP BY 1, 2""",
        "combined",
    ),
)
def _(t: Tables):
    path = scratch_dir(t.spark, "report")
    sinks.write_delimited(city_report(combined(t), CITY), path)
    back = readers.read_delimited(t.spark, path, REPORT, "\t")
    return back.groupBy("pathogen", "result").agg(F.sum(F.col("count").cast("long")).alias("tests"))


# Release folders of the past: one per order day, the latest one of the current week.
FOLDER = "concat(cast(cast(o_orderdate as date) as string), '_10h00_Arbo_SE05.1998_V', cast(o_custkey % 7 as string))"


@query(
    "S22_release_name",
    f"""SELECT CAST(regexp_extract(last, 'V([0-9]+)', 1) AS INTEGER) + 1 AS version,
        concat('1998-02-10_09h30_Arbo_SE05.1998_V', CAST(regexp_extract(last, 'V([0-9]+)', 1) AS INTEGER) + 1) AS release
        FROM (SELECT max({FOLDER}) AS last FROM orders)""",
)
def _(t: Tables):
    releases = t.orders.selectExpr(f"{FOLDER} as release")
    return sinks.release_name(releases, "1998-02-10 09:30:00")


@query(
    "S23_publish",
    on_long(f"""SELECT "Semanas epidemiológicas"::VARCHAR AS week, "Negativos"::VARCHAR AS neg FROM ({week_country("denv")})"""),
)
def _(t: Tables):
    base = scratch_dir(t.spark, "publish")
    s = summary(t)
    names = [
        "02_DENV_line_bar_posrate_posneg_direct_week_country_h",
        "matrix_ALL_count_by_labid_testkit_pathogen_result",
    ]
    tables = {n: (lambda n=n: TABLES[n].ordered(s)) for n in names}
    done = sinks.publish(t.spark, tables, f"{base}/in", f"{base}/public", "2026-12-31_10h00_Arbo_SE51.2026_V1")
    # Only the digit-named table reaches the public side.
    (_, path, _), = done["public_current"]
    back = readers.read_delimited(t.spark, path, _WEEK)
    return back.select(F.col(_WEEK[0]).alias("week"), F.col("Negativos").alias("neg"))


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A minimal workbook of text cells; empty cells are left out."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = (
                    f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'
                    for c, v in enumerate(row)
                    if v is not None
                )
                body += f'<row r="{r}">{"".join(cells)}</row>'
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def customer_workbooks(t: Tables, keys: int = 10_000):
    """Workbooks of a nation's customers, each of ``keys`` adjacent keys: every other customer in a sheet of its own.

    Sheets have a blank line first and a footer; a nation's first workbook has a note as well. So files grow in number
    with the table, not in size.
    """
    customers = t.customer.select("*", F.floor(F.col("c_custkey") / keys).alias("block"))
    nation = Window.partitionBy("nation").orderBy("range")
    # How many customers a nation has in earlier workbooks tells which sheet goes on.
    files = customers.groupBy(F.col("c_nationkey").alias("nation"), F.col("block").alias("range")).count()
    files = files.select(
        "nation",
        "range",
        F.coalesce(F.sum("count").over(nation.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
    )
    placed = customers.join(
        files, F.col("c_nationkey").eqNullSafe(F.col("nation")) & F.col("block").eqNullSafe(F.col("range"))
    ).drop("nation", "range")

    def build(pdf):
        head = ["id", "name", "name", "segment"]
        rows = [[r.c_custkey, r.c_name, r.c_name[::-1], r.c_mktsegment] for r in pdf.sort_values("c_custkey").itertuples()]
        nation, block, earlier = (pdf[c].iloc[0] for c in ("c_nationkey", "block", "earlier"))
        parts = {f"part{n}": [[None, "x"], head, *rows[(n + earlier) % 2 :: 2], ["total"]] for n in (0, 1)}
        if not earlier:
            parts["note"] = [["text"], ["a"], ["b"]]
        path = f"nation-{nation}-{block}.xlsx" if earlier else f"nation-{nation}.xlsx"
        return pd.DataFrame({"path": [path], "noted": [not earlier], "content": [workbook_bytes(parts)]})

    return placed.groupBy("c_nationkey", "block").applyInPandas(build, "path string, noted boolean, content binary")


@query("S05_workbook_sheet", "SELECT concat('nation-', c_nationkey, '.xlsx') AS file, unnest(['a', 'b']) AS text FROM (SELECT DISTINCT c_nationkey FROM customer)")
def _(t: Tables):
    noted = customer_workbooks(t).filter("noted")
    return parse_workbooks(noted, "note").select(F.col("file_name").alias("file"), F.col("cells.text").alias("text"))


@query(
    "S05_workbook_sheet_of_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM
        (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer) WHERE n % 2 = 0""",
)
def _(t: Tables):
    rows = parse_workbooks(customer_workbooks(t), "part1").filter("NOT is_last")
    return rows.select("cells.id", "cells.name", "cells.segment")


@query("S06_all_sheets", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def _(t: Tables):
    rows = parse_workbooks(customer_workbooks(t), all_sheets=True).filter("sheet <> 'note' AND NOT is_last")
    return rows.select("cells.id", "cells.name", "cells.segment")


@query(
    "S07_blank_line_and_repeated_headers",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, reverse(c_name) AS second FROM
        (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer) WHERE n % 2 = 1""",
)
def _(t: Tables):
    rows = parse_workbooks(customer_workbooks(t)).filter("NOT is_last")
    return rows.select("cells.id", F.col("cells")["name.1"].alias("second"))


@query("S24_used_files", f"SELECT DISTINCT {FILE} AS file_name FROM lineitem")
def _(t: Tables):
    return readers.used_files(t.lineitem.selectExpr(f"{FILE} as file_name"))


@query("S25_row_counts", "SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1")
def _(t: Tables):
    path = scratch_dir(t.spark, "counted")
    rows = sinks.replace_table(t.orders, path)
    back = readers.read_table(t.spark, path=path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return back.withColumn("written", F.lit(rows).cast("long"))


@query(
    "S26_packed_rows",
    "SELECT c_custkey, c_name AS name, concat(c_mktsegment, ', no. \"', c_nationkey, '\"') AS place, c_mktsegment AS segment FROM customer",
)
def _(t: Tables):
    quoted = F.concat(F.lit('"'), "c_mktsegment", F.lit(', no. ""'), F.col("c_nationkey").cast("string"), F.lit('"""'))
    packed = t.customer.select("c_custkey", F.concat_ws(",", "c_name", quoted, "c_mktsegment").alias("line"))
    row = readers.parse_packed("line", ["name", "place", "segment"])
    return packed.select("c_custkey", F.inline(F.array(row)))


@query("S27_encoding_repair", "SELECT doc_id, md5(text) AS key FROM documents")
def _(t: Tables):
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.select("doc_id", F.md5(repair_encoding(broken).cast("binary")).alias("key"))


@query("S28_whole_table", "SELECT * FROM supplier")
def _(t: Tables):
    return readers.read_table(t.spark, path=f"{t.folder}/supplier.parquet")


# --- streams ---------------------------------------------------------------------------------


def event_batches(t: Tables, files: int = 4) -> str:
    """The events as several delivered files, split by time."""
    path = scratch_dir(t.spark, "events")
    t.events.repartitionByRange(files, "ts").write.parquet(path)
    return path


@query("X01_new_files", "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t: Tables):
    base = scratch_dir(t.spark, "stream")
    stream = ingest.stream_files(t.spark, event_batches(t), t.events.schema, "parquet", "*.parquet", files_per_batch=1)
    for _ in range(2):
        # The second run finds no unseen file.
        query_ = (
            stream.writeStream.format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query_.awaitTermination()
    out = t.spark.read.parquet(f"{base}/out")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


EVENT = ["event_id", "user_id", "event_type", "value"]


@query("X03_stream_upsert", f"SELECT {', '.join(EVENT)} FROM events")
def _(t: Tables):
    base = scratch_dir(t.spark, "upsert")
    stream = ingest.stream_files(t.spark, event_batches(t), t.events.schema, "parquet", files_per_batch=2)
    ingest.run_available(stream.select(*EVENT), ingest.upsert_step(f"{base}/table", ["event_id"], "events"), f"{base}/checkpoint")
    return snapshots.read_snapshot(t.spark, f"{base}/table")


@query("X04_late_files", f"SELECT event_id, user_id, upper(event_type) AS event_type, 'first' AS created_at FROM events")
def _(t: Tables):
    base = scratch_dir(t.spark, "late")
    columns = ["event_id", "user_id", "event_type"]
    for run, change in (("first", F.col("event_type")), ("second", F.upper("event_type"))):
        # The second delivery repeats every event with a correction.
        path = scratch_dir(t.spark, f"late-{run}")
        t.events.select("event_id", "user_id", change.alias("event_type"), F.lit(run).alias("created_at")).write.parquet(path)
        schema = t.spark.read.parquet(path).schema
        stream = ingest.stream_files(t.spark, path, schema, "parquet").drop("file_name")
        step = ingest.upsert_step(f"{base}/table", ["event_id"], run)
        ingest.run_available(stream, step, f"{base}/checkpoint-{run}")
    return snapshots.read_snapshot(t.spark, f"{base}/table").select(*columns, "created_at")


LATE_DAYS = 20
DELIVERED = ["event_id", "event_type", "value", "day"]


@query(
    "X04_rows_kept_aside",
    f"""WITH delivered AS (SELECT event_id, event_type, value, CAST(ts AS DATE) AS day, CAST(event_id % 3 AS INTEGER) AS batch FROM events),
        marked AS (SELECT *, CASE WHEN value < 5 THEN 'small' WHEN event_type IS NULL OR event_type = 'error' THEN 'type' END AS bad FROM delivered
            WHERE batch = 0 OR day < (SELECT max(CAST(ts AS DATE)) - 10 FROM events) OR event_id % 2 = 0),
        first AS (SELECT max(day) AS newest FROM marked WHERE batch = 0 AND bad IS NULL),
        second AS (SELECT greatest(newest, (SELECT max(m.day) FROM marked m WHERE m.batch = 1 AND m.bad IS NULL AND m.day >= newest - {LATE_DAYS})) AS newest FROM first),
        told AS (SELECT batch, coalesce(bad, CASE WHEN batch = 1 AND day < (SELECT newest FROM first) - {LATE_DAYS} THEN 'late'
            WHEN batch = 2 AND day < (SELECT newest FROM second) - {LATE_DAYS} THEN 'late' ELSE 'merged' END) AS reason FROM marked)
        SELECT batch, reason, count(*) AS n FROM told GROUP BY 1, 2""",
)
def _(t: Tables):
    """Three deliveries: rows that fail a condition or come late are kept with reason and batch, all others merged."""
    base = scratch_dir(t.spark, "aside")
    table, kept = f"{base}/table", f"{base}/aside"
    last = t.events.agg(F.max(F.col("ts").cast("date"))).scalar()
    rows = t.events.select("event_id", "event_type", "value", F.col("ts").cast("date").alias("day"))
    rows = rows.filter((F.col("event_id") % 3 == 0) | (F.col("day") < F.date_sub(last, 10)) | (F.col("event_id") % 2 == 0))
    bad = {"small": F.col("value") < 5, "type": F.col("event_type").isNull() | (F.col("event_type") == "error")}
    step = ingest.sorted_step(table, ["event_id"], "events", kept, lambda _: bad, "day", LATE_DAYS)
    for number in range(3):
        step(rows.filter(F.col("event_id") % 3 == number), number)
    merged = snapshots.read_snapshot(t.spark, table).select(
        (F.col("event_id") % 3).cast("int").alias("batch"), F.lit("merged").alias("reason")
    )
    held = ingest.read_aside(t.spark, kept).select("batch", "reason")
    return merged.unionByName(held).groupBy("batch", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("X03_load_then_two_streams", f"SELECT {', '.join(EVENT)} FROM events")
def _(t: Tables):
    """A first load, then two streams with checkpoints of their own, all into one table; then compaction."""
    table = scratch_dir(t.spark, "loaded")
    stale = t.events.select(*EVENT).filter("event_id % 3 = 0").withColumn("value", F.lit(-1.0))
    snapshots.merge_into(t.spark, stale, table, ["event_id"], "load 20260107")
    for name, part in (("early", "event_id % 2 = 0"), ("late", "event_id % 2 = 1")):
        path = scratch_dir(t.spark, f"loaded-{name}")
        t.events.select(*EVENT).filter(part).repartition(2, "event_id").write.parquet(path)
        stream = ingest.stream_files(t.spark, path, t.events.select(*EVENT).schema, "parquet", files_per_batch=1)
        ingest.run_available(stream.select(*EVENT), ingest.upsert_step(table, ["event_id"], name), f"{path}-checkpoint")
    snapshots.compact_snapshot(t.spark, table)
    return snapshots.read_snapshot(t.spark, table)


@query("X03_two_writers_at_once", f"SELECT {', '.join(EVENT)} FROM events")
def _(t: Tables):
    """Two streams that merge into one table at the same time: each commits under a version of its own."""
    table = scratch_dir(t.spark, "contended")

    def deliver(name: str, part: str):
        path = scratch_dir(t.spark, f"contended-{name}")
        t.events.select(*EVENT).filter(part).repartition(2, "event_id").write.parquet(path)
        stream = ingest.stream_files(t.spark, path, t.events.select(*EVENT).schema, "parquet", files_per_batch=1)
        ingest.run_available(stream.select(*EVENT), ingest.upsert_step(table, ["event_id"], name), f"{path}-checkpoint")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(deliver, ("even", "odd"), ("event_id % 2 = 0", "event_id % 2 = 1")))
    return snapshots.read_snapshot(t.spark, table)


@query("X02_consumed_files", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    """Delivered files move to an archive once a later run has committed; rows come from what the stream read."""
    base, inbox, archive = (scratch_dir(t.spark, f"consumed-{n}") for n in ("table", "inbox", "archive"))
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        t.events.select(*EVENT).filter(part).write.mode("append").parquet(inbox)
        stream = ingest.stream_files(t.spark, inbox, t.events.select(*EVENT).schema, "parquet", "*.parquet", archive)
        step = ingest.upsert_step(base, ["event_id"], "consumed")
        ingest.run_available(stream.select(*EVENT), step, f"{base}-checkpoint")
    return snapshots.read_snapshot(t.spark, base).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("X05_refresh", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(t: Tables):
    base = scratch_dir(t.spark, "refresh")

    def rebuild(spark, table):
        rows = snapshots.read_snapshot(spark, table)
        totals = rows.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
        )
        sinks.replace_table(totals, f"{base}/totals")

    stream = ingest.stream_files(t.spark, event_batches(t), t.events.schema, "parquet", files_per_batch=2)
    step = ingest.upsert_step(f"{base}/table", ["event_id"], "events", then=rebuild)
    ingest.run_available(stream.select(*EVENT), step, f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/totals")


@query(
    "X05_refresh_by_changes",
    """SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n FROM events GROUP BY ALL""",
)
def _(t: Tables):
    """Counts kept up by what each merge changed: a third of the events arrive with another type and month first."""
    base = scratch_dir(t.spark, "changes")
    table, counts = f"{base}/events", f"{base}/counts"
    by = ["event_type", "month"]
    rows = t.events.select("event_id", "event_type", "ts")
    month = lambda r: r.withColumn("month", F.trunc("ts", "month"))
    stale = rows.filter("event_id % 3 = 0").withColumns(
        {"event_type": F.lit("unknown"), "ts": F.col("ts") - F.expr("interval 40 days")}
    )
    for n, batch in enumerate([stale, rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1")]):
        snapshots.merge_into(t.spark, batch, table, ["event_id"], "events", n)
        snapshots.refresh_counts(t.spark, table, counts, by, month)
    return snapshots.read_counts(t.spark, counts)


WEEKLY = """SELECT CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS week_start,
    CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) + 6 AS week_end, event_type, count(*) AS n FROM events GROUP BY ALL"""


@query("X06_weekly_counts_stream", WEEKLY)
def _(t: Tables):
    base = scratch_dir(t.spark, "weekly")
    stream = ingest.stream_files(t.spark, event_batches(t), t.events.schema, "parquet", files_per_batch=1)
    counts = ingest.weekly_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
    step = ingest.upsert_step(f"{base}/table", ["week_start", "event_type"], "weekly")
    ingest.run_available(counts, step, f"{base}/checkpoint", mode="update")
    return snapshots.read_snapshot(t.spark, f"{base}/table")


def in_order(rows: DataFrame, by: str) -> DataFrame:
    """Rows sorted over partitions that follow each other: no task sorts or writes them all."""
    return rows.repartitionByRange(by).sortWithinPartitions(by)


@query(
    "X06_weekly_counts_watermark",
    f"""WITH weekly AS ({WEEKLY}) SELECT * FROM weekly WHERE week_end < (SELECT CAST(max(ts) AS DATE) - 2 FROM events)""",
)
def _(t: Tables):
    """Append mode: a week comes out once, when the watermark two days behind the latest event has passed it."""
    base = scratch_dir(t.spark, "watermark")
    path = scratch_dir(t.spark, "watermark-in")
    in_order(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts").write.parquet(path)
    stream = ingest.stream_files(t.spark, path, t.spark.read.parquet(path).schema, "parquet").drop("file_name")
    counts = ingest.weekly_counts(stream, "ts", ["event_type"], late="2 days")
    query_ = (
        counts.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return t.spark.read.parquet(f"{base}/out")


@query("X06_weekly_counts_batch", WEEKLY)
def _(t: Tables):
    return ingest.weekly_counts(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
