"""File readers. Everything is read as text; stage 01 casts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwatch.feeds.labs import ESTIMATE_COLUMNS
from labwatch.feeds.spec import LabSpec
from labwatch.functions.text import col
from labwatch.schema import strings
from labwatch.sources.repair import named_columns, tagged_columns
from labwatch.sources.workbook import read_workbooks


def text_options(separator: str = ",", encoding: str = "UTF-8", glob: str | None = None) -> dict[str, str]:
    options = {"header": "true", "sep": separator, "encoding": encoding, "escape": '"', "enforceSchema": "false"}
    if glob:
        options["pathGlobFilter"] = glob
    return options


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    separator: str = ",",
    encoding: str = "UTF-8",
    glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """All matching files as string columns in the declared order, with their ``file_name``.

    Leading zeros of ids survive because nothing is inferred.
    """
    reader = spark.read.schema(strings(*columns)).options(**text_options(separator, encoding, glob))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("file_name"))


def read_header(spark: SparkSession, path: str, separator: str, encoding: str, glob: str | None) -> list[str]:
    """Column names of the files, without scanning their rows."""
    return spark.read.options(**text_options(separator, encoding, glob)).csv(path).columns


def headers_by_file(
    spark: SparkSession, path: str, separator: str, encoding: str, glob: str | None
) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for every different header among the files: first lines only reach the driver."""
    reader = spark.read.format("text").option("encoding", encoding)
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    heads = first.where("at = 0").groupBy("file").agg(F.first("value").alias("line"))
    found = heads.groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("line").collect()
    return [(read_header(spark, r["files"][0], separator, encoding, None), r["files"]) for r in found]


def workbook_feed(rows: DataFrame, spec: LabSpec) -> DataFrame:
    """Parsed workbook rows as the laboratory's raw columns."""
    if spec.drop_footer:
        rows = rows.filter(~F.col("is_last"))
    if spec.tagged_prefix:
        rows = tagged_columns(rows, spec.tagged_prefix)
    return named_columns(rows, spec.raw_headers(), spec.aliases)


def read_feed(spark: SparkSession, path: str, spec: LabSpec) -> DataFrame:
    """Raw rows of one laboratory from all its files under ``path``; delimited files may differ in their headers."""
    if spec.format == "workbook":
        return workbook_feed(read_workbooks(spark, path, spec.sheet, spec.all_sheets, spec.glob), spec)
    wanted = spec.raw_headers()
    parts = []
    for present, files in headers_by_file(spark, path, spec.separator, spec.encoding, spec.glob):
        missing = [c for c in wanted if c not in present]
        if missing:
            raise ValueError(f"{spec.lab_id}: columns missing in {files[0]}: {missing}")
        raw = read_delimited(spark, files, present, spec.separator, spec.encoding)
        parts.append(raw.select(*[F.col(f"`{c}`") for c in wanted], "file_name"))
    if not parts:
        raise ValueError(f"{spec.lab_id}: no files in {path}")
    return reduce(DataFrame.unionByName, parts)


def read_estimates(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """National case estimates, typed."""
    header = read_header(spark, path, ",", "UTF-8", glob)
    return cast_estimates(read_delimited(spark, path, header, glob=glob))


def cast_estimates(raw: DataFrame) -> DataFrame:
    def value(source: str, dtype: str) -> Column:
        if dtype == "date":
            return F.try_to_date(F.col(source), "yyyy-M-d")
        return F.col(source).try_cast(dtype)

    return raw.select(*[value(s, t).alias(name) for name, (s, t) in ESTIMATE_COLUMNS.items()])


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small lookup CSV; spaces around header names and values are dropped."""
    text = (
        spark.read.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "true")
        .option("ignoreTrailingWhiteSpace", "true")
        .csv(path)
    )
    text = text.toDF(*[c.strip() for c in text.columns])
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, name: str | None = None, path: str | None = None, **jdbc) -> DataFrame:
    """A whole table: catalog name, parquet path, or a database the caller names (``url``, ``dbtable``)."""
    if name:
        return spark.table(name)
    if path:
        return spark.read.parquet(path)
    return spark.read.format("jdbc").options(**jdbc).load()


def parse_packed(c: Column | str, columns: list[str]) -> Column:
    """One text column holding a whole CSV line with quoted commas -> struct of strings."""
    ddl = ", ".join(f"`{name}` string" for name in columns)
    return F.from_csv(col(c), F.lit(ddl), {"sep": ",", "quote": '"', "escape": '"'})


def used_files(raw: DataFrame) -> DataFrame:
    """Names of the files a raw table was loaded from."""
    return raw.select("file_name").distinct()
