"""Spreadsheet workbooks (zip of XML): one task per file, rows streamed out."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

SCHEMA = "file_name string, sheet string, row_no long, is_last boolean, cells map<string,string>"
# Built-in date number formats, and the day serial numbers count from.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
EPOCH = dt.datetime(1899, 12, 30)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter() if _local(t.tag) == "t")


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(e.get("numFmtId"))
        for e in root.iter()
        if _local(e.tag) == "numFmt" and re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", e.get("formatCode", "")).lower())
    }
    for group in root.iter():
        if _local(group.tag) == "cellXfs":
            return {i for i, x in enumerate(group) if int(x.get("numFmtId", 0)) in DATE_FORMATS | custom}
    return set()


def _cell_text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return _texts(cell) or None
    value = next((e.text for e in cell if _local(e.tag) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)] or None
    if kind in (None, "n") and int(cell.get("s", 0)) in dates:
        return (EPOCH + dt.timedelta(days=float(value))).strftime("%Y-%m-%d %H:%M:%S")
    if kind in (None, "n") and re.fullmatch(r"-?\d+\.0+", value):
        return value.split(".")[0]
    return value


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    targets = {
        e.get("Id"): e.get("Target")
        for e in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    out = []
    for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(e.tag) == "sheet":
            rid = next(v for k, v in e.attrib.items() if _local(k) == "id")
            target = targets[rid].lstrip("/")
            out.append((e.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return out


def _rows(book: zipfile.ZipFile, path: str, shared: list[str], dates: set[int]) -> Iterator[list[str | None]]:
    with book.open(path) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) == "row":
                row: list[str | None] = []
                for cell in element:
                    at = _column(cell.get("r")) if cell.get("r") else len(row)
                    row.extend([None] * (at + 1 - len(row)))
                    row[at] = _cell_text(cell, shared, dates)
                element.clear()
                yield row


def unique_headers(row: list[str | None]) -> list[str | None]:
    """Repeated headers get ``.1``, ``.2`` ...; blank ones carry no data column."""
    seen: dict[str, int] = {}
    out: list[str | None] = []
    for header in row:
        if header is None or not header.strip():
            out.append(None)
            continue
        repeat = seen.get(header, 0)
        seen[header] = repeat + 1
        out.append(f"{header}.{repeat}" if repeat else header)
    return out


def workbook_rows(content: bytes, sheet: str | None, all_sheets: bool) -> Iterator[tuple]:
    """(sheet, row number, is last row, cells); a blank first line does not count as the header."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
        shared = [_texts(e) for e in root if _local(e.tag) == "si"]
    dates = _date_styles(book)
    sheets = _sheets(book)
    if sheet is not None:
        sheets = [s for s in sheets if s[0] == sheet]
        if not sheets:
            raise ValueError(f"workbook has no sheet {sheet}")
    elif not all_sheets:
        sheets = sheets[:1]
    for name, path in sheets:
        headers, held, number = None, None, 0
        for row in _rows(book, path, shared, dates):
            if headers is None:
                if row and row[0] is not None and row[0].strip():
                    headers = unique_headers(row)
                continue
            if not any(v is not None for v in row):
                continue
            if held is not None:
                yield (name, held[0], False, held[1])
            cells = {h: (row[i] if i < len(row) else None) for i, h in enumerate(headers) if h is not None}
            held = (number, cells)
            number += 1
        if held is not None:
            yield (name, held[0], True, held[1])


BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def read_workbooks(
    spark: SparkSession,
    path: str,
    sheet: str | None = None,
    all_sheets: bool | None = None,
    glob: str = "*.xlsx",
) -> DataFrame:
    """Rows of every matching workbook as ``header -> text`` maps.

    ``sheet`` picks one sheet by name; without it the first sheet, or every sheet with ``all_sheets``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return parse_workbooks(files, sheet, all_sheets)


def parse_workbooks(files: DataFrame, sheet: str | None = None, all_sheets: bool | None = None) -> DataFrame:
    """Rows of workbooks given as ``path, content``, one file at a time."""
    every = bool(all_sheets)

    def parse(files: Iterator[Row]) -> Iterator[tuple]:
        for name, content in files:
            for row in workbook_rows(content, sheet, every):
                yield (name, *row)

    # Python rows instead of Arrow batches: a batch would hold as many whole workbooks as it has rows.
    rows = files.select("path", "content").rdd.mapPartitions(parse)
    return files.sparkSession.createDataFrame(rows, SCHEMA)
