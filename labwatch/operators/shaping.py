"""Projections, filters, one-hot encoding and unpivot; all narrow."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.text import col


def cast_columns(df: DataFrame, columns: Mapping[str, tuple[Column | str, str]], strict: bool = False) -> DataFrame:
    """``{name: (source, type)}`` in one select. ``strict`` raises on a value that does not cast."""
    out = []
    for name, (source, dtype) in columns.items():
        value = col(source)
        out.append((value.cast(dtype) if strict else value.try_cast(dtype)).alias(name))
    return df.select(*out)


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns that many later rules and filters read.

    A plain projection would be copied into every filter above it and evaluated again for each
    mention; behind a one-row generator each expression runs once per row.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    fresh = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(fresh)))


def rejected_rows(df: DataFrame, columns: Mapping[str, tuple[Column | str, str]]) -> DataFrame:
    """Rows with a value that does not cast, with the names of the failing columns."""
    failing = F.array_compact(
        F.array(
            *[
                F.when(col(source).isNotNull() & col(source).try_cast(dtype).isNull(), F.lit(name))
                for name, (source, dtype) in columns.items()
            ]
        )
    )
    return df.withColumn("rejected_columns", failing).filter(F.size("rejected_columns") > 0)


def normalise_id(c: Column | str) -> Column:
    """Numeric text -> canonical integer text."""
    return col(c).try_cast("bigint").cast("string")


def without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def none_of(c: Column | str, values: Iterable) -> Column:
    """``NOT IN``: a NULL value is not kept."""
    return ~col(c).isin(*values)


def any_present(*cols: Column | str) -> Column:
    return F.coalesce(*[col(c) for c in cols]).isNotNull()


def or_missing(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(vocab.MISSING))


def completed_weeks(end: Column | str, as_of: str, start: str = vocab.SUMMARY_START) -> Column:
    end = col(end)
    return (end < F.lit(as_of).cast("date")) & (end >= F.lit(start).cast("date"))


def one_hot(
    code: Column | str,
    result: Column | str,
    codes: Mapping[str, Iterable[str]],
    default: int = vocab.NOT_TESTED,
) -> list[Column]:
    """One result column per pathogen: the result where the code belongs to it, else ``default``.

    A NULL result of a matching code stays NULL.
    """
    code, result = col(code), col(result)
    out = []
    for pathogen, name in vocab.RESULT_OF.items():
        own = list(codes.get(pathogen, ()))
        value = F.when(code.isin(*own), result.cast("int")).otherwise(default) if own else F.lit(default)
        out.append(value.cast("int").alias(name))
    return out


def result_text(c: Column | str) -> Column:
    """Code of a sample -> Pos / Neg / NT; any other code is NULL."""
    c = col(c)
    out = None
    for code, text in vocab.RESULT_TEXT.items():
        out = F.when(c == code, text) if out is None else out.when(c == code, text)
    return out


def tested(c: Column | str) -> Column:
    return col(c).isin("Pos", "Neg")


def unpivot_results(df: DataFrame, ids: list[str], columns: Mapping[str, str] | None = None) -> DataFrame:
    """Seven result columns -> (pathogen, result) rows, in one narrow expand."""
    columns = columns or vocab.RESULT_OF
    renamed = df.select(*ids, *[F.col(c).alias(p) for p, c in columns.items()])
    return renamed.unpivot(ids, list(columns), "pathogen", "result")
