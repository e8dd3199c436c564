"""Result and age text -> codes."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.text import col


def classify(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules, first match wins; values may be columns or plain values."""
    def value(v):
        return v if isinstance(v, Column) else F.lit(v)

    out = None
    for condition, outcome in rules:
        out = F.when(condition, value(outcome)) if out is None else out.when(condition, value(outcome))
    return value(default) if out is None else out.otherwise(value(default))


def lookup(c: Column | str, table: dict[str, object], default: object = None) -> Column:
    """Literal dictionary lookup."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, col(c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def comma_number(c: Column | str) -> Column:
    """Decimal text with a comma; NULL where it is no number (as with a second separator)."""
    return F.replace(col(c), F.lit(","), F.lit(".")).try_cast("double")


def cutoff_result(c: Column | str, cutoff: float = 0.80) -> Column:
    """Index text below the cutoff is negative, else positive; no number is unrecognised.

    Text that starts with a separator loses that sign and counts in hundredths (``,5`` is 0.05).
    """
    c = col(c)
    number = F.when(c.rlike("^[0-9]"), comma_number(c)).otherwise(comma_number(F.substring(c, 2, 2**31 - 1)) / 100)
    code = F.coalesce((number >= cutoff).cast("int"), F.lit(vocab.UNRECOGNISED))
    return F.when(c.rlike("^[0-9,.]"), code)


def prefix_pattern(patterns: Iterable[str]) -> str:
    """LIKE patterns that are literal texts, or literal prefixes ending in ``%``, as one regex."""
    parts = [re.escape(p[:-1]) if p.endswith("%") else re.escape(p) + "$" for p in patterns]
    return f"^(?:{'|'.join(parts)})"


def band_result(number: Column, low: float, high: float, between: int | None, other: int | None = None) -> Column:
    """Below ``low`` negative, above ``high`` positive, ``between`` inside the closed band."""
    inside = F.lit(between).cast("int")
    return (
        F.when(number < low, vocab.NEGATIVE)
        .when(number > high, vocab.POSITIVE)
        .when(number.between(low, high), inside)
        .otherwise(F.lit(other).cast("int"))
    )


def age_days_years(c: Column | str) -> Column:
    """``..D`` is 0, ``nA..`` is n years, bare digits are years; anything else is NULL."""
    c = col(c)
    return (
        F.when(c.rlike(".+D"), 0)
        .when(c.rlike(r"^\d+A"), F.regexp_extract(c, r"(\d+)", 1).try_cast("int"))
        .when(c.rlike(r"\d+"), c.try_cast("int"))
    )


def age_units(c: Column | str) -> Column:
    """Bare digits and ``nA..`` are years; ``nM..`` and ``nD..`` are 0."""
    c = col(c)
    return (
        F.when(c.rlike("^[0-9]*$"), c.try_cast("int"))
        .when(c.rlike("^[0-9]*A"), F.split_part(c, F.lit("A"), F.lit(1)).try_cast("int"))
        .when(c.rlike("^[0-9]*[MD]"), 0)
    )


def plausible_age(c: Column | str, low: int | None = 0, high: int = 120) -> Column:
    c = col(c)
    bad = c > high
    if low is not None:
        bad = bad | (c < low)
    return F.when(bad, F.lit(None)).otherwise(c)
