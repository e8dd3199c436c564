"""Text functions on columns; all of them run inside whole-stage codegen."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch import vocab

# Letters without a decomposition, and ligatures.
STROKED = {"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i"}
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=2)
def _accent_pairs(upper_only: bool = False) -> tuple[str, str]:
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", letter) if not unicodedata.combining(x))
        if base != letter and len(base) == 1:
            source.append(letter)
            target.append(base)
    for letter, base in STROKED.items():
        source.append(letter)
        target.append(base)
    kept = [i for i, x in enumerate(source) if not upper_only or x == x.upper()]
    return "".join(source[i] for i in kept), "".join(target[i] for i in kept)


def strip_accents(c: Column | str) -> Column:
    out = F.translate(col(c), *_accent_pairs())
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return out


def plain_upper(c: Column | str) -> Column:
    """Upper case without accents. Upper-casing first leaves half of the letters to replace.

    A text with as many bytes as characters has none; it skips the replacing.
    """
    c = col(c)
    out = F.translate(F.upper(c), *_accent_pairs(True))
    for ligature, letters in LIGATURES.items():
        if ligature == ligature.upper():
            out = F.replace(out, F.lit(ligature), F.lit(letters))
    return F.when(F.octet_length(c) == F.char_length(c), F.upper(c)).otherwise(out)


def normalize_text(c: Column | str) -> Column:
    """Unaccented, upper case, outer spaces off, then outer backslashes and ``t`` off."""
    return F.btrim(F.btrim(plain_upper(c), F.lit(" ")), F.lit("\\t"))


def drop_punctuation(c: Column | str) -> Column:
    """Upper case without accents; every sign that is neither letter, digit nor space is deleted."""
    return F.regexp_replace(plain_upper(c), r"(?U)[^\w\s]", "")


def place_key(c: Column | str) -> Column:
    """Upper case ASCII place name: hyphens become spaces, other signs are deleted."""
    return F.regexp_replace(F.replace(plain_upper(c), F.lit("-"), F.lit(" ")), "[^A-Z0-9 ]", "")


def replace_first(c: Column | str, text: str, by: str) -> Column:
    """Replace only the first occurrence of a literal ``text``."""
    c = col(c)
    at = F.instr(c, text)
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.lit(by), F.substring(c, at + len(text), F.length(c)))).otherwise(c)


def first_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def sample_key(*cols: Column | str, sep: str = "") -> Column:
    """md5 over the parts, NULL parts skipped."""
    return F.md5(F.concat_ws(sep, *[col(c).cast("string") for c in cols]).cast("binary"))


def two_digits(c: Column | str) -> Column:
    return F.lpad(col(c).cast("string"), 2, "0")


def label(*parts: Column | str) -> Column:
    """Concatenation that skips NULL parts; plain strings are literals."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def normalize_sex(c: Column | str, unknown: str | None = None) -> Column:
    """F or M by the first letter."""
    first = F.upper(F.substring(col(c), 1, 1))
    return F.when(first.isin("F", "M"), first).otherwise(F.lit(unknown).cast("string"))


def plain_name(name: str) -> str:
    """Python twin of ``drop_punctuation`` for names in ``vocab``."""
    bare = unicodedata.normalize("NFD", name)
    return "".join(x for x in bare if not unicodedata.combining(x)).upper()


@lru_cache(maxsize=1)
def state_names() -> tuple[str, ...]:
    return tuple(plain_name(name) for name, _, _ in vocab.STATES.values())


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def state_name(c: Column | str, unknown: str = "null") -> Column:
    """State abbreviation -> unaccented upper case name.

    ``unknown``: ``null`` gives NULL, ``keep`` passes the value through, ``missing`` gives NOT REPORTED.
    """
    c = col(c)
    names = _lookup({code: plain_name(entry[0]) for code, entry in vocab.STATES.items()})
    found = F.try_element_at(names, c)
    if unknown == "keep":
        return F.coalesce(found, c)
    if unknown == "missing":
        return F.coalesce(found, F.lit(vocab.MISSING))
    return found


def known_state(c: Column | str) -> Column:
    """The name itself when it is a state name, else ``NOT_REPORTED``."""
    c = col(c)
    return F.when(c.isin(*state_names()), c).otherwise("NOT_REPORTED")


def region_name(c: Column | str) -> Column:
    return F.try_element_at(_lookup(vocab.REGIONS), col(c))


def kit_method(c: Column | str) -> Column:
    return F.try_element_at(_lookup(vocab.KIT_METHODS), col(c))


def repair_encoding(c: Column | str) -> Column:
    """Undo UTF-8 text that was read as latin-1; values without such traces stay as they are."""
    c = col(c)
    broken = c.rlike("[ÃÂ][\u0080-¿]")
    latin_only = ~c.rlike("[^\u0000-ÿ]")
    return F.when(broken & latin_only, F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")).otherwise(c)
