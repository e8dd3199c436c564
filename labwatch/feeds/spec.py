"""What one laboratory's feed looks like, as data plus column rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# A rule sees the stage-01 columns by name, never a column another rule just produced.
Rule = Callable[[], Column]


@dataclass(frozen=True)
class LabSpec:
    lab_id: str
    # Stage 01: canonical name -> raw header.
    columns: dict[str, str]
    # canonical name -> date formats, tried in order.
    dates: dict[str, tuple[str, ...]]
    casts: dict[str, str] = field(default_factory=dict)
    normalise: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    converters: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    distinct_raw: bool = False
    raw_filter: Rule | None = None
    # Stage 02.
    key: Callable[[], list[Column]] = list
    rules: dict[str, Rule] = field(default_factory=dict)
    keep: Rule = lambda: F.lit(True)
    keep_fixed: Rule = lambda: F.lit(True)
    # Lines of one key that are dropped before the rules apply (first line wins).
    first_line_only: bool = False
    # Collapse.
    code: str = ""
    codes: dict[str, list[str]] = field(default_factory=dict)
    redundant: tuple[tuple[str, str], ...] = ()
    # pathogen -> output of ``rules`` that already holds its result.
    wide: dict[str, str] = field(default_factory=dict)
    single_line: bool = False
    # Reading.
    format: str = "csv"
    separator: str = ","
    encoding: str = "UTF-8"
    sheet: str | None = None
    # Every sheet of a workbook instead of the first.
    all_sheets: bool = False
    glob: str = "*.csv"
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    tagged_prefix: str | None = None
    drop_footer: bool = False

    def raw_headers(self) -> list[str]:
        return list(self.columns.values())
