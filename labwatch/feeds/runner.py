"""One engine for all laboratories: types, rules, one-hot, collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.feeds.spec import LabSpec
from labwatch.functions.dates import local_stamp, try_date
from labwatch.functions.text import normalize_text, sample_key
from labwatch.operators.shaping import normalise_id, one_hot, result_text
from labwatch.operators.windows import collapse_samples, dedupe, drop_redundant, propagate
from labwatch.schema import CARRIED, LAB_COLUMNS
from labwatch.session import stored


def _stage_one(spec: LabSpec) -> dict:
    out = {}
    for name, header in spec.columns.items():
        raw = F.col(f"`{header}`")
        if name in spec.dates:
            value = try_date(raw, *spec.dates[name])
        elif name in spec.ids:
            value = normalise_id(raw)
        elif name in spec.casts:
            value = raw.try_cast(spec.casts[name])
        elif name in spec.converters:
            value = spec.converters[name](raw)
        elif name in spec.normalise:
            value = normalize_text(raw)
        else:
            value = raw.cast("string")
        out[name] = value
    return out


def convert_types(raw: DataFrame, spec: LabSpec, strict: bool = False) -> DataFrame:
    """Stage 01: rename, cast, normalise. ``strict`` fails the load on a value that does not cast."""
    typed = _stage_one(spec)
    rows = raw
    if strict:
        bad = rejects(raw, spec).limit(1).collect()
        if bad:
            raise ValueError(f"{spec.lab_id}: value does not cast in {bad[0]['rejected_columns']}")
    if spec.raw_filter is not None:
        rows = rows.filter(spec.raw_filter())
    # Cleaned texts feed many rules, so they are computed once; the others stay plain columns.
    texts = {n: v for n, v in typed.items() if n in spec.normalise or n in spec.converters}
    cleaned = [v.alias(n) for n, v in texts.items()]
    once = [F.inline(F.array(F.struct(*cleaned)))] if cleaned else []
    out = rows.select(*[v.alias(n) for n, v in typed.items() if n not in texts], "file_name", *once)
    out = out.select(*typed, "file_name")
    return out.distinct() if spec.distinct_raw else out


def rejects(raw: DataFrame, spec: LabSpec) -> DataFrame:
    """Raw rows with a value that stage 01 cannot read, and the names of those columns."""
    checked = {**spec.dates, **{n: None for n in spec.casts}, **{n: None for n in spec.ids}}
    typed = _stage_one(spec)
    failing = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"`{spec.columns[n]}`").isNotNull() & typed[n].isNull(), F.lit(n))
                for n in checked
            ]
        )
    )
    return raw.withColumn("rejected_columns", failing).filter(F.size("rejected_columns") > 0)


def fix_values(typed: DataFrame, spec: LabSpec) -> DataFrame:
    """Stage 02: key and cleaned values in one select, so every rule reads stage-01 values.

    Lines of analytes that another line of the test repeats are left out.
    """
    if spec.redundant and (spec.code in spec.rules or "test_id" in spec.rules):
        raise ValueError(f"{spec.lab_id}: redundant analytes are told by columns that a rule replaces")
    sample_id = sample_key(*spec.key())
    if spec.first_line_only:
        keyed = typed.withColumn("__key", sample_id)
        typed = dedupe(keyed, ["__key"], [c for c in typed.columns]).drop("__key")
    lines = typed.filter(spec.keep())
    if spec.redundant:
        # The analytes of a test decide which lines stay: the cleaned lines are read several times,
        # so they are stored once, and the rules then run on the lines that stay.
        lines = drop_redundant(stored(lines, spec.lab_id.lower()), "test_id", spec.code, list(spec.redundant))
    rules = {name: rule() for name, rule in spec.rules.items()}
    passed = [F.col(c) for c in typed.columns if c not in rules]
    result = rules.pop("result", None)
    once = [] if result is None else [F.inline(F.array(F.struct(result.alias("result"))))]
    out = lines.select(
        sample_id.alias("sample_id"),
        *passed,
        *[value.alias(name) for name, value in rules.items()],
        *once,
    )
    out = out.filter(spec.keep_fixed())
    return out if "patient_id" in out.columns else out.withColumn("patient_id", F.lit(None).cast("string"))


def pivot_results(fixed: DataFrame, spec: LabSpec) -> DataFrame:
    """Stage 03: one column per pathogen."""
    if spec.wide:
        own = [F.col(spec.wide[p]) if p in spec.wide else F.lit(vocab.NOT_TESTED) for p in vocab.PATHOGENS]
        columns = [c.cast("int").alias(vocab.RESULT_OF[p]) for p, c in zip(vocab.PATHOGENS, own)]
    else:
        columns = one_hot(spec.code, "result", spec.codes)
    return fixed.select("sample_id", *CARRIED, *columns)


def collapse(pivoted: DataFrame, spec: LabSpec) -> DataFrame:
    """One row per sample."""
    if spec.wide:
        # Already one line per result set: the first line wins and counts as one.
        first = dedupe(pivoted, ["sample_id"], [*CARRIED, *vocab.RESULT_COLUMNS])
        texts = [result_text(c).alias(c) for c in vocab.RESULT_COLUMNS]
        return first.select("sample_id", *CARRIED, *texts, F.lit(1).cast("long").alias("qty_original_lines"))
    out = collapse_samples(pivoted, "sample_id", CARRIED)
    if spec.single_line:
        out = out.withColumn("qty_original_lines", F.lit(1).cast("long"))
    return out


def stamp(samples: DataFrame, as_of: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """LabResult rows with the time of their load; ``also`` names columns to keep in front."""
    now = local_stamp(as_of)
    return samples.select(
        "*", now.alias("created_at"), now.alias("updated_at")
    ).select(*also, *LAB_COLUMNS)


def run_feed(raw: DataFrame, spec: LabSpec, as_of: str | None = None, strict: bool = False) -> DataFrame:
    """Raw rows of one laboratory -> LabResult.

    A single lazy plan, except that a feed with redundant analytes stores its cleaned lines first.
    """
    typed = convert_types(raw, spec, strict)
    return stamp(collapse(pivot_results(fix_values(typed, spec), spec), spec), as_of)


def run_stages(raw: DataFrame, spec: LabSpec) -> dict[str, DataFrame]:
    """The same feed stage by stage, line level; the stage tables the quality checks look at."""
    typed = convert_types(raw, spec)
    fixed = fix_values(typed, spec)
    pivoted = pivot_results(fixed, spec)
    filled = propagate(pivoted)
    samples = dedupe(filled, ["sample_id"], [*CARRIED])
    return {"typed": typed, "fixed": fixed, "pivoted": pivoted, "filled": filled, "samples": samples}
