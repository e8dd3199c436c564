"""Combined table -> cube -> summaries -> release folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labwatch.plans.combine import city_report, estimates_by_week, summary_rows
from labwatch.plans.matrices import Summary, exported_tables, summary_cube
from labwatch.session import stored
from labwatch.sources.sinks import publish, release_name, write_delimited


def hold(combined: DataFrame) -> DataFrame:
    """The combined table stored once; summaries, export and report of a release read the stored rows."""
    return stored(combined, "combined")


def prepare(combined: DataFrame, estimates: DataFrame, macroregions: DataFrame, as_of: str, **params) -> Summary:
    """Aggregate the combined table once into a cube table that every summary reads."""
    cube = stored(summary_cube(summary_rows(combined, as_of)), "cube")
    weekly = estimates_by_week(estimates, as_of)
    return Summary(cube, weight="n", macroregions=macroregions, estimates=weekly, **params)


def make_release(
    s: Summary, combined: DataFrame, releases: DataFrame, internal: str, public: str, as_of: str
) -> str:
    """Write all summaries, the combined table and the city report under the next release name and as ``current``.

    ``combined`` is read several times: pass the rows that ``hold`` stored.
    """
    name = release_name(releases, as_of).collect()[0]["release"]
    publish(combined.sparkSession, exported_tables(s), internal, public, name)
    report = city_report(combined)
    for folder in (name, "current"):
        write_delimited(combined, f"{internal}/{folder}/combined", compression="gzip")
        write_delimited(report, f"{internal}/{folder}/report")
    return name
