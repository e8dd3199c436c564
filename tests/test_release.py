"""The whole way on the smallest test tables: combined, cube, summaries, release."""

import os

from labwatch.catalog import bridge as B
from labwatch.catalog.base import Tables
from labwatch.plans import combine as C
from labwatch.plans import quality as Q
from labwatch.plans.matrices import TABLES, exported_tables
from labwatch.plans.release import make_release, prepare
from labwatch.sources.readers import cast_estimates

FOLDER = "/root/testdata/sf0.001"


def test_release(spark, tmp_path):
    t = Tables(spark, FOLDER)
    combined = B.combined(t)
    assert Q.unequal_counts(B.samples(t), combined).isEmpty()
    assert Q.repeated_values(combined, "sample_id").isEmpty()
    estimates = cast_estimates(B.raw_estimates(t))
    s = prepare(combined, estimates, B.dimensions(t).macroregions, B.AS_OF, min_tests=1)
    assert len(exported_tables(s)) == 44 and len(TABLES) == 45
    # A rate of the cube equals the rate of the rows.
    name = "02_DENV_line_bar_posrate_posneg_direct_week_country_h"
    direct = TABLES[name].build(B.summary(t, min_tests=1)).collect()
    assert sorted(map(tuple, direct)) == sorted(map(tuple, TABLES[name].build(s).collect()))
    releases = spark.createDataFrame([("current",)], "release string")
    label = make_release(s, combined, releases, str(tmp_path / "in"), str(tmp_path / "pub"), "2026-12-31 10:00:00")
    assert label == "2026-12-31_10h00_Arbo_SE51.2026_V1"
    assert sorted(os.listdir(tmp_path / "in" / label)) == ["combined", "matrices", "report"]
    assert len(os.listdir(tmp_path / "in" / label / "matrices" / "csv")) == 44
    assert len(os.listdir(tmp_path / "pub" / "SE51.2026" / "matrices" / "csv")) == 43
    assert set(C.PRIVATE).isdisjoint(C.for_sharing(combined).columns)
