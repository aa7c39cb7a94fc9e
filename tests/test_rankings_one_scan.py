"""The ten rankings from one scan equal the ten single jobs."""

import pytest

from blotter.plans import jobs, rankings
from blotter.session import write_out
from blotter.sources import tables

from helpers import clean_rows

ROWS = [
    (1, "THEFT", "1", "STREET", "true", "01/02/2016 01:00:00 PM", "2016"),
    (2, "A|B", "1", "", "false", "01/02/2016 01:00:00 PM", "2016"),
    (3, "", "2", "HOUSE", None, "no date", "2016"),
    (4, None, None, "HOUSE", "true", "02/02/2016 01:00:00 PM", ""),
    (5, "THEFT", "", "HOUSE", "true", None, None),
    (6, "ARSON", "001", " STREET ", "true", "1/02/2016 01:00:00 PM", "2016"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    return [tables.incidents_dirty(spark, "/root/testdata/sf0.001"), clean_rows(spark, ROWS), clean_rows(spark, ROWS[:1]).where("false")]


@pytest.mark.parametrize("which", [0, 1, 2])
def test_every_ranking_equals_its_job(inputs, which):
    incidents = inputs[which]
    ranked = rankings.rank_all(incidents)
    for name in [*jobs.FLAT, *jobs.NESTED]:
        got, expect = rankings.one_ranking(ranked, name), jobs.JOBS[name](incidents)
        assert got.columns == expect.columns
        assert got.schema.simpleString() == expect.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, expect.collect()))


def test_rankless_documents_are_sorted(inputs):
    ranked = rankings.rank_all(inputs[1])
    for name in jobs.FLAT:
        assert rankings.one_ranking(ranked, name, None).collect() == jobs.JOBS[name](inputs[1], rank_col=None).collect()


def test_one_scan_and_a_partial_aggregate(spark, tmp_path):
    stored = write_out(tables.incidents_dirty(spark, "/root/testdata/sf0.001"), "one-scan")
    plan = rankings.count_rankings(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_count" in plan and plan.count("Expand") == 1
    assert plan.count("Exchange") == 1 and "Window" not in plan
