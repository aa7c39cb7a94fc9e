"""Counts of read, kept and dropped documents, and the lifetime of intermediate tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from blotter.__main__ import main
from blotter.plans import jobs
from blotter.plans.accounting import KEPT, READ, accounted, accounting, call_rules, job_rules
from blotter.session import ensure_checkpoint_dir, scratch_tables
from blotter.sources.calls import record_field
from blotter.sources import read_call_records

from helpers import clean_rows

ROWS = [
    (1, "THEFT", "1", "STREET", "true", "01/02/2017 01:00:00 PM", "2017"),
    (2, None, "2", "STREET", "true", "01/02/2017 01:00:00 PM", "2017"),        # D1
    (3, " \t ", "3", "STREET", "false", "01/02/2017 01:00:00 PM", "2017"),     # D4
    (4, "THEFT", None, "STREET", "false", "02/02/2017 01:00:00 PM", "2017"),   # D2
    (5, "THEFT", "", " ", None, "02/02/2017 01:00:00 PM", "2016"),
    (6, "THEFT", "abc", None, "false", "no date", "2017"),                     # D6
    (7, "THEFT", "-1", "STREET", "false", None, None),
    (8, None, "NaN", "STREET", "false", "03/02/2017 01:00:00 PM", "x"),        # D11
]


def dropped(spark, name, years=()):
    df, seen = accounted(clean_rows(spark, ROWS), job_rules(name, years))
    out = jobs.JOBS[name](df)
    out.collect()
    return seen.get


@pytest.mark.parametrize("name", sorted(jobs.JOBS))
def test_counts_add_up_in_the_jobs_own_pass(spark, name):
    years = [2017, 2016] if name == "district_correlation" else [2017]
    got = dropped(spark, name, years)
    assert got[READ] == len(ROWS)
    assert sum(n for rule, n in got.items() if rule != READ) == len(ROWS)


def test_flat_and_grouped_rules(spark):
    got = dropped(spark, "top_crimes")
    assert got == {"missing primary_type": 2, "blank primary_type": 1, KEPT: 5, READ: 8}
    kept = sum(r.NumberOfEvents for r in jobs.top_crimes(clean_rows(spark, ROWS)).collect())
    assert kept == got[KEPT]
    got = dropped(spark, "crimes_by_month")
    assert got == {"missing year": 1, "blank year": 0, "date without month": 1, "missing primary_type": 2, "blank primary_type": 1, KEPT: 3, READ: 8}
    months = jobs.crimes_by_month(clean_rows(spark, ROWS)).collect()
    assert sum(x.NumberOfEvents for r in months for x in r.CrimesInOrder) == got[KEPT]


def test_sample_rules(spark):
    got = dropped(spark, "district_density", [2017])
    # year "x" is no whole number: NULL
    assert got == {"missing year": 2, "other year": 1, "district is no number": 2, "negative district": 0, KEPT: 3, READ: 8}


def test_one_pass_for_all_jobs_equals_the_observed_counts(spark):
    rules = {name: job_rules(name, [2017]) for name in ("top_crimes", "crimes_by_month", "locations_by_district", "district_ks")}
    rows = accounting(clean_rows(spark, ROWS), rules).collect()
    for name in rules:
        assert {r.rule: r.documents for r in rows if r.job == name} == dropped(spark, name, [2017])


def test_no_rows_are_counted_as_none(spark):
    rows = accounting(clean_rows(spark, ROWS).where("false"), {"top_crimes": job_rules("top_crimes")}).collect()
    assert {r.documents for r in rows} == {0}


def test_unknown_job(spark):
    with pytest.raises(ValueError, match="unknown job"):
        job_rules("top_nothing")


def test_call_rules(spark, tmp_out):
    path = os.path.join(tmp_out, "calls.csv")
    with open(path, "w") as f:
        f.write('id,a,b,c,d,e,f,time\n1,"x, y",b,c,d,e,f,12/25/2016 12:00:00 AM\n2,a,b\n3,a,b,c,d,e,f,soon\n')
    lines = spark.read.text(path)
    df, seen = accounted(lines, call_rules())
    assert jobs.calls_day_of_week(df).count() == 0  # the plain split shifts the time of call 1
    assert seen.get == {"no time field": 1, "time does not parse": 3, KEPT: 0, READ: 4}
    records = read_call_records(spark, path, header=True)
    df, seen = accounted(records, call_rules(time=record_field(7)), "records")
    assert [r.day_of_week for r in jobs.calls_day_of_week(df).collect()] == [1]
    assert seen.get == {"no time field": 1, "time does not parse": 1, KEPT: 1, READ: 3}


def _folders(spark):
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_scratch_tables_go_when_the_block_ends(spark, tmp_out):
    inc = clean_rows(spark, ROWS)
    before = _folders(spark)
    with scratch_tables(spark):
        rows = jobs.top_crimes(inc).collect()
        with scratch_tables(spark):
            jobs.district_correlation(inc, 2017, 2016, "spearman").collect()
        outer = _folders(spark) - before
        assert outer  # those of the outer block are there, those of the inner one gone
        jobs.district_ks(inc, 2017).collect()
    assert _folders(spark) == before
    assert rows
    with pytest.raises(RuntimeError), scratch_tables(spark):
        jobs.top_districts(inc).collect()
        raise RuntimeError
    assert _folders(spark) == before


def _documents(path):
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        for t, d, y in [("THEFT", 1, 2017), ("", 2, 2017), (None, 3, 2016), ("BATTERY", "x", 2015)]:
            f.write(json.dumps({"Primary Type": t, "District": d, "Year": y, "Date": "01/01/2017 01:00:00 AM"}) + "\n")
    return path


def test_cli_writes_the_counts_and_leaves_no_tables(spark, tmp_out):
    src = _documents(os.path.join(tmp_out, "in"))
    before = _folders(spark)
    args = ["top_crimes", "--input", src, "--output", os.path.join(tmp_out, "out"), "--accounting", os.path.join(tmp_out, "counts")]
    assert main(args) == 0
    got = {r.rule: r.documents for r in spark.read.json(os.path.join(tmp_out, "counts")).collect()}
    assert got == {"missing primary_type": 1, "blank primary_type": 1, KEPT: 2, READ: 4}
    assert _folders(spark) == before
    assert main(["all", "--input", src, "--output", os.path.join(tmp_out, "all")]) == 0
    rows = spark.read.json(os.path.join(tmp_out, "all", "accounting")).collect()
    assert {r.job for r in rows} == set(jobs.JOBS)
    for name in jobs.JOBS:
        own = {r.rule: r.documents for r in rows if r.job == name}
        assert own.pop(READ) == sum(own.values()) == 4
    assert _folders(spark) == before


def test_cli_reads_call_records(spark, tmp_out):
    path = os.path.join(tmp_out, "calls.csv")
    with open(path, "w") as f:
        f.write('id,note,b,c,d,e,f,time\n1,"two\nlines, ""quoted""",b,c,d,e,f,12/25/2016 12:00:00 AM\n2,a,b,c,d,e,f,never\n')
    out, counts = os.path.join(tmp_out, "out"), os.path.join(tmp_out, "counts")
    args = ["calls_day_of_week", "--input", path, "--input-format", "csv", "--option", "header=true", "--option", "multiLine=true"]
    assert main([*args, "--output", out, "--accounting", counts]) == 0
    assert [r.day_of_week for r in spark.read.parquet(out).collect()] == [1]
    assert {r.rule: r.documents for r in spark.read.json(counts).collect()} == {"no time field": 0, "time does not parse": 1, KEPT: 1, READ: 2}
