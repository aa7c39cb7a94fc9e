"""The command line runs a job from a JSON collection to a parquet result."""

import json
import os

from blotter.__main__ import main


def test_cli_top_crimes(spark, tmp_out):
    src = os.path.join(tmp_out, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for t in ["THEFT", "THEFT", "BATTERY"]:
            f.write(json.dumps({"Primary Type": t, "District": 1, "Year": 2016}) + "\n")
    out = os.path.join(tmp_out, "out")
    assert main(["top_crimes", "--input", src, "--output", out]) == 0
    rows = sorted((r.TypeOfCrime, r.NumberOfEvents, r.rk) for r in spark.read.parquet(out).collect())
    assert rows == [("BATTERY", 1, 2), ("THEFT", 2, 1)]


def test_cli_density_params(spark, tmp_out):
    src = os.path.join(tmp_out, "in2")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for d in [1, 2, 2, 3]:
            f.write(json.dumps({"Primary Type": "T", "District": d, "Year": 2017}) + "\n")
    out = os.path.join(tmp_out, "dens")
    assert main(["district_density", "--input", src, "--output", out, "--output-format", "json",
                 "--param", "year=2017", "--param", "points=1.0,2.0,3.0"]) == 0
    assert spark.read.json(out).count() == 3


def test_cli_all_jobs(spark, tmp_out):
    src = os.path.join(tmp_out, "in3")
    os.makedirs(src)
    docs = [
        {"Primary Type": "THEFT", "District": 1, "Location Description": "STREET", "Arrest": "true",
         "Date": "01/02/2016 01:00:00 PM", "Year": 2016, "incident_id": 1},
        {"Primary Type": "BATTERY", "District": "2", "Location Description": "HOUSE", "Arrest": "false",
         "Date": "02/02/2017 01:00:00 PM", "Year": 2017, "incident_id": 2},
        {"Primary Type": "THEFT", "District": 3.0, "Location Description": "STREET", "Arrest": "false",
         "Date": "03/02/2017 01:00:00 PM", "Year": 2017, "incident_id": 3},
    ]
    with open(os.path.join(src, "a.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")
    out = os.path.join(tmp_out, "all")
    assert main(["all", "--input", src, "--output", out]) == 0
    from blotter.plans import jobs

    for name in jobs.JOBS:
        assert os.path.isdir(os.path.join(out, name)), name
    by_month = {r.YearAndMonth: [x.TypeOfCrime for x in r.CrimesInOrder]
                for r in spark.read.parquet(os.path.join(out, "crimes_by_month")).collect()}
    assert by_month == {"2016/01": ["THEFT"], "2017/02": ["BATTERY"], "2017/03": ["THEFT"]}


def test_cli_density_report_lines(spark, tmp_out):
    src = os.path.join(tmp_out, "in4")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for d in [1, 2, 2, 3]:
            f.write(json.dumps({"Primary Type": "T", "District": d, "Year": 2017}) + "\n")
    out = os.path.join(tmp_out, "kde_txt")
    assert main(["district_density", "--input", src, "--output", out, "--output-format", "text"]) == 0
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 25 and lines[0].startswith("Distretto n.1: ") and lines[-1].startswith("Distretto n.25: ")


def test_cli_calls(spark, tmp_out):
    src = os.path.join(tmp_out, "calls")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.csv"), "w") as f:
        f.write("CAD,Event,Date,Clearance,Type,Group,Initial,Time\n")
        f.write("1,a,b,c,d,e,f,12/25/2016 12:00:00 AM\n")
        f.write('2,"x, y",b,c,d,e,f,07/06/2017 03:49:31 PM\n')
    text_out = os.path.join(tmp_out, "calls_text")
    assert main(["calls_timestamp_text", "--input", src, "--output", text_out]) == 0
    assert [r.value for r in spark.read.text(text_out).collect()] == ["Sun Dec 25 00:00:00 UTC 2016"]
    dow_out = os.path.join(tmp_out, "calls_dow")
    assert main(["calls_day_of_week", "--input", src, "--output", dow_out, "--param", "quoted=True"]) == 0
    assert sorted(r.day_of_week for r in spark.read.parquet(dow_out).collect()) == [1, 5]


def test_cli_parameters_by_signature(spark, tmp_out):
    import pytest

    src = os.path.join(tmp_out, "calls2")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.csv"), "w") as f:
        f.write("1,a,b,c,d,e,f,2016-12-25\n")
    out = os.path.join(tmp_out, "t1")
    # false is false, a pattern with a comma stays one pattern
    assert main(["calls_timestamp_text", "--input", src, "--output", out, "--param", "quoted=false",
                 "--param", "pattern=yyyy-MM-dd", "--param", "time_field=7"]) == 0
    assert [r.value for r in spark.read.text(out).collect()] == ["Sun Dec 25 00:00:00 UTC 2016"]
    from blotter.__main__ import _parameters
    from blotter.plans import jobs

    assert _parameters(jobs.calls_day_of_week, ["pattern=EEE, d MMM yyyy", "quoted=false"]) == {"pattern": "EEE, d MMM yyyy", "quoted": False}
    assert _parameters(jobs.district_density, ["points=1,2.5", "year=2001"]) == {"points": [1.0, 2.5], "year": 2001}
    assert _parameters(jobs.top_crimes, ["top=3"]) == {"top": 3}
    assert _parameters(jobs.top_crimes, ["top=none"]) == {"top": None}
    with pytest.raises(SystemExit):
        _parameters(jobs.top_crimes, ["nope=3"])
    with pytest.raises(SystemExit):
        _parameters(jobs.calls_day_of_week, ["quoted=maybe"])


def test_cli_csv_options_and_two_field_documents(spark, tmp_out):
    src = os.path.join(tmp_out, "in5")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("Primary Type,District,Location Description,Arrest,Date,Year\nTHEFT,1,S,true,01/02/2016,2016\n")
    out = os.path.join(tmp_out, "two")
    assert main(["top_crimes", "--input", src, "--input-format", "csv", "--option", "header=true", "--no-rank",
                 "--output", out, "--output-format", "json"]) == 0
    docs = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert docs == [{"TypeOfCrime": "THEFT", "NumberOfEvents": 1}]
