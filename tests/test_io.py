"""Sources and sinks: JSON documents with variant fields, nested round trips, text lines."""

import os

from pyspark.sql import functions as F

from blotter.plans import jobs
from blotter.sources import clean_incidents, read_incidents, write_lines, write_result

from helpers import json_incidents

DOCS = [
    {"incident_id": 1, "Primary Type": "THEFT", "District": 1, "Location Description": "STREET",
     "Arrest": "true", "Date": "01/02/2016 01:00:00 PM", "Year": 2016},
    {"incident_id": 2, "Primary Type": " THEFT ", "District": "1", "Location Description": "STREET",
     "Arrest": "false", "Date": "02/02/2016 01:00:00 PM", "Year": 2016.0},
    {"incident_id": 3, "Primary Type": "BATTERY", "District": 2.0, "Location Description": "HOUSE",
     "Arrest": True, "Date": "02/02/2016 01:00:00 PM", "Year": "2016"},
]


def test_json_documents_end_to_end(spark, tmp_out):
    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    got = {r.DistrictNumber: [(x.TypeOfCrime, x.NumberOfEvents) for x in r.ListOfCrimes]
           for r in jobs.crimes_by_district(inc).collect()}
    assert got == {"1": [("THEFT", 2)], "2": [("BATTERY", 1)]}
    arrests = {r.Arrest: r.NumberOfCrimes for r in jobs.top_arrest_status(inc).collect()}
    assert arrests == {"true": 2, "false": 1}  # a JSON boolean is read as its text


def test_nested_round_trip(spark, tmp_out):
    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    out = jobs.crimes_by_year(inc)
    for fmt in ("parquet", "json"):
        path = os.path.join(tmp_out, f"out_{fmt}")
        write_result(out, path, fmt)
        back = read_incidents(spark, path, fmt, schema=out.schema)
        assert back.schema.simpleString() == out.schema.simpleString()
        assert sorted(map(str, back.collect())) == sorted(map(str, out.collect()))


def test_write_refuses_overwrite_by_default(spark, tmp_out):
    import pytest

    df = spark.range(3)
    path = os.path.join(tmp_out, "once")
    write_result(df, path)
    with pytest.raises(Exception):
        write_result(df, path)
    write_result(df, path, mode="overwrite")


def test_partitioned_write_prunes_on_read(spark, tmp_out):
    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    path = os.path.join(tmp_out, "by_year")
    write_result(inc.where(F.col("year").isNotNull()), path, partition_by=["year"])
    back = spark.read.parquet(path).where(F.col("year") == 2016)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert back.count() == 3


def test_text_lines(spark, tmp_out):
    path = os.path.join(tmp_out, "lines")
    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    dens = jobs.district_density(inc, 2016, points=[1.0, 2.0])
    write_lines(dens.orderBy("point_index").coalesce(1), "label", path)
    text = sorted(r.value for r in spark.read.text(path).collect())
    assert text[0].startswith("Distretto n.1: ") and text[1].startswith("Distretto n.2: ")


def test_stored_clean_incidents_prune_years(spark, tmp_out):
    from blotter.operators import stats
    from blotter.sources import read_clean_incidents, store_clean_incidents, tables

    path = os.path.join(tmp_out, "clean")
    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    store_clean_incidents(inc, path)
    back = read_clean_incidents(spark, path)
    assert back.columns == inc.columns
    sample = stats.district_sample(back, [1996, 1997])
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1996" in plan
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, stats.district_sample(inc, [1996, 1997]).collect()))


def test_connector_style_options_without_path(spark, tmp_out):
    path = os.path.join(tmp_out, "opt")
    write_result(spark.range(4), None, "parquet", path=path)
    assert read_incidents(spark, None, "parquet", path=path).count() == 4


def test_nested_documents_as_json_lines(spark, tmp_out):
    import json as _json

    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    path = os.path.join(tmp_out, "docs_out")
    write_result(jobs.crimes_by_district(inc).coalesce(1), path, "json")
    docs = sorted((_json.loads(r.value) for r in spark.read.text(path).collect()), key=lambda d: d["DistrictNumber"])
    assert docs == [
        {"DistrictNumber": "1", "ListOfCrimes": [{"TypeOfCrime": "THEFT", "NumberOfEvents": 2}]},
        {"DistrictNumber": "2", "ListOfCrimes": [{"TypeOfCrime": "BATTERY", "NumberOfEvents": 1}]},
    ]


def test_csv_with_header_and_missing_columns(spark, tmp_out):
    import pytest

    path = os.path.join(tmp_out, "csv")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("ID,Primary Type,District,Location Description,Arrest,Date,Year\n")
        f.write("7,THEFT,1,STREET,true,01/02/2016 01:00:00 PM,2016\n8,THEFT,2,STREET,true,01/02/2016 01:00:00 PM,2016\n")
    raw = read_incidents(spark, path, "csv", id_col="ID", header="true")
    inc = clean_incidents(raw)
    assert sorted(r.incident_id for r in inc.collect()) == [7, 8]
    assert [tuple(r)[:2] for r in jobs.top_crimes(inc).collect()] == [("THEFT", 2)]
    with pytest.raises(ValueError, match="Primary Type"):
        clean_incidents(read_incidents(spark, path, "csv"))


def test_output_documents_without_rank(spark, tmp_out):
    inc = clean_incidents(json_incidents(spark, tmp_out, DOCS))
    assert jobs.top_crimes(inc, rank_col=None).columns == ["TypeOfCrime", "NumberOfEvents"]
    assert jobs.top_districts(inc, rank_col=None).columns == ["DistrictNumber", "NumberOfEvents"]
    assert [tuple(r) for r in jobs.top_crimes(inc, rank_col=None).collect()] == [("THEFT", 2), ("BATTERY", 1)]


def test_no_checkpoint_folder_of_its_own_on_a_cluster():
    import types

    import pytest

    from blotter.session import ensure_checkpoint_dir

    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://x:7077"):
        sc = types.SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc))

    class Connect:
        conf = types.SimpleNamespace(get=lambda k, d=None: d)

        @property
        def sparkContext(self):
            raise NotImplementedError

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Connect())
