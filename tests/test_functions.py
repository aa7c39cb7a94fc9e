"""Cleaning expressions: Java-style trim, number-or-text keys, safe numbers, month keys."""

import math

import pytest
from pyspark.sql import functions as F

from blotter.functions import canonical_text, java_trim, month_prefix, safe_double, year_month
from blotter.sources.incidents import clean_incidents

from helpers import json_incidents


def test_java_trim_strips_controls_not_inner(spark):
    df = spark.createDataFrame(
        [(" THEFT ",), ("\t\nBATTERY\r",), ("\x00A B\x1f",), ("",), ("   ",), ("\t\n",), (None,)], "s string"
    )
    out = [r[0] for r in df.select(java_trim("s")).collect()]
    assert out == ["THEFT", "BATTERY", "A B", "", "", "", None]


def test_canonical_text_of_json_numbers_and_text(spark, tmp_out):
    # D5, D11, D18: numbers become their integer part, text stays verbatim.
    docs = [
        {"incident_id": 1, "District": 1, "Year": 2016},
        {"incident_id": 2, "District": "001", "Year": "2016"},
        {"incident_id": 3, "District": 12.0, "Year": 2016.0},
        {"incident_id": 4, "District": 12.9, "Year": "x"},
        {"incident_id": 5, "District": "12.0", "Year": ""},
        {"incident_id": 6, "District": " 7 ", "Year": None},
        {"incident_id": 7, "District": -1.9},
        {"incident_id": 8, "District": None},
        {"incident_id": 9, "District": True},
        {"incident_id": 10, "District": "NaN"},
    ]
    raw = json_incidents(spark, tmp_out, docs)
    clean = clean_incidents(raw).orderBy("incident_id")
    rows = [(r.incident_id, r.district, r.year_text, r.year) for r in clean.collect()]
    assert rows == [
        (1, "1", "2016", 2016),
        (2, "001", "2016", 2016),
        (3, "12", "2016", 2016),
        (4, "12", "x", None),
        (5, "12.0", "", None),
        (6, " 7 ", None, None),
        (7, "-1", None, None),
        (8, None, None, None),
        (9, None, None, None),
        (10, "NaN", None, None),
    ]


def test_source_text_keeps_decimals(spark, tmp_out):
    docs = [
        {"incident_id": 1, "District": 12.9},
        {"incident_id": 2, "District": 12},
        {"incident_id": 3, "District": " 7 "},
        {"incident_id": 4, "District": None},
    ]
    clean = clean_incidents(json_incidents(spark, tmp_out, docs)).orderBy("incident_id")
    assert [r.district_text for r in clean.collect()] == ["12.9", "12", " 7 ", None]


def test_canonical_text_typed_columns(spark):
    df = spark.createDataFrame([(12.9, 7, "001", True)], "d double, i int, s string, b boolean")
    r = df.select(
        canonical_text(df, "d"), canonical_text(df, "i"), canonical_text(df, "s"), canonical_text(df, "b")
    ).first()
    assert tuple(r) == ("12", "7", "001", None)


def test_safe_double_cases(spark):
    # D18 and the parse rules of the numeric samples.
    vals = ["NaN", "Infinity", "-3", "abc", "null", "1e1", " 7 ", "", None, "001", "12.5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(safe_double("s")).collect()]
    assert math.isnan(out[0])
    assert out[1:] == [math.inf, -3.0, -1.0, -1.0, 10.0, 7.0, -1.0, -1.0, 1.0, 12.5]


def test_month_prefix_and_year_month(spark):
    # D6, D7: no '/' gives NULL; "1" and "01" are different months.
    df = spark.createDataFrame(
        [("2016", "01/02/2016 01:00:00 PM"), ("2016", "1/2/2016"), ("2016", "no date"), (None, "01/02/2016")],
        "y string, d string",
    )
    out = [tuple(r) for r in df.select(month_prefix("d"), year_month("y", "d")).collect()]
    assert out == [("01", "2016/01"), ("1", "2016/1"), (None, None), ("01", None)]


def test_clean_incidents_missing_fields(spark):
    df = spark.createDataFrame([(1, "THEFT")], "incident_id long, `Primary Type` string")
    with pytest.raises(ValueError, match="District"):
        clean_incidents(df)
    r = clean_incidents(df, missing_ok=True).first()
    assert r.primary_type == "THEFT" and r.district is None and r.year is None and r.location is None


def test_no_python_udf_in_cleaning_plan(spark):
    df = spark.createDataFrame([(1, " a ", "1", " b ", "true", "01/01/2016", "2016")],
                               "incident_id long, `Primary Type` string, District string, "
                               "`Location Description` string, Arrest string, Date string, Year string")
    plan = clean_incidents(df).select(F.col("*"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_clean_incidents_without_id_uses_input_order(spark, tmp_path):
    # documents without id are ordered by their place in the files
    raw = json_incidents(spark, str(tmp_path), [{"Primary Type": t} for t in "CAB"])
    inc = clean_incidents(raw).orderBy("position")
    assert [(r.incident_id, r.primary_type) for r in inc.collect()] == [(None, "C"), (None, "A"), (None, "B")]
    # a table without id or files has no order to offer
    df = spark.createDataFrame([("A",)], "`Primary Type` string")
    r = clean_incidents(df, missing_ok=True).first()
    assert r.incident_id is None and r.position is None


def test_java_trim_property(spark):
    # Java's trim strips every char <= U+0020 at both ends; compare with Python on random text.
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from blotter.functions.text import JAVA_BLANKS

    alphabet = st.sampled_from(list(JAVA_BLANKS[:4]) + [" ", "\t", "\n", "\x1f", "a", "B", "|", "é", " ", "/"])

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet=alphabet, max_size=12), min_size=1, max_size=40))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        got = [r[0] for r in df.select(java_trim("s"), ).collect()]
        assert got == [v.strip(JAVA_BLANKS) for v in values]

    check()


def test_month_prefix_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet="01/ab ", max_size=10), min_size=1, max_size=40))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        got = [r[0] for r in df.select(month_prefix("s")).collect()]
        assert got == [v[: v.index("/")] if "/" in v else None for v in values]

    check()


def test_clean_incidents_typed_date(spark):
    import datetime

    df = spark.createDataFrame(
        [(1, "THEFT", datetime.datetime(2016, 1, 2, 13, 5, 0), 2016)],
        "incident_id long, `Primary Type` string, Date timestamp_ntz, Year int",
    )
    r = clean_incidents(df, missing_ok=True).first()
    assert r.date_text == "01/02/2016 01:05:00 PM"


def test_numbers_beyond_int_keep_their_row(spark, tmp_path):
    # D20: whole parts of any size, truncated toward zero.
    docs = [("3000000000", "3000000000"), ("1e10", "10000000000"), ("7", "7"), ("7.9", "7"), ("-3e9", "-3000000000"),
            ('"3000000000"', "3000000000"), ("-0.5", "0"), ("-7.9", "-7"), ("12345678901234567890123", "12345678901234567890123"),
            ("9007199254740993", "9007199254740993"), ("1e20", "100000000000000000000"), ("true", None), ("null", None)]
    from blotter.functions.text import canonical_text

    df = spark.createDataFrame([(d,) for d, _ in docs], "t string").selectExpr("t", "parse_json(t) AS v")
    got = {r.t: r.c for r in df.select("t", canonical_text(df, "v").alias("c")).collect()}
    assert got == dict(docs)
    for sql, expect in [("3000000000L", "3000000000"), ("1.5E10D", "15000000000"), ("-1.9D", "-1"), ("-0.5BD", "0"),
                        ("12345678901234567890.75BD", "12345678901234567890"), ("9.9E17D", "990000000000000000")]:
        typed = spark.sql(f"SELECT {sql} AS v")
        assert typed.select(canonical_text(typed, "v")).first()[0] == expect
