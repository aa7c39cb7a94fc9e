"""Call-log parsing: bad lines, lenient dates, quoted commas, day of week."""

import os

from pyspark.sql import functions as F

from blotter.plans import jobs
from blotter.sources.calls import field, parse_calls, read_call_lines, read_call_records

LINES = [
    "CAD,Event,Date,Clearance,Type,Group,Initial,Time",                       # D12 header
    "1,a,b,c,d,e,f,12/25/2016 12:00:00 AM",                                  # Sunday
    "2,a,b,c,d,e,f,07/06/2017 03:49:31 PM",                                  # Thursday
    "3,a,b,c,d,e,f,13/01/2017 01:00:00 AM",                                  # D13 month 13
    "4,a,b,c,d,e,f,07/06/2017 03:49:31 PM trailing",                         # D13 trailing text
    "5,a,b,c,d,e,f,garbage",                                                 # D12 junk
    "6,a,b",                                                                 # fewer than 8 columns
    "7,a,b,c,d,e,f,1/2/2017 1:05:00 PM",                                     # one-digit parts
]


def _write(tmp_out, lines):
    path = os.path.join(tmp_out, "calls")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_day_of_week_and_bad_lines(spark, tmp_out):
    lines = read_call_lines(spark, _write(tmp_out, LINES))
    out = jobs.calls_day_of_week(lines, keep=[field("value", 0).alias("id")])
    got = {r.id: (r.day_of_week, r.call_time_text) for r in out.collect()}
    assert got == {
        "1": (1, "Sun Dec 25 00:00:00 UTC 2016"),
        "2": (5, "Thu Jul 06 15:49:31 UTC 2017"),
        "7": (2, "Mon Jan 02 13:05:00 UTC 2017"),
    }


def test_timestamp_text_lines(spark, tmp_out):
    lines = read_call_lines(spark, _write(tmp_out, LINES[:3]))
    got = sorted(r.value for r in jobs.calls_timestamp_text(lines).collect())
    assert got == ["Sun Dec 25 00:00:00 UTC 2016", "Thu Jul 06 15:49:31 UTC 2017"]


def test_quoted_comma_with_csv_reader(spark, tmp_out):
    # D14: a quoted comma before the time column; the CSV reader keeps column 7 intact.
    path = _write(tmp_out, ['9,"Smith, John",b,c,d,e,f,12/25/2016 12:00:00 AM'])
    df = spark.read.csv(path)
    out = parse_calls(df, F.col("_c7"), keep=[F.col("_c0").alias("id")])
    assert [(r.id, r.day_of_week) for r in out.collect()] == [("9", 1)]
    # the plain split used for reference-exact lines shifts the column instead
    shifted = parse_calls(read_call_lines(spark, path), field("value", 7))
    assert shifted.count() == 0


def test_quoted_lines_from_driver_tables(spark):
    from blotter.sources import tables
    from blotter.sources.calls import csv_field

    lines = tables.call_lines_quoted(spark, "/root/testdata/sf0.001")
    n = lines.count()
    assert jobs.calls_day_of_week(lines, quoted=True).count() == n
    assert jobs.calls_day_of_week(lines).count() == 0  # the plain split shifts the time column
    first = lines.select(csv_field("value", 1).alias("f")).first().f
    assert ", " in first


def test_timestamp_text_independent_of_session_zone(spark):
    import __spark_entry__ as E

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        la = sorted(map(tuple, E.queries()["calls_timestamp_text"](spark, "/root/testdata/sf0.001").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = sorted(map(tuple, E.queries()["calls_timestamp_text"](spark, "/root/testdata/sf0.001").collect()))
    assert la == utc and utc[0][1].endswith(utc[0][1][-4:]) and " UTC " in utc[0][1]


def test_timestamp_text_of_quoted_lines(spark, tmp_out):
    path = _write(tmp_out, ['9,"Smith, John",b,c,d,e,f,12/25/2016 12:00:00 AM'])
    lines = read_call_lines(spark, path)
    assert [r.value for r in jobs.calls_timestamp_text(lines, quoted=True).collect()] == ["Sun Dec 25 00:00:00 UTC 2016"]
    assert jobs.calls_timestamp_text(lines).count() == 0


RECORDS = (
    "CAD,Event,Date,Clearance,Type,Group,Initial,Time\n"                       # D12 header
    '1,"Smith, ""John""",b,c,d,e,f,12/25/2016 12:00:00 AM\n'                   # D14 quoted comma and quotes
    '2,"two\nlines",b,c,d,e,f,07/06/2017 03:49:31 PM\n'                        # a quoted line break
    "3,a,b\n"                                                                  # too few fields
    "4,a,b,c,d,e,f,07/06/2017 03:49:31 PM,more\n"                              # too many
    "5,a,b,c,d,e,f,garbage\n"                                                  # D12 junk
)


def test_csv_records_with_header_and_line_breaks(spark, tmp_out):
    path = os.path.join(tmp_out, "records.csv")
    with open(path, "w", newline="") as f:
        f.write(RECORDS)
    records = read_call_records(spark, path, header=True, multiline=True)
    assert records.columns == [*(f"c{i}" for i in range(8)), "corrupt_record"]
    rows = {r.c0: r for r in records.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5"]
    assert rows["1"].c1 == 'Smith, "John"' and rows["2"].c1 == "two\nlines"
    assert {i for i, r in rows.items() if r.corrupt_record is not None} == {"3", "4"}
    assert rows["3"].c7 is None
    got = {r.c0: r.day_of_week for r in jobs.calls_day_of_week(records, keep=[F.col("c0")]).collect()}
    assert got == {"1": 1, "2": 5, "4": 5}
    assert jobs.calls_timestamp_text(records).count() == 3


def test_csv_records_without_header_and_with_declared_width(spark, tmp_out):
    path = os.path.join(tmp_out, "plain.csv")
    with open(path, "w") as f:
        f.write("1,a;b,12/25/2016 12:00:00 AM\n2,x,12/26/2016 12:00:00 AM\n")
    for fields in (None, 3):
        records = read_call_records(spark, path, fields=fields)
        assert [r.day_of_week for r in jobs.calls_day_of_week(records, time_field=2).orderBy("call_time").collect()] == [1, 2]
