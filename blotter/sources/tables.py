"""Adapters: incidents and call logs derived from the driver's tables.

The driver ships TPC-H-like tables, not incident documents.  These adapters
re-read ``orders`` joined with ``customer`` as incidents (one per order) and
``events`` as call-log lines, so every query's work grows with those tables.

The join is a plain equi-join: Spark broadcasts ``customer`` only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans it at run time; at large scale it stays a shuffle join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import schema as S
from blotter.functions.calendar import DATE_TEXT_PATTERN
from blotter.session import ensure_checkpoint_dir
from blotter.sources.incidents import clean_incidents


# Declared schemas of the driver tables the adapters read: a declared schema
# spares the footer read of schema inference on every query.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in TABLE_SCHEMAS:
        return spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _year_ranges(years) -> str:
    """``o_orderdate`` range predicate covering the given years (runs of
    consecutive years become one range), which Parquet can use to skip data."""
    ys = sorted(set(int(y) for y in years))
    runs, start = [], ys[0]
    for prev, cur in zip(ys, ys[1:] + [None]):
        if cur != prev + 1:
            runs.append((start, prev))
            start = cur
    parts = [
        f"(o_orderdate >= TIMESTAMP_NTZ '{a:04d}-01-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ '{b + 1:04d}-01-01 00:00:00')"
        for a, b in runs
    ]
    return " OR ".join(parts)


def _orders(spark: SparkSession, sf_dir: str, years=None, customers: bool = True) -> DataFrame:
    """Orders as the source of incidents.  Only District and Location come from
    the customer; a query that uses neither reads the orders alone (every order
    has a customer, so the join neither drops nor repeats one)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    if years:
        # The incident year is year(o_orderdate) (or NULL): a caller that only
        # wants some years can skip the other dates at the scan.
        orders = orders.where(_year_ranges(years))
    if not customers:
        return orders.selectExpr("*", "CAST(NULL AS INT) AS c_nationkey", "CAST(NULL AS STRING) AS c_mktsegment")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(people, orders.o_custkey == people.c_custkey, "inner")


_ARREST = "CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END"
_DATE = f"date_format(o_orderdate, '{DATE_TEXT_PATTERN}')"


def _q(name: str) -> str:
    return f"`{name}`"


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed incident documents: District and Year are numbers."""
    return _orders(spark, sf_dir).selectExpr(
        f"o_orderkey AS {_q(S.F_ID)}",
        f"o_orderpriority AS {_q(S.F_TYPE)}",
        f"c_nationkey + 1 AS {_q(S.F_DISTRICT)}",
        f"c_mktsegment AS {_q(S.F_LOCATION)}",
        f"{_ARREST} AS {_q(S.F_ARREST)}",
        f"{_DATE} AS {_q(S.F_DATE)}",
        f"year(o_orderdate) AS {_q(S.F_YEAR)}",
    )


def raw_incidents_dirty(spark: SparkSession, sf_dir: str, years=None, customers: bool = True) -> DataFrame:
    """Incident documents with the messy values the cleaning must handle:
    blank and tab-padded types, NULLs, text districts ("abc", "-1", "NaN",
    zero-padded), blank locations, dates without '/', missing years.  The
    mess is injected by a rule on the order key, every order is kept."""
    n = "CAST(c_nationkey + 1 AS STRING)"
    return _orders(spark, sf_dir, years, customers).selectExpr(
        f"o_orderkey AS {_q(S.F_ID)}",
        "CASE WHEN o_orderkey % 89 = 0 THEN '' "
        "WHEN o_orderkey % 83 = 0 THEN concat(char(9), o_orderpriority, ' ') "
        "WHEN o_orderkey % 79 = 0 THEN NULL "
        "WHEN o_orderkey % 73 = 0 THEN 'A|B' "
        f"ELSE o_orderpriority END AS {_q(S.F_TYPE)}",
        "CASE WHEN o_orderkey % 101 = 0 THEN '' "
        "WHEN o_orderkey % 103 = 0 THEN 'abc' "
        "WHEN o_orderkey % 107 = 0 THEN '-1' "
        "WHEN o_orderkey % 109 = 0 THEN NULL "
        f"WHEN o_orderkey % 113 = 0 THEN concat('0', {n}) "
        "WHEN o_orderkey % 127 = 0 THEN 'NaN' "
        f"ELSE {n} END AS {_q(S.F_DISTRICT)}",
        f"CASE WHEN o_orderkey % 71 = 0 THEN '   ' ELSE c_mktsegment END AS {_q(S.F_LOCATION)}",
        f"{_ARREST} AS {_q(S.F_ARREST)}",
        f"CASE WHEN o_orderkey % 67 = 0 THEN 'no date' ELSE {_DATE} END AS {_q(S.F_DATE)}",
        f"CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE year(o_orderdate) END AS {_q(S.F_YEAR)}",
    )


def raw_incidents_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident documents whose District is a JSON integer, a JSON decimal
    (n + 0.25) or JSON text (zero-padded below 10), rotating by order key -
    the shape a schemaless document store hands over.  Some numbers lie beyond
    int, long or both, with either sign."""
    n = "CAST(c_nationkey + 1 AS STRING)"
    padded = f"CASE WHEN c_nationkey + 1 < 10 THEN concat('0', {n}) ELSE {n} END"
    return _orders(spark, sf_dir).selectExpr(
        f"o_orderkey AS {_q(S.F_ID)}",
        f"o_orderpriority AS {_q(S.F_TYPE)}",
        "CASE WHEN o_orderkey % 131 = 0 THEN parse_json('3000000000') "
        "WHEN o_orderkey % 137 = 0 THEN parse_json('-3000000000.75') "
        "WHEN o_orderkey % 139 = 0 THEN parse_json('12345678901234567890123') "
        "WHEN o_orderkey % 149 = 0 THEN parse_json('-1.0E10') "
        f"WHEN o_orderkey % 3 = 0 THEN parse_json({n}) "
        f"WHEN o_orderkey % 3 = 1 THEN parse_json(concat({n}, '.25')) "
        f"ELSE parse_json(concat('\"', {padded}, '\"')) END AS {_q(S.F_DISTRICT)}",
        f"c_mktsegment AS {_q(S.F_LOCATION)}",
        f"{_ARREST} AS {_q(S.F_ARREST)}",
        f"{_DATE} AS {_q(S.F_DATE)}",
        f"parse_json(CAST(year(o_orderdate) AS STRING)) AS {_q(S.F_YEAR)}",
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_incidents(raw_incidents(spark, sf_dir))


def incidents_dirty(spark: SparkSession, sf_dir: str, years=None, customers: bool = True) -> DataFrame:
    """Cleaned dirty incidents; ``years`` (optional) lets the scan skip other
    dates, ``customers=False`` leaves District and Location NULL."""
    return clean_incidents(raw_incidents_dirty(spark, sf_dir, years, customers))


def incidents_from_documents(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    """The dirty incidents as JSON documents, parsed again with the declared
    schema: the path of a document collection, ids from a document field."""
    raw = raw_incidents_dirty(spark, sf_dir, years)
    text = raw.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("doc"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.RAW_INCIDENT_SCHEMA.fields)
    return clean_incidents(text.select(F.from_json("doc", fields).alias("doc")).select("doc.*"))


def incidents_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_incidents(raw_incidents_mixed(spark, sf_dir))


def call_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call-log lines: 8 comma-joined fields, the call time in field 7."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        "concat_ws(',', CAST(event_id AS STRING), event_type, CAST(user_id AS STRING), "
        "CAST(value AS STRING), 'x', 'x', 'x', "
        f"date_format(ts, '{DATE_TEXT_PATTERN}')) AS value"
    )


def call_lines_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call-log lines whose second field is quoted and holds a comma
    (``"<event_type>, <user_id>"``), so a plain split shifts the time column."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        "concat_ws(',', CAST(event_id AS STRING), concat('\"', event_type, ', ', CAST(user_id AS STRING), '\"'), "
        "CAST(value AS STRING), 'x', 'x', 'x', 'x', "
        f"date_format(ts, '{DATE_TEXT_PATTERN}')) AS value"
    )


def call_record_files(spark: SparkSession, sf_dir: str) -> str:
    """Call-log CSV files with a header line, written below the checkpoint
    folder; returns their folder.  The second field holds a line break, a
    separator and quotes; the time of some calls is no time."""
    ev = table(spark, sf_dir, "events")
    records = ev.selectExpr(
        "event_id AS id",
        "concat(event_type, char(10), '\"', CAST(user_id AS STRING), '\", x') AS note",
        "CAST(value AS STRING) AS value",
        "'x' AS a", "'x' AS b", "'x' AS c", "'x' AS d",
        f"CASE WHEN event_id % 97 = 0 THEN 'not known' ELSE date_format(ts, '{DATE_TEXT_PATTERN}') END AS time",
    )
    folder = f"{ensure_checkpoint_dir(spark)}/call-records-{uuid.uuid4().hex}"
    records.write.csv(folder, header=True, quote='"', escape='"')
    return folder
