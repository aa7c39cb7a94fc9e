"""Emergency-call logs: comma-separated lines with the call time in one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.calendar import CALL_TIME_PATTERN, day_of_week, parse_call_time, timestamp_text


def read_call_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


#: Column of ``read_call_records`` with the text of a record that is no CSV of the declared width.
CORRUPT = "corrupt_record"


def read_call_records(
    spark: SparkSession,
    path: str,
    *,
    header: bool = False,
    multiline: bool = False,
    fields: int | None = None,
    quote: str = '"',
    **options: str,
) -> DataFrame:
    """Call logs by Spark's CSV reader: columns ``c0``, ``c1``, ... by position, all
    text, and ``corrupt_record``, the text of a record with fewer or more fields
    (its missing fields are NULL) or else NULL.

    Quoted separators and doubled quotes stay inside their field.  ``header``
    leaves out the first line of each file, whatever it holds.  ``multiline``
    lets quoted fields span lines; a file is then read by one task, as its records
    cannot be found from the middle, so large logs should come in many files.  ``fields`` is the number
    of columns; without it the first line tells."""
    reader = spark.read.options(header=header, multiLine=multiline, quote=quote, escape=quote, **options)
    if fields is None:
        fields = len(reader.csv(path).columns)
    schema = ", ".join(f"c{i} STRING" for i in range(fields)) + f", {CORRUPT} STRING"
    return reader.schema(schema).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True).csv(path)


def record_field(index: int) -> Column:
    """The ``index``-th field of the records of ``read_call_records``."""
    return F.col(f"c{index}")


def field(line: Column | str, index: int, sep: str = ",") -> Column:
    """The ``index``-th field of a plain ``sep``-split line (NULL when the line is short)."""
    col = F.col(line) if isinstance(line, str) else line
    return F.get(F.split(col, sep), index)


def csv_field(line: Column | str, index: int, sep: str = ",") -> Column:
    """The ``index``-th field of a CSV line, quote-aware (a quoted separator
    stays inside its field); NULL when the line is short.  Built-in
    ``from_csv``, so it runs on a column of lines without a file reader."""
    col = F.col(line) if isinstance(line, str) else line
    schema = ", ".join(f"c{i} STRING" for i in range(index + 1))
    return F.from_csv(col, schema, {"sep": sep}).getField(f"c{index}")


def parse_calls(
    lines: DataFrame,
    time_col: Column,
    pattern: str = CALL_TIME_PATTERN,
    keep: list[Column] | None = None,
    zone_label: str | None = None,
) -> DataFrame:
    """Parse the call time, add its day of week (1 = Sunday) and its text form
    (``zone_label``: see ``timestamp_text``).  Lines whose time does not parse
    (header, junk, 13th month) are dropped."""
    ts = parse_call_time(time_col, pattern)
    out = lines.select(*(keep or []), ts.alias("call_time"))
    # Drop unparsed lines with a generator instead of a filter: a filter on
    # the parsed column would be pushed below the projection and parse every
    # line twice; an empty/NULL array simply yields no row.
    names = out.columns
    kept = out.select(
        F.inline(F.when(F.col("call_time").isNotNull(), F.array(F.struct(*[F.col(f"`{c}`") for c in names]))))
    )
    return kept.select(
        "*",
        day_of_week("call_time").cast("long").alias("day_of_week"),
        timestamp_text("call_time", zone_label).alias("call_time_text"),
    )
