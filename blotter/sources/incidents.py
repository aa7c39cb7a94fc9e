"""Incident documents: read them and clean them into typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter import schema as S
from blotter.functions.calendar import DATE_TEXT_PATTERN
from blotter.functions.text import canonical_text, java_trim, source_text
from blotter.sources.sinks import write_result


# Sources that read files, whose rows have a place.
FILE_FORMATS = ("json", "csv", "parquet", "orc", "text", "avro")


def read_incidents(
    spark: SparkSession,
    path: str | None,
    /,
    fmt: str = "json",
    schema: T.StructType | str | None = None,
    id_col: str | None = None,
    **options: str,
) -> DataFrame:
    """Scan an incident collection.  ``fmt`` is any Spark data source (json,
    parquet, csv, orc, or a document-store connector present on the classpath,
    configured through ``options`` with ``path=None``).  JSON gets the
    declared raw schema so District/Year keep their JSON type.

    ``id_col`` names the field that orders the documents, if they have one.
    File sources also tell where each document stands, which orders documents
    without an id."""
    reader = spark.read.format(fmt).options(**options)
    if schema is None and fmt == "json":
        schema = S.RAW_INCIDENT_SCHEMA
        if id_col is not None:
            schema = T.StructType([T.StructField(id_col, T.LongType()), *[f for f in schema.fields if f.name != S.F_ID]])
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load(path) if path is not None else reader.load()
    if fmt in FILE_FORMATS and S.F_TYPE in raw.columns:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        )
        raw = raw.select("*", place.alias(S.POSITION))
    return raw if id_col is None else raw.withColumnRenamed(id_col, S.F_ID)


def _completed(df: DataFrame, missing_ok: bool) -> DataFrame:
    """``df`` with every incident field; a missing one is an error, or NULL if that is wanted."""
    fields = (S.F_TYPE, S.F_DISTRICT, S.F_LOCATION, S.F_ARREST, S.F_DATE, S.F_YEAR)
    missing = [f for f in fields if f not in df.columns]
    if missing and not missing_ok:
        raise ValueError(f"the source has no column {', '.join(missing)}; its columns are {', '.join(df.columns)}")
    return df.withColumns({f: F.lit(None).cast("string") for f in missing}) if missing else df


def _field(name: str):
    return F.col(f"`{name}`")


def clean_incidents(raw: DataFrame, missing_ok: bool = False) -> DataFrame:
    """Raw documents -> ``CLEAN_INCIDENT_SCHEMA``.

    * text fields are stripped the way Java's ``trim`` strips them;
    * ``district`` / ``year_text`` are the number-or-text canonical form used as
      grouping keys (not trimmed: " 7 " stays " 7 ");
    * ``district_text`` is the field as its own text, input of the numeric samples;
    * ``year`` is the integer year, NULL when the field is not a whole number.

    * ``incident_id`` and ``position`` order the documents: by id where there is
      one, else by their place in the files.

    A field missing from a document is NULL (the queries drop rows whose keys
    are NULL); a column missing from the whole source is an error unless
    ``missing_ok`` is set.
    """
    raw = _completed(raw, missing_ok)
    # A typed timestamp/date column (e.g. from Parquet) gets the document's text form.
    if isinstance(raw.schema[S.F_DATE].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        date_text = F.date_format(_field(S.F_DATE), DATE_TEXT_PATTERN)
    else:
        date_text = java_trim(_field(S.F_DATE))
    year_text = canonical_text(raw, S.F_YEAR)
    ident = _field(S.F_ID).try_cast("long") if S.F_ID in raw.columns else F.lit(None).cast("long")
    place = _field(S.POSITION) if S.POSITION in raw.columns else F.lit(None)
    return raw.select(
        ident.alias("incident_id"),
        place.cast(S.POSITION_TYPE).alias("position"),
        java_trim(_field(S.F_TYPE)).alias("primary_type"),
        canonical_text(raw, S.F_DISTRICT).alias("district"),
        source_text(raw, S.F_DISTRICT).alias("district_text"),
        java_trim(_field(S.F_LOCATION)).alias("location"),
        java_trim(_field(S.F_ARREST).cast("string")).alias("arrest"),
        date_text.alias("date_text"),
        year_text.alias("year_text"),
        year_text.try_cast("int").alias("year"),
    )


def store_clean_incidents(clean: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write cleaned incidents once, partitioned by year, so later jobs read
    typed columns and the year filters of the statistics prune whole
    partitions instead of re-parsing every document.

    The rows are grouped by year with a REBALANCE hint: AQE splits a year
    that holds a large share of the rows over several tasks (and files)
    instead of one."""
    write_result(clean.hint("rebalance", "year"), path, fmt, mode, partition_by=["year"])


def read_clean_incidents(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read incidents written by ``store_clean_incidents`` (columns in the clean order)."""
    df = spark.read.format(fmt).load(path)
    return df.select(*[f.name for f in S.CLEAN_INCIDENT_SCHEMA.fields])
