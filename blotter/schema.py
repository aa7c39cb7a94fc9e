"""Declared schemas of the incident documents and of the cleaned table."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the incident documents.
F_TYPE = "Primary Type"
F_DISTRICT = "District"
F_LOCATION = "Location Description"
F_ARREST = "Arrest"
F_DATE = "Date"
F_YEAR = "Year"
F_ID = "incident_id"

# District and Year hold a number in some documents and text in others: a
# VARIANT keeps the difference (12.0 the number vs "12.0" the text).
RAW_INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField(F_ID, T.LongType()),
        T.StructField(F_TYPE, T.StringType()),
        T.StructField(F_DISTRICT, T.VariantType()),
        T.StructField(F_LOCATION, T.StringType()),
        T.StructField(F_ARREST, T.StringType()),
        T.StructField(F_DATE, T.StringType()),
        T.StructField(F_YEAR, T.VariantType()),
    ]
)

# Where a document stands in its input: file, start of the split, row of the
# split's task.  The order of these three does not depend on the split size.
POSITION = "__position"
POSITION_TYPE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)

CLEAN_INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_id", T.LongType()),
        T.StructField("position", POSITION_TYPE),
        T.StructField("primary_type", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("district_text", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("arrest", T.StringType()),
        T.StructField("date_text", T.StringType()),
        T.StructField("year_text", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)
