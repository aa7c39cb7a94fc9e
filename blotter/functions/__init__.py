"""Column expressions; every function returns a ``pyspark.sql.Column``."""

from blotter.functions.text import (
    JAVA_BLANKS,
    canonical_text,
    java_trim,
    month_prefix,
    non_empty,
    safe_double,
    source_text,
    year_month,
)
from blotter.functions.calendar import (
    CALL_TIME_PATTERN,
    DATE_TEXT_PATTERN,
    day_of_week,
    parse_call_time,
    timestamp_text,
)

__all__ = [
    "JAVA_BLANKS",
    "canonical_text",
    "java_trim",
    "month_prefix",
    "non_empty",
    "safe_double",
    "source_text",
    "year_month",
    "CALL_TIME_PATTERN",
    "DATE_TEXT_PATTERN",
    "day_of_week",
    "parse_call_time",
    "timestamp_text",
]
