"""Parsing call timestamps and calendar fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The call log writes times as MM/dd/yyyy hh:mm:ss a.  The
# one-letter form of the pattern also accepts one-digit month/day/hour.
CALL_TIME_PATTERN = "M/d/yyyy h:mm:ss a"
DATE_TEXT_PATTERN = "MM/dd/yyyy hh:mm:ss a"
# Fixed value: the text form of a java.util.Date (Date.toString()).
JAVA_DATE_TEXT = "EEE MMM dd HH:mm:ss zzz yyyy"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_call_time(text: Column | str, pattern: str = CALL_TIME_PATTERN) -> Column:
    """Timestamp in the session time zone; NULL for text that does not parse."""
    return F.try_to_timestamp(_c(text), F.lit(pattern))


def day_of_week(ts: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday (java.util.Calendar numbering)."""
    return F.dayofweek(_c(ts))


def timestamp_text(ts: Column | str, zone_label: str | None = None) -> Column:
    """The timestamp written the way java.util.Date prints itself, in the
    session time zone.  ``zone_label`` names the zone explicitly instead (for
    times recorded in a known zone), so the text does not depend on the
    session setting."""
    if zone_label is None:
        return F.date_format(_c(ts), JAVA_DATE_TEXT)
    return F.concat(
        F.date_format(_c(ts), "EEE MMM dd HH:mm:ss "), F.lit(zone_label), F.date_format(_c(ts), " yyyy")
    )
