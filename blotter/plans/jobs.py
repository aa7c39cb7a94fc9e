"""The fourteen incident jobs as parameterised DataFrame functions.

Every job takes a cleaned incident DataFrame (``blotter.sources.clean_incidents``)
or call lines, plus its parameters, and returns a DataFrame whose field names
follow the documents the original programs wrote; flat rankings add a rank
unless ``rank_col`` is None.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.calendar import CALL_TIME_PATTERN
from blotter.functions.text import month_prefix, non_empty
from blotter.operators import ranking, stats
from blotter.sources.calls import csv_field, field, parse_calls, record_field

# --------------------------------------------------------------------------
# Flat rankings
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class FlatSpec:
    column: str
    key_name: str
    count_name: str
    direction: str


# Output field names and sort direction of the flat rankings.
FLAT = {
    "top_crimes": FlatSpec("primary_type", "TypeOfCrime", "NumberOfEvents", ranking.DESC),
    "top_arrest_status": FlatSpec("arrest", "Arrest", "NumberOfCrimes", ranking.DESC),
    "top_locations": FlatSpec("location", "TypeOfLocation", "NumberOfEvents", ranking.ASC),
    "top_districts": FlatSpec("district", "DistrictNumber", "NumberOfEvents", ranking.DESC),
}


def flat_ranking(incidents: DataFrame, name: str, top: int | None = None, rank_col: str | None = "rk") -> DataFrame:
    spec = FLAT[name]
    out = ranking.ranked_counts(
        incidents.select(F.col(spec.column).alias(spec.key_name)),
        spec.key_name,
        direction=spec.direction,
        count_col=spec.count_name,
        rank_col=rank_col,
        top=top,
    )
    cols = [spec.key_name, spec.count_name] + ([rank_col] if rank_col else [])
    return out.select(*cols)


def top_crimes(incidents: DataFrame, top: int | None = None, rank_col: str | None = "rk") -> DataFrame:
    """Incident types by number of incidents, largest first."""
    return flat_ranking(incidents, "top_crimes", top, rank_col)


def top_arrest_status(incidents: DataFrame, top: int | None = None, rank_col: str | None = "rk") -> DataFrame:
    """Incidents per arrest value (both values are counted), largest first."""
    return flat_ranking(incidents, "top_arrest_status", top, rank_col)


def top_locations(incidents: DataFrame, top: int | None = None, rank_col: str | None = "rk") -> DataFrame:
    """Location descriptions by number of incidents, smallest first."""
    return flat_ranking(incidents, "top_locations", top, rank_col)


def top_districts(incidents: DataFrame, top: int | None = None, rank_col: str | None = "rk") -> DataFrame:
    """Districts by number of incidents, largest first."""
    return flat_ranking(incidents, "top_districts", top, rank_col)


# --------------------------------------------------------------------------
# Rankings inside groups
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class NestedSpec:
    group: str
    key: str
    group_name: str
    list_name: str
    item_key: str


# Output field names of the grouped rankings.
NESTED = {
    "crimes_by_district": NestedSpec("district", "primary_type", "DistrictNumber", "ListOfCrimes", "TypeOfCrime"),
    "crimes_by_arrest": NestedSpec("arrest", "primary_type", "Arrest", "ListOfCrimes", "TypeOfCrime"),
    "crimes_by_year": NestedSpec("year_text", "primary_type", "Year", "CrimesInOrder", "TypeOfCrime"),
    "crimes_by_month": NestedSpec("year_month", "primary_type", "YearAndMonth", "CrimesInOrder", "TypeOfCrime"),
    "locations_by_district": NestedSpec("district", "location", "District", "LocationOfCrime", "Location"),
    "locations_by_crime": NestedSpec("primary_type", "location", "TypeOfCrime", "LocationOfCrime", "Location"),
}
COUNT_NAME = "NumberOfEvents"


def _grouping_input(incidents: DataFrame, spec: NestedSpec) -> DataFrame:
    if spec.group == "year_month":
        ym = F.concat(F.col("year_text"), F.lit("/"), month_prefix("date_text"))
        src = incidents.where(non_empty("year_text")).select(ym.alias(spec.group_name), F.col(spec.key).alias(spec.item_key))
    else:
        src = incidents.select(F.col(spec.group).alias(spec.group_name), F.col(spec.key).alias(spec.item_key))
    return src


def grouped_ranking(incidents: DataFrame, name: str, top: int | None = None) -> DataFrame:
    """Flat form: ``(group, key, NumberOfEvents, rk)``, rank inside each group."""
    spec = NESTED[name]
    src = _grouping_input(incidents, spec)
    out = ranking.grouped_ranked_counts(src, spec.group_name, spec.item_key, count_col=COUNT_NAME, top=top)
    return out.select(spec.group_name, spec.item_key, COUNT_NAME, "rk")


def nested_ranking(incidents: DataFrame, name: str, top: int | None = None, part_size: int | None = None) -> DataFrame:
    """Nested form: one row per group with its ordered list of {key, NumberOfEvents},
    or with ``part_size`` one row per group and part of that many entries."""
    spec = NESTED[name]
    src = _grouping_input(incidents, spec)
    if part_size is not None:
        if top is not None:
            raise ValueError("top and part_size exclude each other; keep the first parts instead")
        return ranking.nested_list_parts(
            src, spec.group_name, spec.item_key, part_size, list_name=spec.list_name, item_count=COUNT_NAME
        )
    return ranking.nested_ranked_lists(
        src, spec.group_name, spec.item_key, list_name=spec.list_name, item_count=COUNT_NAME, top=top
    )


def nested_ranking_text(incidents: DataFrame, name: str) -> DataFrame:
    """Nested form with the list rendered as ``key:n,key:n`` text."""
    spec = NESTED[name]
    lists = nested_ranking(incidents, name)
    return lists.select(
        spec.group_name, ranking.nested_list_text(lists, spec.list_name, spec.item_key, COUNT_NAME).alias(spec.list_name)
    )


def crimes_by_district(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "crimes_by_district", top, part_size)


def crimes_by_arrest(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "crimes_by_arrest", top, part_size)


def crimes_by_year(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "crimes_by_year", top, part_size)


def crimes_by_month(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "crimes_by_month", top, part_size)


def locations_by_district(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "locations_by_district", top, part_size)


def locations_by_crime(incidents: DataFrame, top: int | None = None, part_size: int | None = None) -> DataFrame:
    return nested_ranking(incidents, "locations_by_crime", top, part_size)


# --------------------------------------------------------------------------
# Statistics
# --------------------------------------------------------------------------


def district_correlation(
    incidents: DataFrame, year_a: int = 2015, year_b: int = 2016, method: str = "pearson"
) -> DataFrame:
    """Correlation of the district numbers of two years, paired by position
    (order of the ids, or of the documents in their files) and cut to the
    shorter year: one row ``(r, n, report)``."""
    sample = stats.district_sample(incidents, [year_a, year_b])
    pairs = stats.positional_pairs(sample, year_a, year_b)
    return stats.correlation(pairs, method)


def district_density(
    incidents: DataFrame,
    year: int = 2017,
    points: Sequence[float] = stats.DEFAULT_DENSITY_POINTS,
    bandwidth: float = stats.DEFAULT_BANDWIDTH,
) -> DataFrame:
    """Gaussian kernel density of the district numbers of one year at the given points."""
    return stats.kernel_density(stats.district_sample(incidents, year), points, bandwidth)


def district_ks(
    incidents: DataFrame,
    year: int = 2017,
    dist: str = "norm",
    params: Sequence[float] = (),
    method: str = "histogram",
    p_value: str = "limit",
) -> DataFrame:
    """Kolmogorov-Smirnov test of the district numbers of one year against a
    distribution (``dist`` and its ``params``, see ``stats.ks_test``); ``p_value="exact"`` for small samples."""
    return stats.ks_test(stats.district_sample(incidents, year), "v", dist, params, method, p_value)


# --------------------------------------------------------------------------
# Calls
# --------------------------------------------------------------------------


def calls_day_of_week(
    lines: DataFrame,
    time_field: int = 7,
    pattern: str = CALL_TIME_PATTERN,
    line_col: str = "value",
    keep: list[Column] | None = None,
    quoted: bool = False,
    zone_label: str | None = None,
) -> DataFrame:
    """Call time and its day of week (1 = Sunday) for every call whose time
    parses.  Lines are split on every comma, as a plain split does; with
    ``quoted`` they are read as CSV, so quoted commas stay inside their field.
    Records of ``read_call_records``, which have no column ``line_col``, are taken by position."""
    if line_col not in lines.columns:
        time_col = record_field(time_field)
    else:
        time_col = csv_field(line_col, time_field) if quoted else field(line_col, time_field)
    return parse_calls(lines, time_col, pattern, keep, zone_label)


def calls_timestamp_text(
    lines: DataFrame,
    time_field: int = 7,
    pattern: str = CALL_TIME_PATTERN,
    quoted: bool = False,
    zone_label: str | None = None,
) -> DataFrame:
    """The call time as text, one line per call (what the original program wrote)."""
    out = calls_day_of_week(lines, time_field, pattern, quoted=quoted, zone_label=zone_label)
    return out.select(F.col("call_time_text").alias("value"))


JOBS = {
    "top_crimes": top_crimes,
    "top_arrest_status": top_arrest_status,
    "top_locations": top_locations,
    "top_districts": top_districts,
    "crimes_by_district": crimes_by_district,
    "crimes_by_arrest": crimes_by_arrest,
    "crimes_by_year": crimes_by_year,
    "crimes_by_month": crimes_by_month,
    "locations_by_district": locations_by_district,
    "locations_by_crime": locations_by_crime,
    "district_correlation": district_correlation,
    "district_density": district_density,
    "district_ks": district_ks,
}
