"""Registered queries over the driver tables, each with DuckDB oracle SQL.

Queries run on incidents derived from ``orders JOIN customer`` (see
``blotter.sources.tables``) and on call lines derived from ``events``.  The
comparison is order-insensitive, so order is returned as data: flat rankings
carry ``rk``; nested lists are rendered as ``key:n,...`` text in list order.
Statistics are rounded to 10 decimals on both sides.

The test tables cover the years 1995-2001, so the year parameters of the
statistics (2015/2016 and 2017 in the original jobs) are 1999/2000 and 2000.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.text import safe_double, year_month
from blotter.operators import stats
from blotter.plans import jobs
from blotter.plans.accounting import accounting, job_rules
from blotter.plans.rankings import rank_all
from blotter.sources import tables
from blotter.sources.calls import csv_field, field, read_call_records, record_field

YEAR_A, YEAR_B, YEAR_ONE = 1999, 2000, 2000
KS_STANDARDIZED = (13.0, 7.2)
# Distributions that the districts of a year are compared with.
KS_CANDIDATES = [
    ("norm", KS_STANDARDIZED), ("uniform", (0.0, 26.0)), ("exponential", (0.08,)), ("lognormal", (2.3, 0.8)),
    ("weibull", (1.7, 14.0)), ("gamma", (2.5, 5.5)), ("beta", (1.5, 2.0, 0.0, 30.0)), ("student", (2.0, 13.0, 7.0)),
]
PART_SIZE = 2
PRICE_BANDWIDTH, PRICE_FACTOR = 50.0, 50.0
DIGITS = 10
P_DIGITS = 8

Query = Callable[[SparkSession, str], DataFrame]


# Fixed rule (the oracle follows it): District and Location come from the
# customer, all other fields from the order alone.
_OF_CUSTOMER = {"district", "location"}
TOP = 3


def _dirty(spark: SparkSession, sf_dir: str, years=None, customers: bool = True) -> DataFrame:
    return tables.incidents_dirty(spark, sf_dir, years, customers)


def _uses_customer(*columns: str) -> bool:
    return bool(_OF_CUSTOMER & set(columns))


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _flat(name: str) -> Query:
    joined = _uses_customer(jobs.FLAT[name].column)
    return lambda spark, sf_dir: jobs.flat_ranking(_dirty(spark, sf_dir, customers=joined), name)


def _grouped(name: str, top: int | None = None) -> Query:
    joined = _uses_customer(jobs.NESTED[name].group, jobs.NESTED[name].key)
    return lambda spark, sf_dir: jobs.grouped_ranking(_dirty(spark, sf_dir, customers=joined), name, top)


def _nested(name: str) -> Query:
    joined = _uses_customer(jobs.NESTED[name].group, jobs.NESTED[name].key)
    return lambda spark, sf_dir: jobs.nested_ranking_text(_dirty(spark, sf_dir, customers=joined), name)


def q_clean_trim_nonempty(spark, sf_dir):
    inc = _dirty(spark, sf_dir, customers=False)
    return inc.where(F.length("primary_type") > 0).select("incident_id", "primary_type")


def q_clean_canonical_district(spark, sf_dir):
    inc = tables.incidents_mixed(spark, sf_dir)
    return inc.select("incident_id", "district", "district_text")


def q_clean_safe_double(spark, sf_dir):
    inc = _dirty(spark, sf_dir)
    out = inc.select("incident_id", safe_double("district_text").alias("v"))
    return out.where(~F.isnan("v"))


def q_clean_year_month(spark, sf_dir):
    inc = _dirty(spark, sf_dir, customers=False)
    out = inc.select("incident_id", year_month("year_text", "date_text").alias("ym"))
    return out.where(F.col("ym").isNotNull())


def q_sample_district(spark, sf_dir):
    sample = stats.district_sample(_dirty(spark, sf_dir, [YEAR_A, YEAR_B]), [YEAR_A, YEAR_B])
    return sample.select("incident_id", "year", "v")


def q_sample_counts(spark, sf_dir):
    sample = stats.district_sample(_dirty(spark, sf_dir, [YEAR_A, YEAR_B]), [YEAR_A, YEAR_B])
    return stats.sample_counts(sample, YEAR_A, YEAR_B)


def _pairs(spark, sf_dir):
    sample = stats.district_sample(_dirty(spark, sf_dir, [YEAR_A, YEAR_B]), [YEAR_A, YEAR_B])
    return stats.positional_pairs(sample, YEAR_A, YEAR_B)


def q_sample_positional_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("pos", "a", "b")


def q_sample_pairs_from_documents(spark, sf_dir):
    """The same pairs by the document path: JSON text, parsed in the plan."""
    incidents = tables.incidents_from_documents(spark, sf_dir, [YEAR_A, YEAR_B])
    return stats.positional_pairs(stats.district_sample(incidents, [YEAR_A, YEAR_B]), YEAR_A, YEAR_B).select("pos", "a", "b")


def q_sample_equalized(spark, sf_dir):
    return stats.equalized_sample(_pairs(spark, sf_dir), YEAR_A, YEAR_B)


def q_sample_pairs_repeated_ids(spark, sf_dir):
    """Pairs of documents of which three share an id: equal ids are ordered by the value."""
    inc = _dirty(spark, sf_dir, [YEAR_A, YEAR_B]).withColumn("incident_id", F.expr("incident_id div 3"))
    return stats.positional_pairs(stats.district_sample(inc, [YEAR_A, YEAR_B]), YEAR_A, YEAR_B).select("pos", "a", "b")


def q_district_ks_by_day(spark, sf_dir):
    """One test for each day of the year, with p-values from the exact distribution."""
    day = F.substring_index("date_text", " ", 1).alias("day")
    sample = stats.district_sample(_dirty(spark, sf_dir, [YEAR_ONE]), YEAR_ONE, keep=[day])
    res = stats.ks_test(sample, "v", "norm", KS_STANDARDIZED, p_value="exact", by=["day"])
    return res.select("day", F.round("statistic", DIGITS).alias("statistic"), F.round("p_value", P_DIGITS).alias("p_value"), "conclusion")


def q_district_ks_distributions(spark, sf_dir):
    """The districts of a year against eight distributions, from one histogram."""
    sample = stats.district_sample(_dirty(spark, sf_dir, [YEAR_ONE]), YEAR_ONE)
    res = stats.ks_compare(sample, KS_CANDIDATES)
    p = F.format_string("%.6e", "p_value")
    return res.select("dist", F.round("statistic", DIGITS).alias("statistic"), p.alias("p_value"), "conclusion")


def q_rankings_one_scan(spark, sf_dir):
    """All ten rankings by GROUPING SETS and one layout."""
    return rank_all(_dirty(spark, sf_dir)).select("ranking", "grp", "category", "n", "rk")


def q_locations_by_district_parts(spark, sf_dir):
    """The nested lists in parts of bounded length."""
    spec = jobs.NESTED["locations_by_district"]
    parts = jobs.locations_by_district(_dirty(spark, sf_dir), part_size=PART_SIZE)
    told = jobs.ranking.nested_list_text(parts, spec.list_name, spec.item_key, jobs.COUNT_NAME)
    return parts.select(spec.group_name, "part", told.alias(spec.list_name))


def q_price_density(spark, sf_dir):
    """Kernel density of continuous values at a table of points: the prices of
    all orders at fifty times the balance of every customer."""
    prices = tables.table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("v"))
    points = tables.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("point_index"), (F.col("c_acctbal") * PRICE_FACTOR).alias("point"))
    out = stats.kernel_density(prices, points, PRICE_BANDWIDTH)
    return out.select("point_index", "point", F.round(F.col("density") * 1e6, 8).alias("density_per_million"))


def _years_of(name: str) -> list[int]:
    return [YEAR_A, YEAR_B] if name == "district_correlation" else [YEAR_ONE]


def q_job_accounting(spark, sf_dir):
    """Documents read, kept and dropped by which rule, for every incident job, in one pass."""
    return accounting(_dirty(spark, sf_dir), {name: job_rules(name, _years_of(name)) for name in jobs.JOBS})


def q_calls_csv_records(spark, sf_dir):
    """Call records with a header and line breaks inside quotes, through the CSV reader."""
    records = read_call_records(spark, tables.call_record_files(spark, sf_dir), header=True, multiline=True)
    out = jobs.calls_day_of_week(records, keep=[record_field(0).try_cast("long").alias("event_id"), record_field(1).alias("note")])
    return out.select("event_id", "note", "day_of_week")


def _rounded_corr(method: str) -> Query:
    def run(spark, sf_dir):
        out = jobs.district_correlation(_dirty(spark, sf_dir, [YEAR_A, YEAR_B]), YEAR_A, YEAR_B, method)
        return out.select(F.round("r", DIGITS).alias("r"), "n")

    return run


def q_district_density(spark, sf_dir):
    out = jobs.district_density(_dirty(spark, sf_dir, [YEAR_ONE]), YEAR_ONE)
    return out.select("point_index", "point", F.round("density", DIGITS).alias("density"))


def q_district_density_report(spark, sf_dir):
    """The printed lines; the number is written with a fixed number of digits,
    as the last digits of a sum depend on its order."""
    out = jobs.district_density(_dirty(spark, sf_dir, [YEAR_ONE]), YEAR_ONE)
    number = F.format_string(f"%.{DIGITS}f", F.round("density", DIGITS))
    label = F.concat(F.substring_index("label", stats.DENSITY_LABEL_SEPARATOR, 1), F.lit(stats.DENSITY_LABEL_SEPARATOR), number)
    return out.select("point_index", label.alias("label"))


def q_district_correlation_report(spark, sf_dir):
    out = jobs.district_correlation(_dirty(spark, sf_dir, [YEAR_A, YEAR_B]), YEAR_A, YEAR_B)
    number = F.format_string(f"%.{DIGITS}f", F.round("r", DIGITS))
    prefix = F.substring("report", 1, len(stats.CORRELATION_REPORT_PREFIX))
    return out.select(F.concat(prefix, number).alias("report"))


def _ks(params) -> Query:
    """Statistic, p-value (as text with six digits: it may be very small) and conclusion."""

    def run(spark, sf_dir):
        inc = _dirty(spark, sf_dir, [YEAR_ONE])
        sample = stats.district_sample(inc, YEAR_ONE)
        res = stats.ks_test(sample, "v", "norm", params)
        p = F.format_string("%.6e", "p_value")
        return res.select(F.round("statistic", DIGITS).alias("statistic"), p.alias("p_value"), "conclusion")

    return run


def q_calls_day_of_week(spark, sf_dir):
    lines = tables.call_lines(spark, sf_dir)
    out = jobs.calls_day_of_week(lines, keep=[field("value", 0).try_cast("long").alias("event_id")])
    return out.select("event_id", "day_of_week")


def q_calls_day_of_week_quoted(spark, sf_dir):
    lines = tables.call_lines_quoted(spark, sf_dir)
    out = jobs.calls_day_of_week(lines, keep=[csv_field("value", 0).try_cast("long").alias("event_id")], quoted=True)
    return out.select("event_id", "day_of_week")


def q_calls_timestamp_text(spark, sf_dir):
    # The event times of the driver tables are UTC wall-clock times; naming the
    # zone keeps the text independent of the session time zone.
    lines = tables.call_lines(spark, sf_dir)
    out = jobs.calls_day_of_week(lines, keep=[field("value", 0).try_cast("long").alias("event_id")], zone_label="UTC")
    return out.select("event_id", F.col("call_time_text").alias("text"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in jobs.FLAT:
        q[name] = _flat(name)
    for name in jobs.NESTED:
        q[name] = _grouped(name)
        q[f"{name}_nested"] = _nested(name)
    q.update(
        {
            "clean_trim_nonempty": q_clean_trim_nonempty,
            "clean_canonical_district": q_clean_canonical_district,
            "clean_safe_double": q_clean_safe_double,
            "clean_year_month": q_clean_year_month,
            "sample_district": q_sample_district,
            "sample_counts": q_sample_counts,
            "crimes_by_district_top": _grouped("crimes_by_district", TOP),
            "sample_positional_pairs": q_sample_positional_pairs,
            "sample_pairs_from_documents": q_sample_pairs_from_documents,
            "sample_pairs_repeated_ids": q_sample_pairs_repeated_ids,
            "sample_equalized": q_sample_equalized,
            "district_correlation": _rounded_corr("pearson"),
            "district_correlation_spearman": _rounded_corr("spearman"),
            "district_correlation_report": q_district_correlation_report,
            "district_density": q_district_density,
            "district_density_report": q_district_density_report,
            "district_ks": _ks((0.0, 1.0)),
            "district_ks_standardized": _ks(KS_STANDARDIZED),
            "district_ks_by_day": q_district_ks_by_day,
            "district_ks_distributions": q_district_ks_distributions,
            "rankings_one_scan": q_rankings_one_scan,
            "locations_by_district_parts": q_locations_by_district_parts,
            "price_density": q_price_density,
            "job_accounting": q_job_accounting,
            "calls_csv_records": q_calls_csv_records,
            "calls_day_of_week": q_calls_day_of_week,
            "calls_day_of_week_quoted": q_calls_day_of_week_quoted,
            "calls_timestamp_text": q_calls_timestamp_text,
        }
    )
    return q


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

# Java-style trim: strip U+0000..U+0020 at both ends.
_JTRIM = r"regexp_replace({c}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_DATE_FMT = "'%m/%d/%Y %I:%M:%S %p'"


def _jtrim(c: str) -> str:
    return _JTRIM.format(c=c)


_SRC = """src AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, c_nationkey, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_SRC_ORDERS = """src AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
         CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS VARCHAR) AS c_mktsegment
  FROM orders)"""

_RAW = f"""raw AS (
  SELECT o_orderkey AS incident_id,
    CASE WHEN o_orderkey%89=0 THEN '' WHEN o_orderkey%83=0 THEN concat(chr(9), o_orderpriority, ' ')
         WHEN o_orderkey%79=0 THEN NULL WHEN o_orderkey%73=0 THEN 'A|B' ELSE o_orderpriority END AS t_raw,
    CASE WHEN o_orderkey%101=0 THEN '' WHEN o_orderkey%103=0 THEN 'abc' WHEN o_orderkey%107=0 THEN '-1'
         WHEN o_orderkey%109=0 THEN NULL WHEN o_orderkey%113=0 THEN concat('0', CAST(c_nationkey+1 AS VARCHAR))
         WHEN o_orderkey%127=0 THEN 'NaN' ELSE CAST(c_nationkey+1 AS VARCHAR) END AS d_raw,
    CASE WHEN o_orderkey%71=0 THEN '   ' ELSE c_mktsegment END AS l_raw,
    CASE WHEN o_orderstatus='F' THEN 'true' ELSE 'false' END AS a_raw,
    CASE WHEN o_orderkey%67=0 THEN 'no date' ELSE strftime(o_orderdate, {_DATE_FMT}) END AS dt_raw,
    CASE WHEN o_orderkey%61=0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS y_raw
  FROM src),
inc AS (
  SELECT incident_id,
    {_jtrim('t_raw')} AS primary_type,
    d_raw AS district,
    d_raw AS district_text,
    {_jtrim('l_raw')} AS location,
    {_jtrim('a_raw')} AS arrest,
    {_jtrim('dt_raw')} AS date_text,
    CAST(y_raw AS VARCHAR) AS year_text,
    y_raw AS year
  FROM raw)"""

_DIRTY = f"{_SRC},\n{_RAW}"
_DIRTY_ORDERS = f"{_SRC_ORDERS},\n{_RAW}"


def _dirty_sql(*columns: str) -> str:
    return _DIRTY if _uses_customer(*columns) else _DIRTY_ORDERS


_MIXED = f"""{_SRC},
inc AS (
  SELECT o_orderkey AS incident_id,
    CASE WHEN o_orderkey%131=0 THEN '3000000000' WHEN o_orderkey%137=0 THEN '-3000000000'
         WHEN o_orderkey%139=0 THEN '12345678901234567890123' WHEN o_orderkey%149=0 THEN '-10000000000'
         WHEN o_orderkey%3=2 AND c_nationkey+1 < 10 THEN '0' || CAST(c_nationkey+1 AS VARCHAR)
         ELSE CAST(c_nationkey+1 AS VARCHAR) END AS district,
    CASE WHEN o_orderkey%131=0 THEN '3000000000' WHEN o_orderkey%137=0 THEN '-3000000000.75'
         WHEN o_orderkey%139=0 THEN '12345678901234567890123' WHEN o_orderkey%149=0 THEN '-1.0E10'
         WHEN o_orderkey%3=0 THEN CAST(c_nationkey+1 AS VARCHAR)
         WHEN o_orderkey%3=1 THEN CAST(c_nationkey+1 AS VARCHAR) || '.25'
         WHEN c_nationkey+1 < 10 THEN '0' || CAST(c_nationkey+1 AS VARCHAR)
         ELSE CAST(c_nationkey+1 AS VARCHAR) END AS district_text
  FROM src)"""

_MONTH = "CASE WHEN instr(date_text, '/') > 0 THEN split_part(date_text, '/', 1) END"
_YM = f"(year_text || '/' || {_MONTH})"

_SAMPLE = f"""{_DIRTY},
num AS (SELECT incident_id, year, coalesce(TRY_CAST(district_text AS DOUBLE), -1.0) AS v FROM inc),
s AS (SELECT incident_id, year, v FROM num WHERE year IN ({{years}}) AND v >= 0 AND NOT isnan(v))"""

_PAIRS = (
    _SAMPLE.format(years=f"{YEAR_A}, {YEAR_B}")
    + f""",
p AS (SELECT year, v, row_number() OVER (PARTITION BY year ORDER BY incident_id) AS pos FROM s),
pairs AS (SELECT x.pos AS pos, x.v AS a, y.v AS b FROM p x JOIN p y ON x.pos = y.pos
          WHERE x.year = {YEAR_A} AND y.year = {YEAR_B})"""
)


def _flat_sql(name: str) -> str:
    spec = jobs.FLAT[name]
    direction = "DESC" if spec.direction == "desc" else "ASC"
    c = spec.column
    return f"""WITH {_dirty_sql(c)}
SELECT {c} AS {spec.key_name}, count(*) AS {spec.count_name},
       row_number() OVER (ORDER BY count(*) {direction}, {c} ASC) AS rk
FROM inc WHERE length({c}) > 0 GROUP BY {c}"""


def _group_expr(spec) -> tuple[str, str]:
    if spec.group == "year_month":
        return _YM, "length(year_text) > 0"
    return spec.group, "TRUE"


def _grouped_counts_sql(name: str) -> str:
    spec = jobs.NESTED[name]
    g, extra = _group_expr(spec)
    return f"""WITH {_dirty_sql(spec.group, spec.key)},
base AS (SELECT {g} AS g, {spec.key} AS k FROM inc WHERE {extra}),
cnt AS (SELECT g, k, count(*) AS n FROM base WHERE length(g) > 0 AND length(k) > 0 GROUP BY g, k)"""


def _grouped_sql(name: str) -> str:
    spec = jobs.NESTED[name]
    return f"""{_grouped_counts_sql(name)}
SELECT g AS {spec.group_name}, k AS {spec.item_key}, n AS NumberOfEvents,
       row_number() OVER (PARTITION BY g ORDER BY n DESC, k ASC) AS rk
FROM cnt"""


def _nested_sql(name: str) -> str:
    spec = jobs.NESTED[name]
    return f"""{_grouped_counts_sql(name)}
SELECT g AS {spec.group_name},
       string_agg(k || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, k ASC) AS {spec.list_name}
FROM cnt GROUP BY g"""


def _phi(z: str) -> str:
    """Standard normal CDF by its Taylor series (DuckDB has no erf)."""
    series = (
        f"(SELECT sum(exp((2*k+1)*ln(abs({z})) - (lgamma(2*k+2) - k*ln(2) - lgamma(k+1)))) "
        f"FROM range(0, 150) t(k))"
    )
    return (
        f"CASE WHEN abs({z}) < 1e-300 THEN 0.5 WHEN {z} > 8 THEN 1.0 WHEN {z} < -8 THEN 0.0 "
        f"ELSE 0.5 + sign({z}) * exp(-({z})*({z})/2) / sqrt(2*pi()) * {series} END"
    )


_TAIL = " + ".join(f"({2.0 if j % 2 else -2.0}) * exp({-2.0 * j * j} * x * x)" for j in range(1, 7))
_HEAD = " + ".join(f"exp({-((2 * j - 1) ** 2)} * pi() * pi() / 8 / (x * x))" for j in range(1, 5))
# The p-value of the limiting distribution from the statistic d of n values.
_P_LIMIT = f"""z AS (SELECT {{keys}}d, n, sqrt(n) * d AS z, sqrt(n) * d + 1 / (6 * sqrt(n)) AS y FROM d),
x AS (SELECT {{keys}}d, sqrt(greatest(0.0, 2 * y * y + (4.0::DOUBLE / 9 * z * z * (z * z - 1) - 1.0::DOUBLE / 18) / n) / 2) AS x FROM z),
p AS (SELECT {{keys}}d, least(1.0, greatest(0.0, CASE WHEN x >= 1 THEN {_TAIL} ELSE 1 - sqrt(2 * pi()) / x * ({_HEAD}) END)) AS p FROM x)"""


def _ks_sql(mean: float, sd: float) -> str:
    z = f"((v - {mean}) / {sd})"
    very, strong, low, none = stats.KS_CONCLUSIONS
    return (
        _SAMPLE.format(years=str(YEAR_ONE))
        + f""",
h AS (SELECT v, count(*) AS c FROM s GROUP BY v),
cum AS (SELECT v, c, sum(c) OVER (ORDER BY v) AS cu, sum(c) OVER () AS n FROM h),
f AS (SELECT v, c, cu, n, {_phi(z)} AS cdf FROM cum),
d AS (SELECT max(greatest(cu / n - cdf, cdf - (cu - c) / n)) AS d, max(n)::DOUBLE AS n FROM f),
{_P_LIMIT.format(keys='')}
SELECT round(d, {DIGITS}) AS statistic, printf('%.6e', p) AS p_value,
       CASE WHEN p <= 0.01 THEN '{very}' WHEN p <= 0.05 THEN '{strong}' WHEN p <= 0.1 THEN '{low}' ELSE '{none}' END
       || ': {stats.KS_NULL_HYPOTHESIS}.' AS conclusion
FROM p"""
    )


def _conclusion_sql(p: str) -> str:
    very, strong, low, none = stats.KS_CONCLUSIONS
    return (
        f"CASE WHEN {p} <= 0.01 THEN '{very}' WHEN {p} <= 0.05 THEN '{strong}' WHEN {p} <= 0.1 THEN '{low}' ELSE '{none}' END "
        f"|| ': {stats.KS_NULL_HYPOTHESIS}.'"
    )


def _ks_by_day_sql(mean: float, sd: float) -> str:
    """The p-value is one less the volume between the boundaries of the order
    statistics, n! det(M) with M_ij = max(0, b_i - a_j)^(j-i+1) / (j-i+1)!, whose
    determinant grows column by column: another method than the query's."""
    z = f"((v - {mean}) / {sd})"
    column = (
        "list_sum([(CASE WHEN (j + 1 - i) % 2 = 0 THEN 1.0 ELSE -1.0 END) * dets[i] / gamma(j + 3 - i)"
        " * pow(greatest(0.0, least(1.0, (i - 1) / n + d) - greatest(0.0, (j + 1) / n - d)), j + 2 - i) FOR i IN range(1, j + 2)])"
    )
    return (
        _SAMPLE.format(years=str(YEAR_ONE)).replace("WITH ", "", 1)
        + f""",
days AS (SELECT split_part(date_text, ' ', 1) AS day, s.v FROM s JOIN inc USING (incident_id)),
h AS (SELECT day, v, count(*) AS c FROM days GROUP BY day, v),
cum AS (SELECT day, v, c, sum(c) OVER (PARTITION BY day ORDER BY v) AS cu, sum(c) OVER (PARTITION BY day) AS n FROM h),
f AS (SELECT day, v, c, cu, n, {_phi(z)} AS cdf FROM cum),
d AS (SELECT day, max(greatest(cu / n - cdf, cdf - (cu - c) / n)) AS d, max(n)::DOUBLE AS n FROM f GROUP BY day),
steps(day, d, n, j, dets) AS (
  SELECT day, d, n, 0::BIGINT, [1.0::DOUBLE] FROM d
  UNION ALL
  SELECT day, d, n, j + 1, list_append(dets, {column}) FROM steps WHERE j < n),
p AS (SELECT day, d, 1 - gamma(n + 1) * dets[n::BIGINT + 1] AS p FROM steps WHERE j = n)
SELECT day, round(d, {DIGITS}) AS statistic, round(p, {P_DIGITS}) AS p_value, {_conclusion_sql('p')} AS conclusion FROM p"""
    )


def _ks_distributions_sql() -> str:
    """Every distribution function by a closed form, or a series other than the query's."""
    (mean, sd), (low, high), (rate,), (mu, sigma), (k, scale), (shape, theta), (a, b, left, right), (_, centre, width) = [p for _, p in KS_CANDIDATES]
    assert b == 2.0 and KS_CANDIDATES[-1][1][0] == 2.0  # the closed forms below
    y, t = f"(least(1.0, greatest(0.0, (v - {left}) / {right - left})))", f"((v - {centre}) / {width})"
    gamma = f"(SELECT sum(exp(({shape} + k) * ln(v / {theta}) - v / {theta} - lgamma({shape} + k + 1))) FROM range(0, 120) t(k))"
    cdf = {
        "norm": _phi(f"((v - {mean}) / {sd})"),
        "uniform": f"least(1.0, greatest(0.0, (v - {low}) / {high - low}))",
        "exponential": f"1 - exp(-{rate} * v)",
        "lognormal": f"CASE WHEN v <= 0 THEN 0.0 ELSE {_phi(f'((ln(v) - {mu}) / {sigma})')} END",
        "weibull": f"1 - exp(-pow(v / {scale}, {k}))",
        "gamma": f"CASE WHEN v <= 0 THEN 0.0 ELSE {gamma} END",
        "beta": f"pow({y}, {a}) * (1 + {a} - {a} * {y})",
        "student": f"0.5 + {t} / (2 * sqrt(2 + {t} * {t}))",
    }
    each = " UNION ALL ".join(f"SELECT '{name}' AS dist, c, cu, n, CAST({f} AS DOUBLE) AS cdf FROM cum" for name, f in cdf.items())
    return (
        _SAMPLE.format(years=str(YEAR_ONE))
        + f""",
h AS (SELECT v, count(*) AS c FROM s GROUP BY v),
cum AS (SELECT v, c, sum(c) OVER (ORDER BY v) AS cu, sum(c) OVER () AS n FROM h),
f AS ({each}),
d AS (SELECT dist, max(greatest(cu / n - cdf, cdf - (cu - c) / n)) AS d, max(n)::DOUBLE AS n FROM f GROUP BY dist),
{_P_LIMIT.format(keys='dist, ')}
SELECT dist, round(d, {DIGITS}) AS statistic, printf('%.6e', p) AS p_value, {_conclusion_sql('p')} AS conclusion FROM p"""
    )


def _one_scan_sql() -> str:
    parts = []
    for name, spec in jobs.FLAT.items():
        sign = "-" if spec.direction == "desc" else ""
        parts.append(f"""SELECT '{name}' AS ranking, CAST(NULL AS VARCHAR) AS grp, {spec.column} AS category, count(*) AS n,
  row_number() OVER (ORDER BY {sign}count(*), {spec.column}) AS rk FROM inc WHERE length({spec.column}) > 0 GROUP BY {spec.column}""")
    for name, spec in jobs.NESTED.items():
        g, extra = _group_expr(spec)
        parts.append(f"""SELECT '{name}' AS ranking, g AS grp, k AS category, count(*) AS n, row_number() OVER (PARTITION BY g ORDER BY -count(*), k) AS rk
  FROM (SELECT {g} AS g, {spec.key} AS k FROM inc WHERE {extra}) WHERE length(g) > 0 AND length(k) > 0 GROUP BY g, k""")
    return f"WITH {_DIRTY}\n" + "\nUNION ALL\n".join(parts)


def _parts_sql(name: str) -> str:
    spec = jobs.NESTED[name]
    return f"""SELECT {spec.group_name}, (rk - 1) // {PART_SIZE} AS part,
       string_agg({spec.item_key} || ':' || CAST(NumberOfEvents AS VARCHAR), ',' ORDER BY rk) AS {spec.list_name}
FROM ({_grouped_sql(name)}) GROUP BY ALL"""


def _accounting_sql() -> str:
    def text(name: str, column: str) -> list[tuple[str, str]]:
        return [(f"missing {name}", f"{column} IS NULL"), (f"blank {name}", f"length({column}) = 0")]

    def rules(name: str) -> list[tuple[str, str]]:
        if name in jobs.FLAT:
            return text(jobs.FLAT[name].column, jobs.FLAT[name].column)
        if name in jobs.NESTED:
            spec = jobs.NESTED[name]
            if spec.group == "year_month":
                group = [*text("year", "year_text"), ("date without month", "date_text IS NULL OR instr(date_text, '/') = 0")]
            else:
                group = text(spec.group, spec.group)
            return [*group, *text(spec.key, spec.key)]
        years = ", ".join(map(str, _years_of(name)))
        number = "TRY_CAST(district_text AS DOUBLE)"
        return [
            ("missing year", "year IS NULL"),
            ("other year", f"year NOT IN ({years})"),
            ("district is no number", f"{number} IS NULL OR isnan({number})"),
            ("negative district", f"{number} < 0"),
        ]

    parts = []
    for job in jobs.JOBS:
        own = rules(job)
        outcome = "CASE " + " ".join(f"WHEN {cond} THEN '{rule}'" for rule, cond in own) + " ELSE 'kept' END"
        for rule in (*(r for r, _ in own), "kept"):
            parts.append(f"SELECT '{job}' AS job, '{rule}' AS rule, count(*) FILTER (WHERE {outcome} = '{rule}') AS documents FROM inc")
        parts.append(f"SELECT '{job}' AS job, 'read' AS rule, count(*) AS documents FROM inc")
    return f"WITH {_DIRTY}\n" + "\nUNION ALL\n".join(parts)


_CALLS = f"""lines AS (
  SELECT concat_ws(',', CAST(event_id AS VARCHAR), event_type, CAST(user_id AS VARCHAR), CAST(value AS VARCHAR),
                   'x', 'x', 'x', strftime(ts, {_DATE_FMT})) AS line FROM events),
parsed AS (
  SELECT TRY_CAST(split_part(line, ',', 1) AS BIGINT) AS event_id,
         try_strptime(split_part(line, ',', 8), {_DATE_FMT}) AS t FROM lines)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for name in jobs.FLAT:
        sql[name] = _flat_sql(name)
    for name in jobs.NESTED:
        sql[name] = _grouped_sql(name)
        sql[f"{name}_nested"] = _nested_sql(name)
    sql["clean_trim_nonempty"] = f"""WITH {_DIRTY_ORDERS}
SELECT incident_id, primary_type FROM inc WHERE length(primary_type) > 0"""
    sql["clean_canonical_district"] = f"""WITH {_MIXED}
SELECT incident_id, district, district_text FROM inc"""
    sql["clean_safe_double"] = f"""WITH {_DIRTY},
num AS (SELECT incident_id, coalesce(TRY_CAST(district_text AS DOUBLE), -1.0) AS v FROM inc)
SELECT incident_id, v FROM num WHERE NOT isnan(v)"""
    sql["clean_year_month"] = f"""WITH {_DIRTY_ORDERS}
SELECT incident_id, {_YM} AS ym FROM inc WHERE {_YM} IS NOT NULL"""
    sql["sample_district"] = "WITH " + _SAMPLE.format(years=f"{YEAR_A}, {YEAR_B}") + "\nSELECT incident_id, year, v FROM s"
    sql["sample_counts"] = "WITH " + _SAMPLE.format(years=f"{YEAR_A}, {YEAR_B}") + f"""
SELECT count(*) FILTER (WHERE year = {YEAR_A}) AS n_a, count(*) FILTER (WHERE year = {YEAR_B}) AS n_b,
       least(count(*) FILTER (WHERE year = {YEAR_A}), count(*) FILTER (WHERE year = {YEAR_B})) AS n_min
FROM s"""
    sql["crimes_by_district_top"] = f"SELECT * FROM ({_grouped_sql('crimes_by_district')}) WHERE rk <= {TOP}"
    sql["sample_pairs_from_documents"] = "WITH " + _PAIRS + "\nSELECT pos, a, b FROM pairs"
    sql["sample_pairs_repeated_ids"] = "WITH " + _PAIRS.replace("ORDER BY incident_id", "ORDER BY incident_id // 3, v") + "\nSELECT pos, a, b FROM pairs"
    sql["district_ks_by_day"] = "WITH RECURSIVE " + _ks_by_day_sql(*KS_STANDARDIZED)
    sql["job_accounting"] = _accounting_sql()
    sql["district_ks_distributions"] = "WITH " + _ks_distributions_sql()
    sql["rankings_one_scan"] = _one_scan_sql()
    sql["locations_by_district_parts"] = _parts_sql("locations_by_district")
    sql["price_density"] = f"""WITH p AS (SELECT c_custkey AS point_index, c_acctbal * {PRICE_FACTOR}::DOUBLE AS point FROM customer),
h AS (SELECT o_totalprice AS v, count(*) AS c FROM orders GROUP BY ALL),
k AS (SELECT point_index, point, sum(c * exp(-0.5::DOUBLE * pow((point - v) / {PRICE_BANDWIDTH}::DOUBLE, 2))) / (sum(c) * {PRICE_BANDWIDTH}::DOUBLE * sqrt(2 * pi())) AS density
      FROM p, h GROUP BY ALL)
SELECT point_index, point, round(density * 1e6::DOUBLE, 8) AS density_per_million FROM k"""
    sql["calls_csv_records"] = f"""WITH parsed AS (
  SELECT event_id, event_type || chr(10) || '"' || user_id || '", x' AS note, try_strptime(strftime(ts, {_DATE_FMT}), {_DATE_FMT}) AS t
  FROM events WHERE event_id % 97 <> 0)
SELECT event_id, note, CAST(dayofweek(t) + 1 AS BIGINT) AS day_of_week FROM parsed WHERE t IS NOT NULL"""
    sql["sample_positional_pairs"] = "WITH " + _PAIRS + "\nSELECT pos, a, b FROM pairs"
    sql["sample_equalized"] = "WITH " + _PAIRS + f"""
SELECT {YEAR_A} AS year, pos, a AS v FROM pairs UNION ALL SELECT {YEAR_B} AS year, pos, b AS v FROM pairs"""
    sql["district_correlation"] = "WITH " + _PAIRS + f"""
SELECT round(corr(a, b), {DIGITS}) AS r, count(*) AS n FROM pairs"""
    sql["district_correlation_spearman"] = "WITH " + _PAIRS + f""",
ranked AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
                  rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM pairs)
SELECT round(corr(ra, rb), {DIGITS}) AS r, count(*) AS n FROM ranked"""
    sql["district_density"] = "WITH " + _SAMPLE.format(years=str(YEAR_ONE)) + f""",
pts AS (SELECT CAST(i AS INTEGER) AS point_index, CAST(i AS DOUBLE) AS point FROM range(1, 26) t(i)),
h AS (SELECT v, count(*) AS c FROM s GROUP BY v)
SELECT point_index, point,
       round(sum(c * exp(-0.5 * (point - v) * (point - v))) / (sum(c) * sqrt(2 * pi())), {DIGITS}) AS density
FROM pts, h GROUP BY point_index, point"""
    sql["district_correlation_report"] = "WITH " + _PAIRS + f"""
SELECT '{stats.CORRELATION_REPORT_PREFIX}' || printf('%.{DIGITS}f', round(corr(a, b), {DIGITS})) AS report FROM pairs"""
    sql["district_density_report"] = f"""
SELECT point_index, '{stats.DENSITY_LABEL_PREFIX}' || point_index || '{stats.DENSITY_LABEL_SEPARATOR}'
       || printf('%.{DIGITS}f', density) AS label
FROM ({sql['district_density']})"""
    sql["district_ks"] = "WITH " + _ks_sql(0.0, 1.0)
    sql["district_ks_standardized"] = "WITH " + _ks_sql(*KS_STANDARDIZED)
    sql["calls_day_of_week"] = f"""WITH {_CALLS}
SELECT event_id, CAST(dayofweek(t) + 1 AS BIGINT) AS day_of_week FROM parsed WHERE t IS NOT NULL"""
    # The quoted field does not change the answer: the time of every event.
    sql["calls_day_of_week_quoted"] = f"""WITH parsed AS (
  SELECT event_id, try_strptime(strftime(ts, {_DATE_FMT}), {_DATE_FMT}) AS t FROM events)
SELECT event_id, CAST(dayofweek(t) + 1 AS BIGINT) AS day_of_week FROM parsed WHERE t IS NOT NULL"""
    sql["calls_timestamp_text"] = f"""WITH {_CALLS}
SELECT event_id, strftime(t, '%a %b %d %H:%M:%S') || ' UTC ' || strftime(t, '%Y') AS text
FROM parsed WHERE t IS NOT NULL"""
    return sql
