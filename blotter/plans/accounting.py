"""How many documents each job read, kept, and dropped by which rule.

Malformed documents do not fail a job: it drops them.  ``job_rules`` names the
dropping rules of a job in the order in which they are tried; a document counts
under the first that holds.  ``accounted`` attaches the counts to the job's own
pass over its input (``DataFrame.observe``); ``accounting`` computes those of
several jobs in one pass of its own, as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blotter.functions.calendar import CALL_TIME_PATTERN, parse_call_time
from blotter.functions.text import month_prefix
from blotter.plans import jobs
from blotter.sources.calls import field

READ, KEPT = "read", "kept"
Rules = Sequence[tuple[str, Column]]


def _text_rules(name: str, column: Column) -> list[tuple[str, Column]]:
    return [(f"missing {name}", column.isNull()), (f"blank {name}", F.length(column) == 0)]


def _sample_rules(years: Sequence[int]) -> list[tuple[str, Column]]:
    number = F.col("district_text").try_cast("double")
    return [
        ("missing year", F.col("year").isNull()),
        ("other year", ~F.col("year").isin(list(years))),
        ("district is no number", number.isNull() | F.isnan(number)),
        ("negative district", number < 0),
    ]


def job_rules(name: str, years: Sequence[int] = ()) -> Rules:
    """The dropping rules of an incident job, over its cleaned incidents; the
    statistics need the years they look at."""
    if name in jobs.FLAT:
        column = jobs.FLAT[name].column
        return _text_rules(column, F.col(column))
    if name in jobs.NESTED:
        spec = jobs.NESTED[name]
        if spec.group == "year_month":
            group = [*_text_rules("year", F.col("year_text")), ("date without month", month_prefix("date_text").isNull())]
        else:
            group = _text_rules(spec.group, F.col(spec.group))
        return [*group, *_text_rules(spec.key, F.col(spec.key))]
    if name in jobs.JOBS:
        return _sample_rules(years)
    raise ValueError(f"unknown job {name!r}")


def call_rules(time_field: int = 7, pattern: str = CALL_TIME_PATTERN, line_col: str = "value", time: Column | None = None) -> Rules:
    """The dropping rules of the call jobs, over lines, or over records with the column ``time``."""
    text = field(line_col, time_field) if time is None else time
    return [("no time field", text.isNull()), ("time does not parse", parse_call_time(text, pattern).isNull())]


def _counts(rules: Rules) -> list[Column]:
    """One count per rule, then of the kept and of all; rules that come before take a document away."""
    left, out = F.lit(True), []
    for name, dropped in rules:
        holds = F.coalesce(dropped, F.lit(False))
        out.append(F.count_if(left & holds).alias(name))
        left = left & ~holds
    return [*out, F.count_if(left).alias(KEPT), F.count(F.lit(1)).alias(READ)]


def accounted(df: DataFrame, rules: Rules, name: str = "accounting") -> tuple[DataFrame, Observation]:
    """``df`` and an observation that holds its counts by rule once an action has
    passed over it: ``observation.get`` is a dict of name and count.  A job that
    writes its input for later steps fills it in that pass."""
    seen = Observation(name)
    return df.observe(seen, *_counts(rules)), seen


def accounting(df: DataFrame, rules: Mapping[str, Rules]) -> DataFrame:
    """``job, rule, documents`` for each job: its dropping rules, ``kept`` and ``read``,
    counted in one pass over ``df``."""
    counts = df.agg(*[F.struct(*_counts(own)).alias(f"{i}") for i, own in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(job).alias("job"), F.lit(rule).alias("rule"), F.col(f"`{i}`").getField(rule).alias("documents"))
        for i, (job, own) in enumerate(rules.items())
        for rule in (*(name for name, _ in own), KEPT, READ)
    ]
    return counts.select(F.inline(F.array(*rows)))
