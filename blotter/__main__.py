"""Command line: run one job from a source to a sink.

    python -m blotter top_crimes --input crimes.json --output out/topcrimes
    python -m blotter crimes_by_month --input crimes.parquet --input-format parquet \\
        --output out/by_month --output-format json --mode overwrite
    python -m blotter district_correlation --input crimes.json --output out/corr \\
        --param year_a=2015 --param year_b=2016 --param method=pearson
    python -m blotter calls_timestamp_text --input calls.csv --output out/calls_text
    python -m blotter calls_day_of_week --input calls.csv --input-format csv \\
        --option header=true --option multiLine=true --output out/calls
    python -m blotter district_density --input crimes.json --output out/kde --output-format text
    python -m blotter all --input crimes.json --output out/

``all`` parses the documents once into a year-partitioned Parquet copy
(``<output>/clean``) and runs every incident job from it, the ten rankings in one
scan, each into ``<output>/<job>``.

Parameters are passed as ``--param name=value`` and read by the type the job
declares (lists are comma-separated); ``--option name=value`` goes to the
reader (``--input-format csv --option header=true``), ``--id-col`` names the
field that orders the documents, and ``--no-rank`` leaves the rank out of the
flat rankings.  ``--accounting path`` writes how many documents the job read, kept
and dropped by which rule (``all`` always does, to ``<output>/accounting``).  Call logs are read as lines, or
with ``--input-format csv`` as CSV records (header lines, quoted line breaks).
Intermediate tables are deleted when their job is done.  The session comes from ``spark-submit`` / the environment;
nothing here picks a master.
"""

from __future__ import annotations

import argparse
import collections.abc
import inspect
import os
import sys
import types
import typing

from pyspark.sql import SparkSession

from blotter.functions.calendar import CALL_TIME_PATTERN
from blotter.plans import jobs
from blotter.plans.accounting import accounted, accounting, call_rules, job_rules
from blotter.plans.rankings import one_ranking, rank_all
from blotter.session import scratch_tables, write_out
from blotter.sources.calls import csv_field, field, read_call_lines, read_call_records, record_field
from blotter.sources.incidents import (
    clean_incidents,
    read_clean_incidents,
    read_incidents,
    store_clean_incidents,
)
from blotter.sources.sinks import write_lines, write_result

CALL_JOBS = {"calls_day_of_week": jobs.calls_day_of_week, "calls_timestamp_text": jobs.calls_timestamp_text}
# Columns holding the printed form of a statistic, for --output-format text.
REPORT_COLUMNS = ("label", "summary", "report")


def _value(text: str, kind):
    """``text`` as the declared type ``kind`` of a parameter."""
    kinds = [k for k in typing.get_args(kind) if k is not type(None)]
    if typing.get_origin(kind) in (typing.Union, types.UnionType):
        if text.lower() in ("", "none"):
            return None
        return _value(text, kinds[0])
    if typing.get_origin(kind) is collections.abc.Sequence:
        return [_value(t, kinds[0]) for t in text.split(",") if t]
    if kind is bool:
        if text.lower() not in ("true", "false"):
            raise SystemExit(f"{text!r} is neither true nor false")
        return text.lower() == "true"
    return kind(text)


def _parameters(job, given: list[str]) -> dict:
    kinds = typing.get_type_hints(job)
    out = {}
    for p in given:
        name, _, text = p.partition("=")
        if name not in inspect.signature(job).parameters:
            raise SystemExit(f"{job.__name__} has no parameter {name!r}")
        out[name] = _value(text, kinds[name])
    return out


def _years(job, params: dict) -> list[int]:
    """The years a statistic looks at: its parameters named year..., or their defaults."""
    known = inspect.signature(job).parameters
    return [params.get(n, p.default) for n, p in known.items() if n.startswith("year")]


def _is_true(text: str) -> bool:
    return _value(text, bool)


def _read_calls(spark: SparkSession, args, options: dict):
    if args.input_format != "csv":
        return read_call_lines(spark, args.input)
    flags = {k: _is_true(options.pop(k)) for k in ("header", "multiLine") if k in options}
    return read_call_records(spark, args.input, header=flags.get("header", False), multiline=flags.get("multiLine", False), **options)


def _write_counts(spark: SparkSession, job: str, counts: dict, path: str, mode: str) -> None:
    rows = [(job, rule, n) for rule, n in counts.items()]
    write_result(spark.createDataFrame(rows, "job string, rule string, documents long").coalesce(1), path, "json", mode)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m blotter", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=sorted([*jobs.JOBS, *CALL_JOBS, "all"]))
    ap.add_argument("--input", required=True)
    ap.add_argument("--input-format", default=None, help="json by default; lines of text for call jobs")
    ap.add_argument("--option", action="append", default=[], help="reader option name=value")
    ap.add_argument("--id-col", help="field that orders the documents")
    ap.add_argument("--output", required=True)
    ap.add_argument("--output-format", default="parquet")
    ap.add_argument("--mode", default="errorifexists", help="a mode of Spark's writers, or replace: old results stay until the new ones are whole")
    ap.add_argument("--param", action="append", default=[], help="name=value")
    ap.add_argument("--no-rank", action="store_true", help="flat rankings without rank")
    ap.add_argument("--accounting", help="folder for the counts of read, kept and dropped documents")
    args = ap.parse_args(argv)
    job = {**jobs.JOBS, **CALL_JOBS}.get(args.job)
    params = _parameters(job, args.param) if job else {}
    options = dict(p.split("=", 1) for p in args.option)
    if args.no_rank and args.job in jobs.FLAT:
        params["rank_col"] = None

    spark = SparkSession.builder.appName(f"blotter-{args.job}").getOrCreate()
    with scratch_tables(spark):
        if args.job in CALL_JOBS:
            _run_calls(spark, args, params, options)
        elif args.job == "all":
            _run_all(spark, args, options)
        else:
            _run_job(spark, args, params, options)
    return 0


def _run_calls(spark: SparkSession, args, params: dict, options: dict) -> None:
    calls, seen = _read_calls(spark, args, options), None
    if args.accounting:
        at = params.get("time_field", 7)
        time = record_field(at) if args.input_format == "csv" else csv_field("value", at) if params.get("quoted") else field("value", at)
        calls, seen = accounted(calls, call_rules(pattern=params.get("pattern", CALL_TIME_PATTERN), time=time))
    if args.job == "calls_timestamp_text":
        write_lines(jobs.calls_timestamp_text(calls, **params), "value", args.output, args.mode)
    else:
        write_result(jobs.calls_day_of_week(calls, **params), args.output, args.output_format, args.mode)
    if seen is not None:
        _write_counts(spark, args.job, seen.get, args.accounting, args.mode)


def _incidents(spark: SparkSession, args, options: dict):
    return clean_incidents(read_incidents(spark, args.input, args.input_format or "json", id_col=args.id_col, **options))


def _run_all(spark: SparkSession, args, options: dict) -> None:
    clean_path = os.path.join(args.output, "clean")
    store_clean_incidents(_incidents(spark, args, options), clean_path, mode=args.mode)
    stored = read_clean_incidents(spark, clean_path)
    ranked = write_out(rank_all(stored), "rankings")  # one scan for the ten rankings
    for name, job in jobs.JOBS.items():
        with scratch_tables(spark):
            if name in jobs.FLAT or name in jobs.NESTED:
                result = one_ranking(ranked, name, None if args.no_rank else "rk")
            else:
                result = job(stored)
            write_result(result, os.path.join(args.output, name), args.output_format, args.mode)
    rules = {name: job_rules(name, _years(job, {})) for name, job in jobs.JOBS.items()}
    write_result(accounting(stored, rules), args.accounting or os.path.join(args.output, "accounting"), "json", args.mode)


def _run_job(spark: SparkSession, args, params: dict, options: dict) -> None:
    incidents, seen = _incidents(spark, args, options), None
    if args.accounting:
        incidents, seen = accounted(incidents, job_rules(args.job, _years(jobs.JOBS[args.job], params)))
    result = jobs.JOBS[args.job](incidents, **params)
    if args.output_format == "text":
        # Report lines, as the statistics programs printed them.
        column = next((c for c in REPORT_COLUMNS if c in result.columns), None)
        if column is None:
            raise SystemExit(f"{args.job} has no report column; choose another --output-format")
        ordered = result.orderBy("point_index") if "point_index" in result.columns else result
        write_lines(ordered.coalesce(1), column, args.output, args.mode)
    else:
        write_result(result, args.output, args.output_format, args.mode)
    if seen is not None:
        _write_counts(spark, args.job, seen.get, args.accounting, args.mode)


if __name__ == "__main__":
    sys.exit(main())
