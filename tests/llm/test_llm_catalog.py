"""Registered queries: names, oracles, plans, independence."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as E
from blotter.llm import catalog
from scripts.compare_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
WITH_ORACLE = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert set(WITH_ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, res.fetchall())


def test_mixing_runs_no_python(spark):
    plan = catalog.queries()["op5_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_nothing_else_imports_the_subpackage():
    root = pathlib.Path(E.__file__).parent
    for path in (root / "blotter").rglob("*.py"):
        if "llm" not in path.parts:
            assert "blotter.llm" not in path.read_text(), path


def test_results_cover_every_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_quality", "op6_licenses", "op7_spans", "op8_toxicity"):
        df = catalog.queries()[name](spark, SF)
        assert df.count() == n and df.select("doc_id").distinct().count() == n
