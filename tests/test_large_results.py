"""Densities at a table of points, lists in parts, several distributions at once, and writes that keep the old result."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators import ranking, stats
from blotter.plans import jobs
from blotter.sources import tables, write_lines, write_result

SF = "/root/testdata/sf0.001"


def _density(values, points, h):
    v = np.array(values)
    return [float(np.exp(-0.5 * ((p - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi))) for p in points]


@pytest.mark.parametrize("h", [0.05, 1.0, 40.0])
def test_density_at_a_table_of_points(spark, h):
    rng = np.random.default_rng(1)
    values = [*rng.normal(0, 30, 700), *[5.0] * 300, -2e5, 3e8]
    points = [*rng.uniform(-80, 80, 60), 5.0, 5.0, -2e5, 1e9, 38.7 * h, -38.7 * h]
    sample = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    table = spark.createDataFrame([(i, float(p)) for i, p in enumerate(points)], "point_index int, point double")
    got = {r.point_index: r.density for r in stats.kernel_density(sample, table, h).collect()}
    assert len(got) == len(points)
    for i, expect in enumerate(_density(values, points, h)):
        assert got[i] == pytest.approx(expect, rel=1e-11, abs=1e-300)


def test_density_table_equals_the_listed_points(spark):
    sample = stats.district_sample(tables.incidents_dirty(spark, SF), 1996)
    table = spark.createDataFrame([(i, float(i)) for i in range(1, 26)], "point_index int, point double")
    a = {r.point_index: (r.density, r.point) for r in stats.kernel_density(sample).collect()}
    b = {r.point_index: (r.density, r.point) for r in stats.kernel_density(sample, table).collect()}
    assert a.keys() == b.keys()
    assert all(a[i] == pytest.approx(b[i], rel=1e-12) for i in a)


def test_density_of_odd_points_and_empty_samples(spark):
    table = spark.createDataFrame([(1, None), (2, float("inf")), (3, 1.0), (3, 1.0), (4, -0.0)], "point_index int, point double")
    one = spark.createDataFrame([(0.0,)], "v double")
    got = [(r.point_index, r.density) for r in stats.kernel_density(one, table).orderBy("point_index").collect()]
    top = 1 / math.sqrt(2 * math.pi)
    assert got[0] == (1, None) and got[1] == (2, 0.0) and got[2] == got[3] and len(got) == 5
    assert got[4][1] == pytest.approx(top) and got[2][1] == pytest.approx(top * math.exp(-0.5))
    none = stats.kernel_density(one.where("false"), table).collect()
    assert len(none) == 5 and all(r.density is None for r in none)
    assert stats.kernel_density(one, table.where("false")).count() == 0


def test_range_join_is_an_equi_join(spark):
    sample = spark.range(500).select(F.col("id").cast("double").alias("v"))
    table = spark.range(40).select(F.col("id").alias("point_index"), F.col("id").cast("double").alias("point"))
    plan = stats.density_at(sample, table)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "partial_sum" in plan


def test_points_meet_cells_and_are_not_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values, points = rng.uniform(0, 20, 20_000), rng.uniform(-45, 65, 40)
    written = []
    monkeypatch.setattr(stats, "write_out", lambda df, name, keep=stats.write_out: written.append(keep(df, name)) or written[-1])
    sample = spark.createDataFrame([(float(v),) for v in values], "v double")
    table = spark.createDataFrame([(i, float(p)) for i, p in enumerate(points)], "point_index int, point double")
    out = stats.density_at(sample, table)
    got = {r.point_index: r.density for r in out.collect()}
    for i, expect in enumerate(_density(values, points, 1.0)):
        assert got[i] == pytest.approx(expect, rel=1e-11, abs=1e-300)
    # 20,000 values are 161 cells; the points, repeated for each bucket near, stay out of the driver
    assert [w.count() for w in written] == [161]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [__bucket" in plan and "BroadcastHashJoin [__bucket" not in plan


def test_density_of_coarse_doubles_and_odd_values(spark):
    sample = spark.createDataFrame([(x,) for x in (1e18, 1e18, 1e300, float("inf"), -1e17, 2.0)], "v double")
    table = spark.createDataFrame(list(enumerate((1e18, 1e300, -1e17, 2.0, 1e18 + 128))), "point_index int, point double")
    got = {r.point_index: r.density * 6 * math.sqrt(2 * math.pi) for r in stats.density_at(sample, table).collect()}
    assert got == {0: pytest.approx(2), 1: pytest.approx(1), 2: pytest.approx(1), 3: pytest.approx(1), 4: 0.0}


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_lists_in_parts(spark, size):
    inc = tables.incidents_dirty(spark, SF)
    for name in ("crimes_by_month", "locations_by_crime"):
        spec = jobs.NESTED[name]
        whole = {r[0]: [tuple(x) for x in r[1]] for r in jobs.JOBS[name](inc).collect()}
        parts = {}
        for g, part, items in sorted(map(tuple, jobs.JOBS[name](inc, part_size=size).collect())):
            assert 1 <= len(items) <= size and part == len(parts.get(g, [])) // size
            parts.setdefault(g, []).extend(tuple(x) for x in items)
        assert parts == whole and spec.list_name in jobs.JOBS[name](inc, part_size=size).columns


def test_a_large_group_gives_bounded_rows(spark):
    df = spark.range(60_000).select(F.lit("hot").alias("g"), F.concat(F.lit("k"), F.col("id")).alias("k"))
    parts = ranking.nested_list_parts(df, "g", "k", 1000)
    sizes = [r.n for r in parts.select(F.size("items").alias("n")).collect()]
    assert sizes == [1000] * 60
    first = parts.where("part = 0").first()["items"]
    assert [x["k"] for x in first] == sorted(f"k{i}" for i in range(60_000))[:1000]
    with pytest.raises(ValueError, match="part_size"):
        ranking.nested_list_parts(df, "g", "k", 0)


def test_compare_equals_single_tests(spark):
    sample = stats.district_sample(tables.incidents_dirty(spark, SF), [1996, 1997])
    candidates = [("norm", (13.0, 7.2)), ("norm", (13.0, 8.0)), ("gamma", (2.0, 6.0)), ("exponential", ())]
    for p_value in ("limit", "exact"):
        small = sample.limit(60) if p_value == "exact" else sample
        small = spark.createDataFrame(small.collect(), sample.schema)
        got = {(r.dist, r.params): r for r in stats.ks_compare(small, candidates, p_value=p_value).collect()}
        assert len(got) == len(candidates)
        for dist, params in candidates:
            one = stats.ks_test(small, dist=dist, params=params, p_value=p_value).first()
            same = got[dist, ",".join(repr(x) for x in params)]
            assert (same.statistic, same.p_value) == pytest.approx((one.statistic, one.p_value)) and same.summary.count("\n") == 4
    empty = stats.ks_compare(sample.where("false"), candidates).collect()
    assert [r.statistic for r in empty] == [None] * 4


def _failing(spark):
    return spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("midway"))).otherwise(F.lit("x")).cast("string").alias("value"))


def test_a_failed_rerun_leaves_the_old_result(spark, tmp_out):
    path = os.path.join(tmp_out, "result")
    write_result(spark.range(3), path, mode="replace")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="midway"):
        write_result(_failing(spark), path, mode="replace")
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_out) == ["result"]
    # the old result may be an input of the job that replaces it
    write_result(spark.read.parquet(path).withColumn("year", F.lit(2000)), path, mode="replace", partition_by=["year"])
    assert sorted(r.id for r in spark.read.parquet(path).where("year = 2000").collect()) == [0, 1, 2]
    assert os.listdir(tmp_out) == ["result"]


def test_replaced_lines_and_refused_targets(spark, tmp_out):
    path = os.path.join(tmp_out, "lines")
    for n in (4, 2):
        write_lines(spark.range(n).select(F.col("id").cast("string").alias("t")), "t", path, "replace")
        assert spark.read.text(path).count() == n
    with pytest.raises(Exception, match="midway"):
        write_lines(_failing(spark), "value", path, "replace")
    assert spark.read.text(path).count() == 2
    with pytest.raises(ValueError, match="path"):
        write_result(spark.range(1), None, mode="replace")
