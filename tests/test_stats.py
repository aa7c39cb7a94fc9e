"""Samples, positions, correlation, density and the KS test (checked against MLlib)."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from blotter.operators import stats
from blotter.operators.ordering import with_positions, with_running_total
from blotter.plans import jobs
from blotter.sources import tables

from helpers import clean_rows

SF = "/root/testdata/sf0.01"
A, B = 1999, 2000


@pytest.fixture(scope="module")
def dirty(spark):
    inc = tables.incidents_dirty(spark, SF).cache()
    yield inc
    inc.unpersist()


def test_sample_filters(spark):
    rows = [
        (1, "T", "5", "L", "true", "01/01/2017", "2017"),
        (2, "T", "NaN", "L", "true", "01/01/2017", "2017"),      # NaN dropped (Java compare)
        (3, "T", "Infinity", "L", "true", "01/01/2017", "2017"),  # kept
        (4, "T", "-3", "L", "true", "01/01/2017", "2017"),
        (5, "T", "abc", "L", "true", "01/01/2017", "2017"),
        (6, "T", "1e1", "L", "true", "01/01/2017", "2017"),
        (7, "T", "7", "L", "true", "01/01/2017", "2016"),         # other year
        (8, "T", "8", "L", "true", "01/01/2017", "x"),            # D11: not a year
        (9, "T", "0", "L", "true", "01/01/2017", "2017"),
    ]
    s = stats.district_sample(clean_rows(spark, rows), 2017)
    assert sorted((r.incident_id, r.v) for r in s.collect()) == [(1, 5.0), (3, math.inf), (6, 10.0), (9, 0.0)]


def test_positions_match_window(spark, dirty):
    sample = stats.district_sample(dirty, [A, B])
    got = stats.positioned_sample(sample)
    w = Window.partitionBy("year").orderBy("incident_id")
    expect = sample.withColumn("pos", F.row_number().over(w).cast("long"))
    assert got.count() == expect.count()
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


@pytest.mark.parametrize("slices", [1, 3, 7, 16])
def test_positions_independent_of_slices(spark, dirty, slices):
    sample = stats.district_sample(dirty, [A, B])
    got = with_positions(sample, [F.col("incident_id").asc()], partition_by=["year"], slices=slices)
    w = Window.partitionBy("year").orderBy("incident_id")
    expect = sample.withColumn("pos", F.row_number().over(w).cast("long"))
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


def test_running_total_matches_window(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("g"), F.col("id").alias("k"), (F.col("id") % 5).alias("w"))
    got = with_running_total(df, [F.col("k").asc()], "w", name="cum", partition_by=["g"], slices=5)
    win = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    expect = df.withColumn("cum", F.sum("w").over(win))
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_pairs_unequal_years_any_partitioning(spark, dirty, parts):
    # D10: years of unequal size; the pairing does not depend on input partitioning.
    sample = stats.district_sample(dirty.repartition(parts), [A, B])
    counts = stats.sample_counts(sample, A, B).first()
    assert counts.n_a != counts.n_b
    pairs = stats.positional_pairs(sample, A, B)
    assert pairs.count() == counts.n_min
    eq = stats.equalized_sample(pairs, A, B)
    assert {r.year: r.c for r in eq.groupBy("year").agg(F.count(F.lit(1)).alias("c")).collect()} == {
        A: counts.n_min, B: counts.n_min}


def _mllib_pairs(spark, dirty):
    sample = stats.district_sample(dirty, [A, B])
    pairs = stats.positional_pairs(sample, A, B).orderBy("pos")
    rows = pairs.collect()
    sc = spark.sparkContext
    x = sc.parallelize([r.a for r in rows], 4)
    y = sc.parallelize([r.b for r in rows], 4)
    return x, y


def test_pearson_matches_mllib(spark, dirty):
    from pyspark.mllib.stat import Statistics

    x, y = _mllib_pairs(spark, dirty)
    expect = Statistics.corr(x, y, "pearson")
    got = jobs.district_correlation(dirty, A, B, "pearson").first()
    assert got.r == pytest.approx(expect, abs=1e-12)


def test_spearman_matches_mllib(spark, dirty):
    from pyspark.mllib.stat import Statistics

    x, y = _mllib_pairs(spark, dirty)
    expect = Statistics.corr(x, y, "spearman")
    got = jobs.district_correlation(dirty, A, B, "spearman").first()
    assert got.r == pytest.approx(expect, abs=1e-12)
    assert got.r == pytest.approx(-0.0226888552, abs=1e-9)


def test_density_matches_mllib(spark, dirty):
    from pyspark.mllib.stat import KernelDensity

    sample = stats.district_sample(dirty, B)
    kd = KernelDensity()
    kd.setSample(sample.select("v").rdd.map(lambda r: r[0]))
    kd.setBandwidth(1.0)
    expect = kd.estimate([float(i) for i in range(1, 26)])
    got = [r.density for r in jobs.district_density(dirty, B).orderBy("point_index").collect()]
    assert len(got) == 25
    for g, e in zip(got, expect):
        assert g == pytest.approx(e, abs=1e-12)
    labels = [r.label for r in jobs.district_density(dirty, B).orderBy("point_index").limit(2).collect()]
    assert labels[0].startswith("Distretto n.1: ") and labels[1].startswith("Distretto n.2: ")


def _brute_ks(values, mean, sd):
    xs = sorted(values)
    n = len(xs)
    cdf = [0.5 * math.erfc(-(x - mean) / (sd * math.sqrt(2.0))) for x in xs]
    return max(max((i + 1) / n - c, c - i / n) for i, c in enumerate(cdf))


@pytest.mark.parametrize("method", ["histogram", "mllib"])
@pytest.mark.parametrize("params", [(0.0, 1.0), (13.0, 7.2)])
def test_ks_statistic_matches_brute_force(spark, dirty, params, method):
    sample = stats.district_sample(dirty, B)
    values = [r.v for r in sample.collect()]
    res = stats.ks_test(sample, "v", "norm", params, method).first()
    assert res.statistic == pytest.approx(_brute_ks(values, *params), abs=1e-12)


@pytest.mark.parametrize("size", [30, 120, 400])
def test_ks_p_value_matches_mllib_when_moderate(spark, dirty, size):
    # a sample whose p-value is not vanishing: district numbers against N(13, 7.2)
    sample = stats.district_sample(dirty, B).orderBy("incident_id").limit(size)
    sample = spark.createDataFrame(sample.collect(), sample.schema)
    hist = stats.ks_test(sample, "v", "norm", (13.0, 7.2), "histogram").first()
    ml = stats.ks_test(sample, "v", "norm", (13.0, 7.2), "mllib").first()
    assert hist.statistic == pytest.approx(ml.statistic, abs=1e-12)
    assert hist.p_value == pytest.approx(ml.p_value, abs=2e-3)


def test_normal_cdf_expression(spark):
    from blotter.functions.numeric import normal_cdf

    xs = [-9.0, -8.0, -3.5, -1.0, -1e-9, 0.0, 0.3, 1.0, 2.5, 7.9, 12.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(normal_cdf("x")).collect()]
    for x, g in zip(xs, got):
        assert g == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2.0)), abs=1e-14)


def test_ks_p_value_column(spark):
    cases = [(0.001, 100), (1.0, 10), (0.274, 10), (0.05, 50), (0.1, 50), (0.15, 50), (0.3, 50), (0.12, 1000), (0.0085, 100_000), (None, 0)]
    df = spark.createDataFrame(cases, "d double, n long")
    got = {(r.d, r.n): r.p for r in df.withColumn("p", stats.ks_p_value(F.col("d"), F.col("n").cast("double"))).collect()}
    assert got[(None, 0)] is None
    assert got[(0.001, 100)] == pytest.approx(1.0)
    assert 0.0 <= got[(1.0, 10)] < 1e-6
    assert got[(0.274, 10)] == pytest.approx(0.3715, abs=6e-3)  # 1 - 0.6285 of the exact distribution
    falling = [got[(d, 50)] for d in (0.05, 0.1, 0.15, 0.3)]
    assert falling == sorted(falling, reverse=True)
    # the tail keeps its digits: 2 exp(-2 n d^2) to first order
    assert got[(0.12, 1000)] == pytest.approx(6e-13, rel=0.15)
    assert got[(0.0085, 100_000)] == pytest.approx(1.05426e-06, rel=1e-3)


def test_ks_is_one_lazy_plan_after_the_layout(spark, dirty):
    plan = stats.ks_test(stats.district_sample(dirty, B), "v")._jdf.queryExecution().executedPlan().toString()
    # n comes with the offsets of the running count: the values are read once more, not twice
    assert "Subquery" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("ReadSchema: struct<__v") == 1


def test_ks_against_standard_normal(spark, dirty):
    res = jobs.district_ks(dirty, B).first()
    assert res.p_value < 1e-6
    assert res.null_hypothesis == "Sample follows theoretical distribution"
    assert res.conclusion.startswith("Very strong presumption against null hypothesis")
    assert res.summary.startswith("Kolmogorov-Smirnov test summary:\ndegrees of freedom = 0 \nstatistic = ")


def test_empty_sample(spark):
    # D19: a year without rows.
    rows = [(1, "T", "5", "L", "true", "01/01/2017", "2017")]
    inc = clean_rows(spark, rows)
    dens = jobs.district_density(inc, 1990).collect()
    assert len(dens) == 25 and all(r.density is None for r in dens)
    corr = jobs.district_correlation(inc, 1990, 1991).first()
    assert corr.r is None and corr.n == 0
    ks = jobs.district_ks(inc, 1990).first()
    assert ks.statistic is None and ks.p_value is None


def test_infinite_value_gives_nan_correlation(spark):
    rows = [
        (1, "T", "1", "L", "true", "01/01/2015", "2015"),
        (2, "T", "Infinity", "L", "true", "01/01/2015", "2015"),
        (3, "T", "3", "L", "true", "01/01/2015", "2015"),
        (4, "T", "2", "L", "true", "01/01/2016", "2016"),
        (5, "T", "4", "L", "true", "01/01/2016", "2016"),
        (6, "T", "5", "L", "true", "01/01/2016", "2016"),
    ]
    r = jobs.district_correlation(clean_rows(spark, rows), 2015, 2016).first()
    assert r.n == 3 and (r.r is None or math.isnan(r.r))


def test_correlation_rejects_unknown_method(spark, dirty):
    with pytest.raises(ValueError):
        jobs.district_correlation(dirty, A, B, "kendall")


def test_spearman_through_shuffle_joins(spark, dirty):
    broadcast = jobs.district_correlation(dirty, A, B, "spearman").first().r
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = jobs.district_correlation(dirty, A, B, "spearman").first().r
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert broadcast == pytest.approx(shuffled, abs=1e-12)


def test_layout_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long")
    assert with_positions(df, [F.col("id").desc()], name="pos", slices=3).agg(F.max("pos")).first()[0] == 1000
    assert seen.value == 1000


def test_layout_holds_only_what_is_kept(spark):
    from blotter.operators.ordering import lay_out

    df = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("g"), F.lit("x").alias("wide"))
    assert lay_out(df, [F.col("k").asc()], ["g"], keep=["k"]).columns == ["g", "k", "__slice", "__seq"]


def _documents(tmp_out, name, with_ids):
    import json
    import os
    import random

    rng = random.Random(3)
    path = os.path.join(tmp_out, name)
    os.makedirs(path)
    i = 0
    for part in range(3):
        with open(os.path.join(path, f"part-{part}.json"), "w") as f:
            for _ in range(900):
                doc = {"Primary Type": "T", "District": rng.randint(1, 25), "Year": rng.choice([2015, 2016]), "Date": "01/02/2016"}
                f.write(json.dumps(doc | ({"number": i} if with_ids else {})) + "\n")
                i += 1
    return path


def test_documents_without_ids_have_one_order(spark, tmp_out):
    from blotter.sources import clean_incidents, read_incidents

    plain = _documents(tmp_out, "plain", False)
    with_ids = _documents(tmp_out, "ids", True)
    by_id = jobs.district_correlation(clean_incidents(read_incidents(spark, with_ids, id_col="number"))).first()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    found = set()
    try:
        for size in ("4k", "17k", "100k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            inc = clean_incidents(read_incidents(spark, plain))
            for df in (inc, inc.repartition(3), inc.repartition(7)):
                r = jobs.district_correlation(df).first()
                found.add((round(r.r, 12), r.n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert found == {(round(by_id.r, 12), by_id.n)}


def test_documents_without_any_order_are_refused(spark):
    rows = [(None, "T", "1", "L", "true", "01/01/2015", "2015"), (None, "T", "2", "L", "true", "01/01/2016", "2016")]
    with pytest.raises(Exception, match="no order"):
        jobs.district_correlation(clean_rows(spark, rows), 2015, 2016).collect()


def test_positions_property(spark):
    # Random groups/keys, random slice counts: the layout always equals a window.
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None)
    @given(
        rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=0, max_size=60, unique=True),
        slices=st.integers(1, 5),
    )
    def check(rows, slices):
        df = spark.createDataFrame(rows, "g int, k int") if rows else spark.createDataFrame([], "g int, k int")
        got = with_positions(df, [F.col("k").desc()], name="pos", partition_by=["g"], slices=slices)
        expect = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(F.col("k").desc())).cast("long"))
        assert sorted(map(tuple, got.select("g", "k", "pos").collect())) == sorted(map(tuple, expect.collect()))

    check()


def test_layout_splits_a_hot_group(spark):
    # One group holds a third of the rows: the range layout spreads it over
    # several slices instead of one task.
    from blotter.operators.ordering import lay_out

    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("g"), F.col("id").alias("k")
    )
    laid = lay_out(df, [F.col("k").asc()], partition_by=["g"], slices=6)
    sizes = [r[1] for r in laid.groupBy("__slice").count().collect()]
    assert len(sizes) == 6
    assert max(sizes) <= 2 * (sum(sizes) / len(sizes))
    hot = laid.where(F.col("g") == 0).select("__slice").distinct().count()
    assert hot >= 2


def test_density_many_points_path_agrees(spark, dirty):
    sample = stats.district_sample(dirty, B)
    pts = [0.5 * i for i in range(1, 101)]  # 100 points: two aggregates
    long_form = {r.point_index: r.density for r in stats.kernel_density(sample, pts).collect()}
    wide = {}
    for chunk in range(0, 100, 25):
        part = stats.kernel_density(sample, pts[chunk:chunk + 25]).collect()
        wide.update({chunk + r.point_index: r.density for r in part})
    assert len(long_form) == 100
    for i in range(1, 101):
        assert long_form[i] == pytest.approx(wide[i], abs=1e-14)
    empty = stats.kernel_density(sample.where("v < 0"), pts).collect()
    assert len(empty) == 100 and all(r.density is None for r in empty)


def test_ks_summary_text_equals_mllib_printout(spark):
    from pyspark.mllib.stat import Statistics

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    sample = stats.district_sample(inc, 1996)
    vals = [r.v for r in sample.collect()]
    printed = str(Statistics.kolmogorovSmirnovTest(spark.sparkContext.parallelize(vals, 3), "norm", 13.0, 7.2))
    ours = stats.ks_test(sample, "v", "norm", (13.0, 7.2), "mllib").first()
    # Same text; the numbers may differ in the last digits because MLlib sums
    # per-partition offsets, and the partitioning of the two inputs differs.
    import re

    number = r"[-+]?[0-9]+(?:\.[0-9]+)?(?:E-?[0-9]+)?"
    assert re.sub(number, "#", ours.summary) == re.sub(number, "#", printed)
    for a, b in zip(re.findall(number, ours.summary), re.findall(number, printed)):
        assert float(a) == pytest.approx(float(b), rel=1e-9, abs=1e-15)
    hist = stats.ks_test(sample, "v", "norm", (13.0, 7.2)).first()
    assert hist.statistic == pytest.approx(ours.statistic, abs=1e-12)
    assert hist.p_value == pytest.approx(ours.p_value, rel=2e-2, abs=1e-9)


def test_running_total_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(
        rows=st.lists(st.tuples(st.integers(0, 2), st.integers(-30, 30), st.integers(0, 9)),
                      min_size=1, max_size=50, unique_by=lambda r: (r[0], r[1])),
        slices=st.integers(1, 4),
    )
    def check(rows, slices):
        df = spark.createDataFrame(rows, "g int, k int, w int")
        got = with_running_total(df, [F.col("k").asc()], "w", name="cum", partition_by=["g"], slices=slices)
        expect = {}
        for g in {r[0] for r in rows}:
            total = 0
            for _, k, w in sorted(r for r in rows if r[0] == g):
                total += w
                expect[(g, k)] = total
        assert {(r.g, r.k): r.cum for r in got.collect()} == expect

    check()


def _repeated(spark, parts):
    """6,000 documents, each id three times a year, in tables without files."""
    rows = spark.range(6000).select(
        (F.col("id") % 1000).alias("incident_id"), F.when(F.col("id") % 2 == 0, A).otherwise(B).alias("year"),
        (F.pmod(F.xxhash64("id"), F.lit(25)) + 1).cast("double").alias("v"))
    return rows.repartition(parts, F.xxhash64("v", "incident_id"))


def test_repeated_ids_pair_the_same_at_every_partitioning(spark):
    found = set()
    for parts in (1, 2, 5, 11):
        pairs = stats.positional_pairs(_repeated(spark, parts), A, B)
        found.add(tuple(stats.correlation(pairs, m).first().r for m in ("pearson", "spearman")))
    assert len({tuple(round(x, 12) for x in f) for f in found}) == 1


def test_spearman_on_the_joint_histogram(spark):
    from pyspark.mllib.stat import Statistics

    pairs = spark.createDataFrame([(float(i % 7), float((i * i) % 11)) for i in range(400)], "a double, b double")
    rows = pairs.collect()
    sc = spark.sparkContext
    expect = Statistics.corr(sc.parallelize([r.a for r in rows], 3), sc.parallelize([r.b for r in rows], 3), "spearman")
    got = stats.correlation(pairs, "spearman").first()
    assert got.r == pytest.approx(expect, abs=1e-12) and got.n == 400
    plan = stats.correlation(pairs, "spearman")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan  # the pairs themselves are not joined: every join reads written histograms


def test_spearman_without_pairs_and_without_spread(spark):
    pairs = spark.createDataFrame([], "a double, b double")
    assert tuple(stats.correlation(pairs, "spearman").first())[:2] == (None, 0)
    flat = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "a double, b double")
    r = stats.correlation(flat, "spearman").first()
    assert math.isnan(r.r) and r.n == 5


def _matrix_power(d, n):
    """P(D_n < d) as n!/n^n times an entry of the n-th power of a matrix, multiplied out in extended precision."""
    import numpy as np

    k = int(n * d) + 1
    m, h = 2 * k - 1, np.longdouble(k) - n * np.longdouble(d)
    over = [np.longdouble(1)]
    for t in range(1, m + 2):
        over.append(over[-1] / t)  # 1/t!
    a = np.array([[over[i - j + 1] if i - j + 1 >= 0 else 0 for j in range(m)] for i in range(m)], dtype=np.longdouble)
    for i in range(m):
        a[i, 0] -= h ** (i + 1) * over[i + 1]
        a[m - 1, i] -= h ** (m - i) * over[m - i]
    a[m - 1, 0] += max(2 * h - 1, np.longdouble(0)) ** m * over[m]
    row = np.eye(m, dtype=np.longdouble)[k - 1]
    for s in range(1, n + 1):
        row = row @ a * (np.longdouble(s) / n)
    return float(row[k - 1])


def test_exact_p_values_match_mllib(spark):
    from pyspark.mllib.stat import Statistics

    sc, rng = spark.sparkContext, __import__("random").Random(3)
    sizes = [1, 2, 3, 4, 5, 7, 10, 15, 25, 40, 70, 110, 160, 200]
    samples = {n: [rng.gauss(0.3, 1.2) for _ in range(n)] for n in sizes}
    df = spark.createDataFrame([(n, v) for n, vs in samples.items() for v in vs], "n int, v double")
    got = {r.n: r for r in stats.ks_test(df, by=["n"], p_value="exact").collect()}
    for n, vs in samples.items():
        expect = Statistics.kolmogorovSmirnovTest(sc.parallelize(vs, 1), "norm", 0.0, 1.0)
        assert got[n].statistic == pytest.approx(expect.statistic, abs=1e-12)
        # beyond 140 values MLlib itself takes an asymptotic series
        assert got[n].p_value == pytest.approx(expect.pValue, abs=1e-9 if n <= 140 else 1e-6)
        assert got[n].p_value == pytest.approx(1 - _matrix_power(expect.statistic, n), abs=1e-11)


def test_exact_distribution_for_every_small_n(spark):
    # closed forms: n = 1, 2d - 1; n = 2, 2 (2d - 1/2)^2 below 1/2 and -2d^2 + 4d - 1 above
    df = spark.createDataFrame([(1, 0.5 + i / 40) for i in range(20)] + [(2, 0.25 + i / 40) for i in range(30)], "n long, d double")
    for r in df.select("*", stats.kolmogorov_cdf("d", "n").alias("p")).collect():
        d = r.d
        expect = 2 * d - 1 if r.n == 1 else 2 * (2 * d - 0.5) ** 2 if d < 0.5 else -2 * d * d + 4 * d - 1
        assert r.p == pytest.approx(expect, abs=1e-13)
    # it agrees with the limiting form where that is good, rises with d, and stays in 0..1
    df = spark.createDataFrame([(n, k / 20 / math.sqrt(n)) for n in (150, 200) for k in range(1, 60)], "n long, d double")
    rows = df.select("*", stats.ks_exact_p_value(F.col("d"), F.col("n")).alias("p"), stats.ks_p_value(F.col("d"), F.col("n").cast("double")).alias("limit")).orderBy("n", "d").collect()
    assert all(abs(r.p - r.limit) < 6e-4 and 0 <= r.p <= 1 for r in rows)
    assert all(x.p >= y.p - 1e-12 for x, y in zip(rows, rows[1:]) if x.n == y.n)


def test_ks_groups_equal_single_tests(spark, dirty):
    sample = stats.district_sample(dirty, [A, B])
    by_year = {r.year: r for r in stats.ks_test(sample, params=(13.0, 7.2), by=["year"]).collect()}
    for year in (A, B):
        one = stats.ks_test(stats.district_sample(dirty, year), params=(13.0, 7.2)).first()
        assert by_year[year].statistic == pytest.approx(one.statistic, abs=1e-14)
        assert by_year[year].p_value == pytest.approx(one.p_value, abs=1e-12)
    with pytest.raises(ValueError, match="p_value"):
        stats.ks_test(sample, p_value="guess")


def test_running_total_with_group_totals(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("g"), F.col("id").alias("k"), (F.col("id") % 5).alias("w"))
    got = with_running_total(df, [F.col("k").asc()], "w", name="cum", partition_by=["g"], slices=5, total="all")
    totals = {r.g: r.s for r in df.groupBy("g").agg(F.sum("w").alias("s")).collect()}
    assert got.count() == 500 and all(r["all"] == totals[r.g] for r in got.collect())
