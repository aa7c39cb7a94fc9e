"""Flat and nested rankings: edge rows, ties, shapes and invariants."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators import ranking
from blotter.operators.ranking import ranked_counts
from blotter.plans import jobs

from helpers import clean_rows

D = "01/02/2016 01:00:00 PM"

ROWS = [
    (1, "THEFT", "1", "STREET", "true", D, "2016"),
    (2, " THEFT ", "1", "STREET", "false", D, "2016"),
    (3, "\tBATTERY\n", "2", "HOUSE", "false", "02/03/2016 01:00:00 PM", "2016"),
    (4, "BATTERY", "2", "HOUSE", "true", D, "2017"),
    (5, "ROBBERY", "001", "  ", "false", D, "2017"),   # district text kept verbatim, blank location
    (6, None, "5", "STREET", "false", D, "2017"),      # D1/D3: NULL type
    (7, "", None, "STREET", "true", D, None),          # D2, D4: NULL district/year, empty type
    (8, "   ", "3", "\t\n", "false", "no date", "2017"),  # D4, D6
    (9, "A|B", " 7 ", "PARK", "false", "1/2/2016", ""),   # D8: '|' kept whole, empty year
    (10, "ASSAULT", "3", "PARK", "true", D, "2016"),
]


def test_top_crimes_counts_and_ties(spark):
    inc = clean_rows(spark, ROWS)
    out = [tuple(r) for r in jobs.top_crimes(inc).orderBy("rk").collect()]
    # THEFT 2, BATTERY 2 (tie broken by key ascending), then singles ascending.
    assert out == [
        ("BATTERY", 2, 1),
        ("THEFT", 2, 2),
        ("ASSAULT", 1, 3),
        ("A|B", 1, 4),
        ("ROBBERY", 1, 5),
    ]


def test_top_arrest_counts_both_values(spark):
    inc = clean_rows(spark, ROWS)
    out = [tuple(r) for r in jobs.top_arrest_status(inc).orderBy("rk").collect()]
    assert out == [("false", 6, 1), ("true", 4, 2)]


def test_top_locations_ascending(spark):
    inc = clean_rows(spark, ROWS)
    out = [tuple(r) for r in jobs.top_locations(inc).orderBy("rk").collect()]
    assert out == [("HOUSE", 2, 1), ("PARK", 2, 2), ("STREET", 4, 3)]


def test_top_districts_text_kept_verbatim(spark):
    inc = clean_rows(spark, ROWS)
    out = {r[0]: r[1] for r in jobs.top_districts(inc).collect()}
    assert out == {"1": 2, "2": 2, "001": 1, "5": 1, "3": 2, " 7 ": 1}


def test_top_k(spark):
    inc = clean_rows(spark, ROWS)
    assert [r.TypeOfCrime for r in jobs.top_crimes(inc, top=2).orderBy("rk").collect()] == ["BATTERY", "THEFT"]


def test_nested_shape_and_order(spark):
    inc = clean_rows(spark, ROWS)
    out = jobs.crimes_by_district(inc)
    item = out.schema["ListOfCrimes"].dataType.elementType
    assert [f.name for f in item.fields] == ["TypeOfCrime", "NumberOfEvents"]
    assert isinstance(item["NumberOfEvents"].dataType, T.LongType)
    got = {r.DistrictNumber: [(x.TypeOfCrime, x.NumberOfEvents) for x in r.ListOfCrimes] for r in out.collect()}
    assert got == {
        "1": [("THEFT", 2)],
        "2": [("BATTERY", 2)],
        "001": [("ROBBERY", 1)],
        "3": [("ASSAULT", 1)],
        " 7 ": [("A|B", 1)],
    }


def test_nested_by_year_and_month(spark):
    inc = clean_rows(spark, ROWS)
    by_year = {r.Year: [(x.TypeOfCrime, x.NumberOfEvents) for x in r.CrimesInOrder]
               for r in jobs.crimes_by_year(inc).collect()}
    # Empty year text and NULL year are dropped (D2, D8).
    assert by_year == {
        "2016": [("THEFT", 2), ("ASSAULT", 1), ("BATTERY", 1)],
        "2017": [("BATTERY", 1), ("ROBBERY", 1)],
    }
    by_month = {r.YearAndMonth: [(x.TypeOfCrime, x.NumberOfEvents) for x in r.CrimesInOrder]
                for r in jobs.crimes_by_month(inc).collect()}
    assert by_month == {
        "2016/01": [("THEFT", 2), ("ASSAULT", 1)],
        "2016/02": [("BATTERY", 1)],
        "2017/01": [("BATTERY", 1), ("ROBBERY", 1)],
    }


def test_locations_nested(spark):
    inc = clean_rows(spark, ROWS)
    by_crime = {r.TypeOfCrime: [(x.Location, x.NumberOfEvents) for x in r.LocationOfCrime]
                for r in jobs.locations_by_crime(inc).collect()}
    assert by_crime["THEFT"] == [("STREET", 2)]
    assert "ROBBERY" not in by_crime  # blank location dropped
    by_district = {r.District: [(x.Location, x.NumberOfEvents) for x in r.LocationOfCrime]
                   for r in jobs.locations_by_district(inc).collect()}
    assert by_district["1"] == [("STREET", 2)]
    assert by_district["5"] == [("STREET", 1)]  # NULL type does not matter here


def test_nested_top_k(spark):
    inc = clean_rows(spark, ROWS)
    out = {r.Year: [x.TypeOfCrime for x in r.CrimesInOrder] for r in jobs.crimes_by_year(inc, top=1).collect()}
    assert out == {"2016": ["THEFT"], "2017": ["BATTERY"]}


def test_invariants_on_driver_tables(spark):
    from blotter.sources import tables

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001").cache()
    kept = inc.where((F.length("district") > 0) & (F.length("primary_type") > 0)).count()
    nested = jobs.crimes_by_district(inc)
    total = nested.select(F.explode("ListOfCrimes").alias("x")).agg(F.sum("x.NumberOfEvents")).first()[0]
    assert total == kept
    flat = jobs.grouped_ranking(inc, "crimes_by_district")
    # ranks are 1..m without gaps in every group
    gaps = flat.groupBy("DistrictNumber").agg(F.max("rk").alias("m"), F.count(F.lit(1)).alias("c"))
    assert gaps.where(F.col("m") != F.col("c")).count() == 0
    # the nested order equals the flat rank order
    exploded = nested.select("DistrictNumber", F.posexplode("ListOfCrimes").alias("p", "x")).select(
        "DistrictNumber", (F.col("p") + 1).alias("rk"), F.col("x.TypeOfCrime").alias("TypeOfCrime")
    )
    diff = exploded.join(flat.select("DistrictNumber", "rk", "TypeOfCrime"), ["DistrictNumber", "rk", "TypeOfCrime"], "left_anti")
    assert diff.count() == 0
    # the global rank is 1..m
    top = jobs.top_districts(inc)
    assert sorted(r.rk for r in top.collect()) == list(range(1, top.count() + 1))
    inc.unpersist()


def test_ranking_unchanged_by_input_partitioning(spark):
    from blotter.sources import tables

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    ref = sorted(tuple(r) for r in jobs.top_crimes(inc).collect())
    for n in (1, 3, 7):
        assert sorted(tuple(r) for r in jobs.top_crimes(inc.repartition(n)).collect()) == ref


def test_ranked_counts_many_categories_across_slices(spark):
    # 5,000 categories with many ties: the distributed rank must equal a plain window.
    df = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("k"),
                                   F.col("id")).where(~((F.col("id") % 7 == 0) & (F.col("id") > 10000)))
    got = ranked_counts(df, "k", count_col="n")
    from pyspark.sql import Window
    expect = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "rk", F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("k").asc())).cast("long"))
    assert got.exceptAll(expect.select(*got.columns)).count() == 0
    assert got.count() == 5000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranked_counts_equal_a_window(spark):
    from pyspark.sql import Window

    from blotter.sources import tables

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    for key in ("primary_type", "district", "location"):
        counts = inc.where(F.length(key) > 0).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        rk = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col(key).asc())).cast("long")
        expect = counts.withColumn("rk", rk)
        assert sorted(map(tuple, ranked_counts(inc, key).collect())) == sorted(map(tuple, expect.collect()))


def test_top_is_the_head_of_the_ranking(spark):
    from blotter.sources import tables

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    full = ranked_counts(inc, "district", count_col="n")
    for k in (0, 1, 3, 1000):
        top = ranked_counts(inc, "district", count_col="n", top=k)
        assert sorted(map(tuple, top.collect())) == sorted(map(tuple, full.where(F.col("rk") <= k).collect()))
    without = ranked_counts(inc, "district", count_col="n", rank_col=None, top=3)
    assert [tuple(r) for r in without.collect()] == [tuple(r)[:2] for r in full.where("rk <= 3").orderBy("rk").collect()]


def test_no_ordering_window_over_rows(spark):
    # Ranks come from the layout: the only window runs over slice offsets.
    from blotter.operators.ranking import grouped_ranked_counts
    from blotter.sources import tables

    inc = tables.incidents_dirty(spark, "/root/testdata/sf0.001")
    assert "row_number" not in _plan(ranked_counts(inc, "district"))
    lazy = _plan(ranked_counts(inc, "district", rank_col=None))
    assert "Window" not in lazy and "rangepartitioning" in lazy
    plan = _plan(grouped_ranked_counts(inc, "district", "primary_type"))
    assert "row_number" not in plan and "__slice" in plan
    for k in (10, 1001, 5000):
        # with a limit only the first rows of parts of a group meet; nothing is laid out
        plan = _plan(grouped_ranked_counts(inc, "district", "primary_type", top=k))
        assert "__part" in plan and "__slice" not in plan


def test_grouped_top_at_any_k(spark):
    from pyspark.sql import Window

    from blotter.operators.ranking import grouped_ranked_counts, nested_ranked_lists

    # 3 groups of 6,000 categories with many ties
    df = spark.range(27000).select((F.col("id") % 3).cast("string").alias("g"), ((F.col("id") / 3).cast("long") % 6000).cast("string").alias("k"))
    counts = df.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("g").orderBy(F.col("n").desc(), F.col("k").asc())
    expect = counts.withColumn("rk", F.row_number().over(w).cast("long"))
    for k in (10, 1001, 5000):
        got = grouped_ranked_counts(df, "g", "k", top=k)
        assert got.count() == 3 * k
        assert got.exceptAll(expect.where(F.col("rk") <= k)).count() == 0
    lists = nested_ranked_lists(df, "g", "k", top=1500).collect()
    assert sorted((r.g, len(r["items"])) for r in lists) == [("0", 1500), ("1", 1500), ("2", 1500)]


def test_crimes_join_no_customers(spark):
    from blotter.plans import catalog

    for name in ("clean_trim_nonempty", "crimes_by_year_nested"):
        plan = _plan(catalog.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "Join" not in plan and plan.count("Scan parquet") == 1


@pytest.mark.parametrize("top", [3, 1001, 5000])
def test_top_of_large_groups_by_a_limit_in_each_task(spark, top):
    # one group holds nearly all categories
    rows = spark.range(40_000).select(F.when(F.col("id") % 50 < 49, "hot").otherwise("cold").alias("g"), F.concat(F.lit("k"), F.col("id") % 9001).alias("k"))
    df = ranking.grouped_ranked_counts(rows, "g", "k", top=top)
    if top <= 1000:  # Spark's own bound for its limit before the shuffle
        assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    full = ranking.grouped_ranked_counts(rows, "g", "k")
    expect = sorted(tuple(r) for r in full.where(F.col("rk") <= top).collect())
    assert sorted(tuple(r) for r in df.select(*full.columns).collect()) == expect
    assert dict(df.dtypes)["rk"] == "bigint"
    lists = ranking.nested_ranked_lists(rows, "g", "k", top=top).collect()
    assert {r.g: [x.k for x in r["items"]] for r in lists} == {g: [k for _, k in sorted((r[3], r[1]) for r in expect if r[0] == g)] for g in ("hot", "cold")}
