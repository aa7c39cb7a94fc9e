import random

import numpy as np
from pyspark.sql import functions as F

from blotter.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k):
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if not is_query(i):
            continue
        best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in usable if j != i)[:k]  # noqa: B905 - shorter ends in zeros
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0, **options).collect())


def fixture(n=300, dims=8):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]
    rows += [(1000 + i, [0.25] * dims) for i in range(60)]  # ties
    rows += [(2000, None), (2005, [None] * dims), (2010, [float("nan")] * dims), (2015, [float("inf")] + [0.0] * (dims - 1)), (2020, []), (2025, [0.5]), (None, [1.0] * dims)]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    expect = brute(rows, lambda i: i % 5 == 0, 5)
    assert run(spark, rows, k=5) == expect
    assert run(spark, rows, k=5, block=16, tile=3, group=7) == expect


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.0]), (7, [-1.0, 0.0])]
    assert run(spark, rows, k=5) == brute(rows, lambda i: i % 5 == 0, 5)
    assert run(spark, [(0, [1.0])], k=5) == []
    assert run(spark, [], k=5) == []


def test_blocks_are_pruned():
    rng = np.random.default_rng(4)
    # neighbouring ids point the same way: the bounds of other blocks fall short
    centres = rng.normal(0, 300, (20, 16))
    m = np.concatenate([c + rng.normal(0, 10, (50, 16)) for c in centres]).astype(np.int64)
    ids = np.arange(1000)
    tile = [(ids[i : i + 50], m[i : i + 50], m[i : i + 50].max(0), m[i : i + 50].min(0)) for i in range(0, 1000, 50)]
    found, scores, scored = topk.search(ids[:100], m[:100], tile, 5)
    assert scored < 0.4 * 100 * 20
    full = m[:100] @ m.T
    full[np.arange(100), np.arange(100)] = np.iinfo(np.int64).min
    assert (np.sort(scores, axis=1) == np.sort(full, axis=1)[:, -5:]).all()


def test_large_components_stay_exact():
    a, b = np.array([[2**40, 3]]), np.array([[2**40, 5]])
    assert topk._exact(a, b)[0, 0] == np.iinfo(np.int64).max  # held to a long
    assert topk._exact(np.array([[2**30, 1]]), np.array([[2**30, 1]]))[0, 0] == 2**60 + 1


def test_repeated_rows(spark):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (5, [0.5, 0.0]), (6, [0.5, 0.0]), (6, [0.5, 0.0])]
    assert run(spark, rows, k=5) == [(0, 1, 5, 32768), (0, 2, 6, 32768), (0, 3, 6, 32768), (5, 1, 0, 32768), (5, 2, 0, 32768), (5, 3, 6, 16384), (5, 4, 6, 16384)]


def test_clashing_column_names(spark):
    rows = fixture(30)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns({"v": F.lit(1), "score": F.lit("x"), "no": F.lit(2), "rank": F.lit(3)})
    out = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0).collect())
    assert out == brute(rows, lambda i: i % 5 == 0, 5)


def test_queries_travel_only_to_tiles_that_may_serve_them(spark):
    rng = random.Random(5)
    # neighbouring ids point the same way
    rows = []
    for c in range(20):
        centre = [rng.gauss(0, 1.0) for _ in range(16)]
        rows += [(50 * c + i, [x + rng.gauss(0, 0.03) for x in centre]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    _, asking = topk.reached(topk.usable(df), F.col("vec_id") % 5 == 0, block=10, tile=2, group=32)
    index, _ = topk.reached(topk.usable(df), F.col("vec_id") % 5 == 0, block=10, tile=2, group=32)
    tiles = index.select("tile").distinct().count()
    pairs = asking.select(F.sum(F.size("ids"))).first()[0]
    assert pairs < 0.4 * 200 * tiles
    assert run(spark, rows, block=10, tile=2, group=32) == brute(rows, lambda i: i % 5 == 0, 5)


def test_many_queries_that_start_from_one_block(spark):
    rows = [(i, [1.0, float(i % 3)]) for i in range(120)]  # every query meets the same few scores
    rows += [(1000 + i, [9.0, 9.0]) for i in range(12)]
    expect = brute(rows, lambda i: i % 5 == 0, 5)
    assert run(spark, rows, block=12, tile=1, group=4) == expect


def test_more_parts_than_one(spark, monkeypatch):
    monkeypatch.setattr(topk, "SUMMARY", 2)
    rows = fixture()
    assert run(spark, rows, block=16, tile=3, group=7) == brute(rows, lambda i: i % 5 == 0, 5)


def test_bounds_of_large_components():
    q = np.array([[-(2**62), 2**62]])
    assert topk.bounds(q, np.array([[-(2**40), 2**40]]), np.array([[-(2**40), 2**40]]))[0, 0] == np.iinfo(np.int64).max
