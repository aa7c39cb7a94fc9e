import math
import random
import re
from collections import defaultdict

import pytest
from helpers_llm import documents, prose

from blotter.llm import mixing


def brute_seats(weights, seats):
    """Sainte-Laguë one seat at a time; ties to the first."""
    got = [0] * len(weights)
    for _ in range(seats):
        best = max((w / (2 * got[i] + 1.0), -i) for i, w in enumerate(weights))
        got[-best[1]] += 1
    return got


def brute_targets(sizes, weights, most=3):
    """Iterated sharing with a cap."""
    total, open_ = sum(sizes), set(range(len(sizes)))
    target = [0.0] * len(sizes)
    while True:
        rest = total - sum(most * sizes[i] for i in range(len(sizes)) if i not in open_)
        w = sum(weights[i] for i in open_)
        for i in open_:
            target[i] = rest * weights[i] / w
        full = {i for i in open_ if target[i] > most * sizes[i]}
        for i in range(len(sizes)):
            if i not in open_ or i in full:
                target[i] = most * sizes[i]
        open_ -= full
        if not full or not open_:
            return target


def test_apportion_is_sainte_lague(spark):
    rng = random.Random(2)
    rows, expect = [], {}
    for g in range(12):
        weights = [rng.choice([0, 1, 2, 3, 50, 1000]) for _ in range(rng.randint(1, 9))]
        if not sum(weights):
            weights[0] = 1
        seats = rng.randint(0, 400)
        rows += [(g, i, w, seats) for i, w in enumerate(weights)]
        expect |= {(g, i): s for i, s in enumerate(brute_seats(weights, seats))}
    df = spark.createDataFrame(rows, "g int, i int, w long, q long")
    got = {(r.g, r.i): r.seats for r in mixing.apportion(df, ["g"], ["i"], "w", "q", "seats").collect()}
    assert got == expect


def some_documents(seed=3, n=240):
    rng = random.Random(seed)
    names = ["a", "b", "c", "d", "é", None]
    rows = [(i, prose(rng, rng.randint(0, 120)), "a" if i % 3 == 0 else rng.choice(names)) for i in range(n)]
    return rows + [(900, None, "b"), (901, "", "only empty"), (None, "one two", "c"), (None, "one two", "c"), (902, " \t lead and trail \n", "d")]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_plan(spark):
    rows = some_documents()
    out = mixing.mix_plan(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, brute_targets([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(0.03 * target[s], 2 * mixing.BLOCK)
    again = mixing.mix_plan(documents(spark, rows).repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mix_repeats_and_cuts(spark):
    rows = [r for r in some_documents() if r[0] is not None]
    docs = documents(spark, rows)
    plan = {r.doc_id: r.taken for r in mixing.mix_plan(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    got, text = defaultdict(int), {i: t for i, t, _ in rows}
    for r in out.collect():
        assert text[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got[r.doc_id] += words(r.text)
    assert got == {i: t for i, t in plan.items() if t}


def test_a_source_that_weighs_more_than_it_holds(spark):
    rows = [(0, "x " * 10, "a"), (1, "y " * 1000, "b")]
    out = {r.doc_id: r for r in mixing.mix_plan(documents(spark, rows)).collect()}
    assert out[0].target == 30 and out[0].taken == 30
    assert out[1].target == pytest.approx(980) and math.isclose(out[1].taken, 980, abs_tol=mixing.BLOCK)


def test_small_sources_of_short_documents_reach_their_target(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(1, 5), "a") for i in range(30)] + [(100 + i, "v " * (1 + i % 5), "c") for i in range(200)]
    rows += [(1000 + i, "x " * 60, "b") for i in range(1200)] + [(5000 + i, "", "a") for i in range(400)]
    out = mixing.mix_plan(documents(spark, rows)).collect()
    source, taken, target = {i: s for i, _, s in rows}, defaultdict(int), {}
    for r in out:
        assert r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(0.97 * target[s] <= taken[s] <= target[s] + mixing.BLOCK for s in target), (dict(taken), target)


def test_cells_of_a_small_source_share_a_shard(spark):
    cells = spark.createDataFrame([("1a", c, 100) for c in range(50)] + [("1b", c, 5000) for c in range(50)], "__key string, __cell long, __size long")
    rows = mixing.joined_cells(cells, 1000).collect()
    assert {r["__shard"] for r in rows if r["__key"] == "1a"} == set(range(5))
    assert all(r["__shard"] == r["__cell"] and r["__before"] == 0 for r in rows if r["__key"] == "1b")
    assert sorted(r["__before"] for r in rows if r["__key"] == "1a" and r["__shard"] == 2) == list(range(0, 1000, 100))


def test_empty_tables_and_texts(spark):
    assert mixing.mix_plan(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).count() == 0
    only = mixing.mix_plan(documents(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [(r.size, r.taken, r.target) for r in only] == [(0, 0, 0.0)] * 2


def test_extra_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(i, "w " * 40, "a") for i in range(5)]).withColumns({"target": F.lit("t"), "size": F.lit(-1), "taken": F.lit("x")})
    assert mixing.mix(docs).columns == docs.columns
    assert {r.size for r in mixing.mix_plan(docs).collect()} == {40}
