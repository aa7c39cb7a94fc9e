"""The stages one after another against plain Python on the smallest tables."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline as P
from blotter.llm import packing, toxicity
from blotter.llm.common import materialize, table
from test_llm_minhash import brute as near_brute
from test_llm_mixing import brute_targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["documents"] = docs
    for name, stage in P.STAGES:
        docs = out[name] = materialize(stage(spark, docs, SF), f"test-{name}")
    return out


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "minhash", "mixing", "packing"]
    for name, _ in P.STAGES[:-1]:
        assert stages[name].schema.simpleString() == stages["documents"].schema.simpleString()


def test_toxicity_stage(spark, stages):
    model = toxicity.train(stages["documents"], table(spark, SF, "labels"))
    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(stages["documents"], model).collect()}
    assert sorted(r.doc_id for r in stages["toxicity"].collect()) == sorted(i for i, p in predicted.items() if not p)
    assert sum(predicted.values()) < 0.2 * len(predicted)


def test_exact_stage(stages):
    best = {}
    for r in stages["toxicity"].collect():
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages["exact_dedup"].collect()) == sorted(best.values())


def test_near_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages["exact_dedup"].collect()]
    expect = near_brute(rows)
    assert sorted(r.doc_id for r in stages["minhash"].collect()) == sorted(i for i, (_, c) in expect.items() if i == c)


def test_mixing_stage(stages):
    before, after = defaultdict(int), defaultdict(int)
    for r in stages["minhash"].collect():
        before[r.source] += words(r.text)
    for r in stages["mixing"].collect():
        after[r.source] += words(r.text)
    order = sorted(before)
    targets = brute_targets([before[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    for s, t in zip(order, targets, strict=True):
        assert abs(after[s] - t) <= max(0.03 * t, 64)


def test_packing_stage(stages):
    total = sum(words(r.text) for r in stages["mixing"].collect())
    rows = stages["packing"].collect()
    assert sum(r.n_words for r in rows) == total
    used = defaultdict(int)
    for r in rows:
        used[r.bin_id] += r.n_words
    assert max(used.values()) <= packing.CAPACITY
    assert all(words(r.text) == r.n_words for r in rows)


def test_run_is_the_last_stage(spark, stages):
    out = P.run(spark, SF)
    assert out.schema.simpleString() == stages["packing"].schema.simpleString()
    key = lambda r: (r.doc_id, r.piece, r.n_words)
    assert sorted(map(key, out.collect())) == sorted(map(key, stages["packing"].collect()))
