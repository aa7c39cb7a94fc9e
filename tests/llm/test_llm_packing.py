import random

from helpers_llm import documents, prose
from pyspark.sql import functions as F

from blotter.llm import packing


def brute_fit(sizes, sources, clusters, capacity):
    """Best fit by looking at every bin."""
    bins = []  # [free, sources, clusters]
    out = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fit = [(b[0], k) for k, b in enumerate(bins) if b[0] >= size and (s is None or s not in b[1]) and c not in b[2]]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        bins[k][0] -= size
        bins[k][1].add(s)
        bins[k][2].add(c)
        out.append(k)
    return out


def test_best_fit_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(0, 120)
        sizes = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        sources = [rng.choice(["hot", "hot", "a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.randint(0, 60) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 100) == brute_fit(sizes, sources, clusters, 100)


def check(rows, out, capacity):
    pieces, bins = {}, {}
    for i, t, s in rows:
        pieces.setdefault(i, []).append((t or "").split())
    seen = {}
    for r in out:
        seen.setdefault(r.doc_id, []).append((r.start_word, r.n_words))
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for i, texts in pieces.items():
        expect = sorted((at, min(capacity, len(w) - at)) for w in texts for at in range(0, max(len(w), 1), capacity))
        assert sorted(seen[i]) == expect
    source = {i: s for i, _, s in rows}
    for members in bins.values():
        members.sort(key=lambda r: r.position)
        assert [r.position for r in members] == list(range(len(members)))
        at = 0
        for r in members:
            assert r.bin_offset == at
            at += r.n_words
        assert at == members[0].bin_words <= capacity
        known = [source[r.doc_id] for r in members if source[r.doc_id] is not None]
        assert len(known) == len(set(known))
    return bins


def fixture():
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 90)), "hot" if i % 3 == 0 else rng.choice("abcdef")) for i in range(300)]
    rows += [(400, prose(rng, 1001), "a"), (401, prose(rng, 100), "b"), (402, "", "c"), (403, None, "c"), (404, "one", None)]
    rows += [(500 + i, "equal text", None) for i in range(12)] + [(600, "Equal  TEXT", None)]
    return rows


def test_pack(spark):
    rows = fixture()
    out = packing.pack(documents(spark, rows), capacity=100, group_pieces=64).collect()
    bins = check(rows, out, 100)
    for members in bins.values():
        assert sum(r.doc_id >= 500 for r in members) <= 1  # one cluster
    assert [r.bin_id for r in out if r.doc_id in (402, 403)] == [None, None]
    sizes = [m[0].bin_words for m in bins.values()]
    assert sum(sizes) == sum(len((t or "").split()) for _, t, _ in rows)


def test_texts_of_pieces(spark):
    rows = fixture()
    out = packing.pack(documents(spark, rows), capacity=100, with_text=True).collect()
    text = {i: t or "" for i, t, _ in rows}
    for r in out:
        assert r.text.split() == text[r.doc_id].split()[r.start_word : r.start_word + r.n_words]
        assert r.text in text[r.doc_id]


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(7, "a b c", "s")] * 4 + [(None, "d e", None)] * 2
    out = packing.pack(documents(spark, rows), capacity=10).collect()
    assert len(out) == 6
    assert len({r.bin_id for r in out if r.doc_id == 7}) == 4
    assert len({r.bin_id for r in out if r.doc_id is None}) == 2
    empty = packing.pack(documents(spark, []))
    assert empty.count() == 0 and "bin_id" in empty.columns


def test_clashing_column_names(spark):
    docs = documents(spark, [(1, "a b", "s"), (2, "c", "t")]).withColumns({"bin_id": F.lit("x"), "__row": F.lit(0), "piece": F.lit(3)})
    assert packing.pack(docs, capacity=5).count() == 2


def test_large_ids_beside_a_null_id_stay_exact(spark):
    big = 2**53 + 1
    rows = [(None, "a b c", "s"), (big, "d e", "t"), (big + 2, "f", "u"), (-big, "", "v"), (2**63 - 1, "g h i j", "w")]
    out = packing.pack(documents(spark, rows), capacity=10, with_text=True).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(((i, t) for i, t, _ in rows), key=str)
    assert [r.bin_id for r in out if r.doc_id == -big] == [None]


def test_a_very_long_text_is_cut_into_pieces(spark):
    words = [f"w{i}" for i in range(50_000)]
    out = packing.pack(documents(spark, [(1, " ".join(words), "s"), (2, "x", "t")]), capacity=2048, group_pieces=4, with_text=True).collect()
    own = sorted((r for r in out if r.doc_id == 1), key=lambda r: r.piece)
    assert " ".join(r.text for r in own) == " ".join(words) and len(own) == 25
    assert len({r.bin_id for r in own}) == 25  # one source, one piece a bin


def test_text_ids(spark):
    rows = [("b", "x y", "s"), (None, "z", "t"), ("a", "x", "s")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert {r.doc_id for r in packing.pack(docs, capacity=4).collect()} == {"a", "b", None}
