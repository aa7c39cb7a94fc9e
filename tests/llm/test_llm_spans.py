import random

import pytest
from helpers_llm import documents
from pyspark.sql import functions as F

from blotter.llm import spans


def sentence(rng, n, mark="."):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n)) + mark


def text(rng, sentences):
    return " ".join(sentence(rng, rng.randint(1, 14), rng.choice(".!?;")) for _ in range(sentences))


def brute(rows):
    """{doc_id: covered sentence numbers} by comparing the runs as word lists."""
    first, found = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        parts = [p[3] for p in spans.sentences(t or "")]
        for at in range(len(parts)):
            end, words = at, 0
            while end < len(parts) and (end - at < spans.MIN_SENTENCES or words < spans.MIN_WORDS):
                words += len(parts[end].split())
                end += 1
            if end - at < spans.MIN_SENTENCES or words < spans.MIN_WORDS:
                continue
            found.append((tuple(parts[at:end]), i, at, end))
    for key, i, at, _ in found:
        place = (i is None, i or 0, at)
        first[key] = min(first.get(key, place), place)
    covered = {}
    for key, i, at, end in found:
        if first[key] != (i is None, i or 0, at):
            covered.setdefault(i, set()).update(range(at, end))
    return covered


def fixture():
    rng = random.Random(12)
    shared = [text(rng, 9) for _ in range(4)]
    rows = []
    for i in range(120):
        t = text(rng, rng.randint(0, 14))
        for _ in range(rng.randint(0, 2)):
            t = t + " " + rng.choice(shared) + "\n" + text(rng, 3)
        rows.append((i, t))
    long_line = " ".join(f"v{rng.randrange(9000)}" for _ in range(80))  # no marks at all
    rows += [(200, long_line), (201, "before " + long_line + " after it"), (202, None), (203, ""), (204, "..!?\n"), (205, shared[0] + " " + shared[0])]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = fixture()
    expect = brute(rows)
    out = {r.doc_id: r for r in spans.span_dedup(documents(spark, rows)).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        gone = expect.get(i, set())
        assert out[i].sentences_removed == len(gone), i
        if not gone:
            assert out[i].text == t
        else:
            parts = spans.sentences(t)
            left = [p[3] for k, p in enumerate(parts) if k not in gone]
            assert " ".join(out[i].text.lower().split()) == " ".join(left)
            assert out[i].words_removed == sum(parts[k][2] for k in gone)


def test_a_planted_passage_stays_once(spark):
    rng = random.Random(4)
    passage = " ".join(sentence(rng, 9) for _ in range(8))
    rows = [(i, f"{text(rng, 6)} {passage} {text(rng, 6)}") for i in range(40)] + [(100 + i, text(rng, 12)) for i in range(40)]
    out = {r.doc_id: r.text for r in spans.span_dedup(documents(spark, rows)).collect()}
    assert sum(passage in t for t in out.values()) == 1 and passage in out[0]
    for i in range(1, 40):
        left = sum(s.strip() in out[i] for s in passage.split(". ")[1:-1])
        assert left == 0
    assert all(out[i] == t for i, t in rows if i >= 100)


def test_passage_inside_a_sentence(spark):
    # the first and last sentences of the passage run into their neighbours
    rng = random.Random(5)
    passage = " ".join(sentence(rng, 8) for _ in range(8))[:-1]
    rows = [(i, f"{sentence(rng, 5, '')} {passage} {sentence(rng, 5)}") for i in range(5)]
    out = {r.doc_id: r for r in spans.span_dedup(documents(spark, rows)).collect()}
    assert out[0].words_removed == 0
    assert all(out[i].words_removed >= 48 for i in range(1, 5))


def test_sentences_cover_the_text():
    rng = random.Random(6)
    for _ in range(50):
        t = "".join(rng.choice(["word ", "x. ", "\n", "a; b ", "é? ", "  ", "!!!"]) for _ in range(rng.randint(0, 60)))
        end = 0
        for s, e, n, normal in spans.sentences(t):
            assert s >= end and not t[end:s].strip()
            assert " ".join(t[s:e].lower().split()) == normal and n == len(normal.split())
            end = e
        assert not t[end:].strip()


@pytest.mark.parametrize("extra", ["sentences_removed", "hi", "size", "at", "__of", "__covered", "__Own_Text"])
def test_clashing_names_null_ids_and_repeated_rows(spark, extra):
    rng = random.Random(7)
    t = text(rng, 10)
    docs = documents(spark, [(None, t), (1, t), (1, t), (2, t)]).withColumn(extra, F.lit("mine"))
    out = sorted(((r.doc_id, r.sentences_removed > 0) for r in spans.span_dedup(docs).collect()), key=str)
    if extra == "sentences_removed":
        out = sorted(((r.doc_id, r.words_removed > 0) for r in spans.span_dedup(docs).collect()), key=str)
    assert out == [(1, False), (1, False), (2, True), (None, True)]


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_that_share_an_id_lose_their_own_repeats_only(spark, shared):
    rng = random.Random(8)
    passages = [text(rng, 9) for _ in range(4)]
    rows = [(1, f"{text(rng, 3)} {passages[0]}"), (2, f"{text(rng, 5)} {passages[1]} {text(rng, 2)}")]
    alone = [text(rng, 14) for _ in range(6)]
    rows += [(shared, t) for t in alone]
    copies = [f"{text(rng, 4)} {passages[0]} {text(rng, 4)}", f"{passages[1]} {text(rng, 6)}", f"{text(rng, 3)} {passages[2]}", f"{text(rng, 4)} {passages[2]}"]
    rows += [(shared, t) for t in copies]
    out = spans.span_dedup(documents(spark, rows).repartition(3)).collect()
    assert sorted(len(r.text) for r in out if r.doc_id != shared) == sorted(len(t) for i, t in rows if i != shared)
    left = [r.text for r in out if r.doc_id == shared]
    assert len(left) == len(alone) + len(copies)
    assert set(alone) <= set(left)  # no repeat, nothing goes
    assert sum(r.words_removed > 0 for r in out) == 3  # of two copies of the third passage one stays
    assert sum(passages[0] in t for t in left) == sum(passages[1] in t for t in left) == 0
    assert sum(passages[2] in t for t in left) == 1


def test_empty_table(spark):
    assert spans.span_dedup(documents(spark, [])).count() == 0


def unmarked(rng, n, name="u", blank=" "):
    return blank.join(f"{name}{rng.randrange(50000)}" for _ in range(n))


def found_words(passage, before, after):
    """Words of the second of two texts around a passage that its runs shared
    with the first one cover."""
    parts = [spans.sentences(f"{b}{passage}{a}") for b, a in zip(before, after, strict=True)]
    (hi_a, lo_a), (hi_b, lo_b) = map(spans.runs, parts)
    known = set(zip(hi_a, lo_a, strict=True))
    gone = set()
    for at, key in enumerate(zip(hi_b, lo_b, strict=True)):
        if key in known:
            gone.update(range(at, at + (key[1] & 15) + 1))
    return sum(parts[1][k][2] for k in gone)


@pytest.mark.parametrize("marks", [False, True])
def test_any_51_words_hold_a_whole_run(marks):
    for seed in range(1500):
        rng = random.Random(seed)
        words = unmarked(rng, 51).split()
        if marks:
            for k in range(rng.randrange(5, 25), 50, 24):
                words[k] += "."
        around = [[unmarked(rng, rng.randint(0, 30), "c") for _ in range(2)] for _ in range(2)]
        before = [f"{x} " for x in around[0]]
        after = [f"{rng.choice(['', '.'])} {x}" for x in around[1]]
        assert found_words(" ".join(words), before, after) >= 16, seed


def test_any_51_words_of_few_different_ones_hold_a_whole_run():
    for seed in range(500):
        rng = random.Random(seed)
        passage = " ".join(rng.choice("abcd") for _ in range(51))
        assert found_words(passage, ["x y ", "z "], [" x y", ". z"]) >= 16, seed


def test_scripts_without_blanks():
    for seed in range(300):
        rng = random.Random(seed)
        han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))  # noqa: E731, B023
        assert found_words(han(200), [han(30), han(5)], [han(9), han(40)]) >= 16, seed


def test_unmarked_passages_go_from_all_but_the_first(spark):
    rng = random.Random(9)
    rows = []
    for k in range(60):
        passage = unmarked(rng, 51)
        rows += [(2 * k + j, f"{unmarked(rng, rng.randint(1, 30), 'c')} {passage} {unmarked(rng, rng.randint(1, 30), 'c')}") for j in (0, 1)]
    out = {r.doc_id: r for r in spans.span_dedup(documents(spark, rows)).collect()}
    for i, t in rows:
        if i % 2 == 0:
            assert out[i].text == t
        else:
            assert out[i].words_removed > 25, i
            assert [w for w in out[i].text.split() if w[0] == "c"] == [w for w in t.split() if w[0] == "c"]
