import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers_llm import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm import catalog, wavelet

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = wavelet.Encoder(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    ids, sizes = ENCODER.batch(pa.array(texts, type=pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def brute(rows):
    """rows in order of doc_id -> (doc_id, start, n_tokens, ids_crc32)."""
    out, start = [], 0
    for i, text in rows:
        ids = np.array([*plain_ids(text), 1], dtype="<u4")
        out.append((i, start, len(ids), crc32(ids.tobytes())))
        start += len(ids)
    return out


def run(docs, **options):
    df = wavelet.token_files(docs, PATH, **options)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return [tuple(r) for r in df.orderBy("start").collect()]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = catalog.queries()["op11_wavelet"](spark, SF).orderBy("start").collect()
    assert [tuple(r) for r in found] == brute([tuple(r) for r in docs])


def test_small_shards_and_long_documents(spark):
    rng = random.Random(1)
    rows = [(i * 3 - 50, prose(rng, rng.choice([1, 5, 40, 3000]))) for i in range(60)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    for shard_ids in (1, 700, 1 << 22):
        assert run(documents(spark, shuffled).repartition(5), shard_ids=shard_ids, block_bits=64) == brute(rows)


def test_nulls_empty_texts_and_empty_table(spark):
    rows = [(None, "first of all"), (1, None), (2, ""), (3, " \t\n "), (4, "<|endoftext|> and <|ENDOFTEXT|>"), (5, "a\x00b")]
    assert run(documents(spark, rows[::-1])) == brute(rows)
    assert run(documents(spark, [])) == []


def test_repeated_ids_keep_every_row(spark):
    rng = random.Random(2)
    rows = [(7, prose(rng, 30)) for _ in range(40)] + [(8, "same text")] * 3
    found = run(documents(spark, rows), shard_ids=200)
    assert sorted((r[0], r[2], r[3]) for r in found) == sorted((r[0], r[2], r[3]) for r in brute(rows))
    assert [r[1] for r in found] == np.concatenate([[0], np.cumsum([r[2] for r in found])])[:-1].tolist()


def test_clashing_column_names(spark):
    rows = [(1, "one two"), (2, "three")]
    docs = documents(spark, rows).withColumns({"place": F.lit(1), "shard": F.lit("s"), "n": F.lit(None), "start": F.lit(2), "blob": F.lit(3)})
    assert run(docs) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aAbsStT'I.,! \t\n\x0b\x1c\x00\x85\xa0éÉßİΣςКK"), st.characters(codec="utf-8")), max_size=12), min_size=1, max_size=6))
def test_encoder_equals_the_tokenizer_on_whole_texts(texts):
    assert encoded(texts) == [plain_ids(t) for t in texts]


def test_capitals_before_combining_marks():
    texts = ["İ", "J̌ x", "ÅA", "é É", "!İ!", "x <|startoftext|>y"]
    assert encoded(texts) == [plain_ids(t) for t in texts]


def test_encoder_forgets_when_it_is_full(monkeypatch):
    monkeypatch.setattr(wavelet, "KNOWN_WORDS", 50)
    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(20)]
    for t in texts:
        assert encoded([t, "again"]) == [plain_ids(t), plain_ids("again")]


@pytest.mark.parametrize("largest", [0, 1, 5, 49407, 1 << 20])
def test_access_count_and_find(largest):
    rng = np.random.default_rng(largest)
    ids = np.minimum(rng.zipf(1.4, 700) - 1, largest).astype(np.uint32)
    m = wavelet.WaveletMatrix(wavelet.build(ids, [300, 400], block_bits=64))
    assert m.ids().tolist() == ids.tolist() and m.lengths.tolist() == [300, 400]
    assert [m.access(i) for i in range(len(ids))] == ids.tolist()
    for token in {*ids.tolist()[:60], largest, largest + 1, 1 << 30}:
        places = np.flatnonzero(ids == token).tolist()
        assert m.count(token) == len(places)
        assert m.count(token, 100, 400) == sum(100 <= p < 400 for p in places)
        assert [m.find(token, k) for k in range(len(places) + 1)] == [*places, -1]
    assert m.count(0, 5, 5) == 0 and m.find(0, -1) == -1
    with pytest.raises(IndexError):
        m.access(len(ids))


def test_planes_are_smaller_than_plain_ids():
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, 200_000), 49407).astype(np.uint32)
    assert len(wavelet.build(ids, [len(ids)])) < 0.8 * 2 * len(ids)


def test_one_file_per_shard(spark, tmp_path):
    rng = random.Random(5)
    docs = documents(spark, [(i, prose(rng, 50)) for i in range(30)])
    wavelet.write_shards(docs, PATH, str(tmp_path / "shards"), shard_ids=300)
    files = [f for f in (tmp_path / "shards").iterdir() if f.name.endswith(".parquet")]
    rows = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert len(files) == len(rows) > 5
    with pytest.raises(ValueError, match="wavelet"):
        wavelet.WaveletMatrix(b"nothing")


def test_batches_are_tokenised_in_pieces(monkeypatch):
    monkeypatch.setattr(wavelet, "PIECE_BYTES", 20)
    texts = ["a few words", None, "", "one text that is longer than a whole piece of the batch", "x", "another few words", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, type=pa.string())})
    pieces = list(wavelet._pieces(batch))
    assert len(pieces) > 2 and pa.Table.from_batches(pieces).to_pydict() == batch.to_pydict()
    assert [p.num_rows for p in wavelet._pieces(batch.slice(0, 0))] == [0]
    encoder = wavelet.Encoder(PATH)
    ids, lengths = encoder.batch(batch.column("text"))
    parts = [wavelet.Encoder(PATH).batch(p.column("text")) for p in pieces]
    assert np.concatenate([p[0] for p in parts]).tolist() == ids.tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == lengths.tolist()


def test_words_and_the_marks_after_them_are_learnt_apart():
    encoder = wavelet.Encoder(PATH)
    texts = ["straße straße. Straße,*** éa!! Éa Éa.%%%", "straße?", "don't. x2. (straße) 'tis.'s ÷. É́a. İa. ×. ...", "a)\" a<. a.b. ."]
    ids, sizes = encoder.batch(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [plain_ids(t) for t in texts]
    assert {"straße", "éa", "Éa", ",***", ".%%%"} <= encoder.known.keys()
    assert not {"straße.", "straße,***", "straße?", "éa!!", "Éa.%%%"} & encoder.known.keys()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzAÀÉØßéÿ÷×ªµ̸́.,;:!?#$%&*)\"'<|> 2ſ"), max_size=14), min_size=1, max_size=6))
def test_plain_words_with_marks_equal_the_tokenizer(texts):
    assert encoded(texts) == [plain_ids(t) for t in texts]


def test_a_tokenizer_without_word_ends_takes_words_whole():
    encoder = wavelet.Encoder(PATH)
    encoder._load()
    encoder.closing = None
    ids, _ = encoder.batch(pa.array(["straße. straße, again"]))
    assert ids.tolist() == plain_ids("straße. straße, again") and "straße." in encoder.known
