import random

from helpers_llm import documents
from pyspark.sql import functions as F

from blotter.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


ROWS = [(1, "a"), (2, "a"), (3, "A"), (4, ""), (5, None), (6, " a"), (7, "b" * 50_000), (8, "b" * 50_000), (9, "a"), (10, "ß")]


def test_groups_against_brute_force(spark):
    assert result(exact_dedup.exact_groups(documents(spark, ROWS))) == brute(ROWS)


def test_a_digest_that_clashes_is_settled_by_content(spark):
    # the first hex digit as digest: nearly all texts clash
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(40)}") for i in range(300)]
    df = exact_dedup.exact_groups(documents(spark, rows), digest=lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1))
    assert result(df) == brute(rows)
    kept = exact_dedup.exact_dedup(documents(spark, rows), digest=lambda t: F.lit("same"))
    assert sorted(r.text for r in kept.collect()) == sorted({t for _, t in rows})


def test_hot_group(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    assert result(exact_dedup.exact_groups(documents(spark, rows).repartition(7))) == brute(rows)


def test_kept_documents_keep_their_columns(spark):
    df = documents(spark, ROWS).withColumn("kept", F.lit("mine")).withColumn("__keep", F.col("doc_id") * 2).withColumn("group_size", F.lit(1))
    out = exact_dedup.exact_dedup(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [3, 5, 6, 8, 9, 10]
    assert got[9].kept == "mine" and got[9]["__keep"] == 18 and got[5].text is None


def test_null_ids_ties_and_repeated_rows(spark):
    rows = [(None, "x"), (None, "x"), (3, "y"), (3, "y"), (None, "y"), (3, "z")]
    assert result(exact_dedup.exact_groups(documents(spark, rows))) == sorted(
        [(None, None, 2, True), (None, None, 2, True), (3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (3, 3, 1, True)], key=str
    )
    assert exact_dedup.exact_dedup(documents(spark, rows)).count() == 3


def test_empty_table(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0
    assert exact_dedup.exact_dedup(documents(spark, [])).count() == 0


def test_columns_that_cannot_be_compared(spark):
    rows = [(1, "a", 1), (2, "a", 2), (2, "a", 3), (3, None, 4), (4, "", 5), (None, "b", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    docs = docs.select("*", F.create_map(F.lit("k"), "k").alias("__row"), F.parse_json(F.concat(F.lit('{"k": '), "k", F.lit("}"))).alias("v"),
                       F.array(F.struct(F.create_map(F.lit("x"), "k").alias("m"))).alias("deep"))
    out = exact_dedup.exact_dedup(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    told = out.select("doc_id", "text", "k", F.col("__row")["k"].alias("m"), F.variant_get("v", "$.k", "int").alias("v"), F.col("deep")[0]["m"]["x"].alias("d"))
    assert sorted(told.collect(), key=lambda r: r.k) == [(2, "a", 3, 3, 3, 3), (4, "", 5, 5, 5, 5), (None, "b", 6, 6, 6, 6)]
