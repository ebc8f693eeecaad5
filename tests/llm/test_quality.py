"""Counts and log-likelihood ratios against plain Python."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import quality
from tests.llm import brute


def check(spark, docs, labels):
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, kept int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weight = quality.weights(df, quality.trusted_ids(known))
    got = sorted((tuple(r) for r in quality.judged(df, weight).collect()), key=str)
    by_id = {}
    for i, q, _ in labels:
        by_id.setdefault(i, set()).add(q)
    trusted = {i for i, q in by_id.items() if i is not None and min((x for x in q if x is not None), default=0) == 1}
    want = []
    for (i, text), score, kept in zip(docs, brute.quality_scores(docs, trusted), brute.quality_kept(docs, trusted)):
        n, chars, symbols, lines, again = brute.quality_counts(text)
        want.append((i, n, chars, symbols, lines, again, pytest.approx(score, abs=1e-9), n < 50 or 100 * again > 50 * n, kept))
    assert len(got) == len(want)
    for w in want:
        assert [r[6:] for r in got if r[:6] == w[:6]].count(w[6:]) >= 1
    kept = quality.filtered(df, weight)
    assert kept.columns == df.columns and kept.count() == sum(w[-1] for w in want)


def test_whole_small_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, docs, [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()])


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a"), (5, "x y"), (6, words), (7, words + "\n" + words), (7, words), (None, words + " end"), (8, "a b " * 50_000), (9, "é\n\n \né\n# <|> $")]
    check(spark, docs, [(6, 1, 0), (6, 1, 0), (7, 0, 0), (None, 1, 0), (5, None, 0)])
    check(spark, docs, [])
    check(spark, [], [])


def test_junk_goes_and_prose_stays(spark):
    d = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = quality.judged(documents, quality.weights(documents, quality.trusted_ids(labels))).join(labels, "doc_id").where("NOT base_failed").collect()
    assert {(r["quality"] == 1) == r["kept"] for r in rows} == {True}


def test_hashes_are_computed_once_and_before_they_are_taken_apart(spark, capsys):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, "")], "doc_id long, text string")
    found = quality.bucket_counts(df, df.where("doc_id = 1"))
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("regexp_extract_all") == 1
    assert not any("lambda" in line for line in plan.splitlines() if "Generate" in line)
    counts = [(r["raw"], r["target"]) for r in found.collect()]
    assert sum(raw for raw, _ in counts) == 5 and all(raw == target for raw, target in counts)


def many(spark):
    """6,000 trusted documents with a word of their own, and 3,000 others."""
    row = F.when(F.col("id") < 6000, F.concat(F.lit("w"), F.col("id"))).otherwise("junk")
    documents = spark.range(9000).select(F.col("id").alias("doc_id"), row.alias("text"))
    labels = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 6000, 1).otherwise(0).alias("quality"))
    return documents, labels


def test_all_trusted_documents_count(spark):
    documents, labels = many(spark)
    trusted = quality.trusted_ids(labels)
    assert sorted(r["doc_id"] for r in trusted.collect()) == list(range(6000))
    (found,) = quality.bucket_counts(documents, trusted).agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    assert (found["raw"], found["target"]) == (9000, 6000)


def test_trusted_ids_too_many_for_a_broadcast_are_shuffled(spark, monkeypatch, capsys):
    documents, labels = many(spark)
    documents = documents.union(documents.where("doc_id < 2")).union(documents.where("doc_id = 0").selectExpr("CAST(NULL AS BIGINT)", "text"))
    want = sorted(map(tuple, quality.bucket_counts(documents, quality.trusted_ids(labels)).collect()))
    assert sum(t for _, _, t in want) == 6002 and sum(r for _, r, _ in want) == 9003
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(quality, "MOST_BROADCAST", 100)
    try:
        found = quality.bucket_counts(documents, quality.trusted_ids(labels))
        found.explain()
        assert "Broadcast" not in capsys.readouterr().out
        assert sorted(map(tuple, found.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
