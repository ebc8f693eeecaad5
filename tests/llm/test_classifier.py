"""Held-out accuracy, and moments against a direct computation."""

import zlib

import numpy as np

from ledgerspark.llm import classifier


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = classifier.scored(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len({y for _, y in held}) == 2
    assert np.mean([p == y for p, y in held]) >= 0.97


def test_scores_are_posteriors_of_two_normal_densities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, classifier.STATISTICS)) * rng.uniform(0.5, 2, classifier.STATISTICS)
    y = np.arange(400) % 4 > 0
    x[~y] = x[~y] * 2 + 0.5
    sums = {k: (lambda f: f.T @ f)(np.hstack([np.ones((400, 1)), x])[y == bool(k)]) for k in (0, 1)}
    model = classifier.fitted(sums, 0.1)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    spread = [np.cov(z[y == bool(k)].T, bias=True) for k in (0, 1)]
    pooled = np.diag(0.25 * np.diag(spread[0]) + 0.75 * np.diag(spread[1]))
    logs = []
    for k, prior in ((0, 0.25), (1, 0.75)):
        s = 0.9 * spread[k] + 0.1 * pooled + classifier.FLOOR * np.eye(classifier.STATISTICS)
        c = z - z[y == bool(k)].mean(0)
        logs.append(np.log(prior) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", c, np.linalg.inv(s), c))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_odd_rows(spark):
    docs = [(1, None, 3), (2, "", 3), (None, "word", 3), (4, "a b c", 3), (4, "a b c", 3), (5, " \n ", 3), (6, "|" * 200_000, 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (4, 1), (4, 0)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        rows = classifier.scored(df, given).collect()
        assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
        assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert classifier.scored(df.limit(0), labels).count() == 0
