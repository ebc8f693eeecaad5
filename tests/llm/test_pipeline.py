"""The pipeline against brute-force stages on a small folder of tables."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerspark.llm.queries import vocabulary_file
from tests.llm import brute


def stages(docs, labels, items):
    """Rows of every stage. docs: (id, text), ids different and not null."""
    quality = {}
    for i, q in labels:
        quality.setdefault(i, set()).add(q)
    kept = [d for d, k in zip(docs, brute.quality_kept(docs, {i for i, q in quality.items() if q == {1}})) if k]
    yield kept
    kept = brute.without_lines(kept)
    yield kept
    roots = brute.near_classes([(i, brute.fingerprint(t)) for i, t in kept])
    first = {}
    for (i, _), r in zip(kept, roots):
        first[r] = min(i, first.get(r, i))
    kept = [d for d, r in zip(kept, roots) if first[r] == d[0]]
    yield kept
    hit = {i for i, *_ in brute.leaked(kept, items)}
    kept = [d for d in kept if d[0] not in hit]
    yield kept
    library = Tokenizer.from_file(vocabulary_file())
    library.no_truncation()
    library.no_padding()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for i, t in kept:
        ids = library.encode(t, add_special_tokens=False).ids
        out.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    yield out


def test_stages_equal_brute_force(spark, sf_dir):
    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]
    want = stages(read("documents", "doc_id", "text"), read("labels", "doc_id", "quality"), read("benchmark", "item_id", "text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want):
        docs = corpus_pipeline.shared.store(stage(spark, docs, sf_dir), name)
        got = docs if name == "bpe_encoding" else docs.select("doc_id", "text")
        assert sorted(map(tuple, got.collect())) == sorted(rows), name


@pytest.mark.parametrize("empty", [True, False])
def test_odd_tables(spark, tmp_path, empty):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(None, words, "en", 1), (1, None, None, None), (1, words, "en", 2), (1, words, "en", 2), (2, words + " more", None, 3), (3, "other " + " ".join(f"v{i}" for i in range(90_000)), "x", 4)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, key string, component int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([] if empty else [(1, 1), (None, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([] if empty else [(1, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == ([] if empty else [1, 3])
