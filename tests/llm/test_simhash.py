"""SimHash classes against a brute-force version."""

import random

import pytest
import xxhash

from ledgerspark.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(rows):
    """rows: (id, fingerprint); the smallest id that each row can reach."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f"{f:016x}", least.get(find(f))) for i, f in rows), key=str)


def check(spark, docs, schema=SCHEMA):
    got = sorted(map(tuple, simhash.classes(spark.createDataFrame(docs, schema)).collect()), key=str)
    assert got == brute_classes([(d[0], brute_fingerprint(d[1])) for d in docs])


def test_whole_small_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    check(spark, docs)


def test_odd_rows(spark):
    long = " ".join(f"word{i % 977} Ärger" for i in range(70_000))
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (None, "one two"), (None, "alone in the world"), (9, long), (8, long)]
    check(spark, [(*d, None, None, None) for d in docs])
    check(spark, [])


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, "a b c d", 5, "x", 7), (2, "a b c d", 6, "y", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long, component_id string, root long")
    assert {tuple(r)[::2] for r in simhash.classes(df).collect()} == {(1, 1), (2, 1)}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [rows[0]]
    clashing = df.withColumnsRenamed({"fp": "__row", "root": "Row", "component_id": "__fp"})
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns and [tuple(r) for r in kept.collect()] == [rows[0]]


@pytest.mark.parametrize("crowd", [0, 2, 1000])
def test_links_connect_as_all_pairs_do(spark, crowd):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:4]:
        for _ in range(70):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.components(simhash.links(df, crowd), "src", "dst").collect()
    component = {f: f for f in signed} | {r["node"]: r["component"] for r in found}
    groups = {}
    for f in signed:
        groups.setdefault(component[f], set()).add(f % (1 << 64))
    wanted = {}
    for i, _, root in brute_classes([(f, f) for f in fps]):
        wanted.setdefault(root, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_keep_one_prefers_the_smallest_id_and_one_of_equal_rows(spark):
    docs = [(None, "a b c"), (4, "a b c"), (3, "a b c"), (3, "a b c"), (7, "something else here"), (None, "no id at all")]
    kept = simhash.keep_one(spark.createDataFrame([(*d, None, None, None) for d in docs], SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"]) == [(3, "a b c"), (7, "something else here")]
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id at all"]
