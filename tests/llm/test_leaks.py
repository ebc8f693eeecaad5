"""Spaced seeds against plain Python; the whole table is compared with SQL elsewhere."""

import math
import random

import pytest

from ledgerspark.llm import leaks
from tests.llm import brute


def check(spark, docs, items):
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, no int")
    bench = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, row int")
    got = sorted(map(tuple, leaks.contaminated(df, bench).collect()))
    want = brute.leaked(docs, items)
    assert got == want
    kept = leaks.clean(df, bench)
    assert kept.columns == df.columns
    hit = {i for i, *_ in want}
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted((i, t) for i, t in docs if i not in hit)
    return hit


def test_substituted_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 16, 30, 60])))) for i in range(40)]
    docs = []
    for i in range(120):
        passage = items[i % 40][1].split()
        for _ in range(i // 40 * len(passage) // 10):
            passage[rng.randrange(len(passage))] = word()
        around = [word() for _ in range(30)]
        docs.append((i, " ".join([*around[:15], *(w.upper() + "," for w in passage), *around[15:]])))
        docs.append((1000 + i, " ".join(around)))
    hit = check(spark, docs, items)
    long_enough = {i for i in range(40) if len(items[i][1].split()) >= leaks.LEAST}
    assert long_enough <= hit and not any(i >= 1000 for i in hit)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [(1, ""), (2, passage), (2, passage), (3, "w0 " * 100_000), (4, passage[:40]), (5, "…")]
    check(spark, docs, [(1, passage), (1, passage), (2, ""), (3, "w0 w0 w0 w0")])
    check(spark, docs, [])
    check(spark, [], [(1, passage)])
    df = spark.createDataFrame([(None, passage), (1, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (1, None)], "item_id long, text string")
    assert [tuple(r) for r in leaks.contaminated(df, bench).collect()] == [(None, None, 20, 0)]
    assert [tuple(r) for r in leaks.clean(df, bench).collect()] == [(1, None)]


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(leaks, "MOST_SEEDS", 0)
    passage = " ".join(f"w{i}" for i in range(20))
    check(spark, [(1, passage), (2, "clean text")], [(7, passage)])


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 8, 9, 10, 13, 16, 20, 25, 30, 40, 60])
def test_recall_does_not_depend_on_the_seeds(spark, n):
    """Copies with as many random substitutions as the rule accepts, against an alignment
    without seeds: at least nine in ten are found, exact copies always."""
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items, docs = [], []
    enough = n if n < 5 else min(leaks.ENOUGH, math.ceil(n * leaks.SHARE))
    for i in range(150):
        passage = [word() for _ in range(n)]
        items.append((i, " ".join(passage)))
        copy = list(passage)
        begin = rng.randrange(max(1, n - 29))
        same = rng.sample(range(begin, min(n, begin + 30)), enough)
        for k in set(range(n)).difference(same) if i else ():
            copy[k] = word()
        equal = [a == b for a, b in zip(passage, copy)]
        assert any(sum(equal[k : k + 30]) >= enough for k in range(max(1, n - 29)))
        docs.append((i, " ".join([word() for _ in range(8)] + copy + [word() for _ in range(8)])))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {r["doc_id"] for r in leaks.contaminated(df, bench).collect() if r["doc_id"] == r["item_id"]}
    assert 0 in found and len(found) >= 0.9 * 150


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "clean", 1, 2)], "doc_id long, text string, row int, _ROW int")
    assert leaks.clean(df, spark.createDataFrame([(1, "some other words")], "item_id long, text string")).collect() == df.collect()
