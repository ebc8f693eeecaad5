"""Trie of conversation prefixes against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerspark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            told[conv].append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(v)] for c, v in told.items()}
    whole = {}
    for c, v in told.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(told.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not children[n]
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == n)
        yield min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()


def check(spark, rows):
    rng = random.Random(5)
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame([(*r, 1, "x") for r in shuffled], SCHEMA + ", k1 int, part string")
    got = prefix_trie.rebuilt_trie(df)
    assert dict(got.dtypes) == {"ends_sha256": "string"} | dict.fromkeys(
        ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "bigint"
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 0, "user", "hi"), (0, 0, "user", "hi"), (0, 1, None, "a"), (5, 0, "", "b")]
    rows += [(-3, 1, "user", "é" * 9), (-3, 1, "assistant", ""), (205, 0, "user", "alone"), (206, 0, "user", "alone"), (99, 2, "a", "b"), (99, 2, "ab", "")]
    check(spark, rows)


def test_turnless_conversations_end_at_the_root(spark):
    # Families without a first conversation: those with heads that cover all their turns keep none.
    check(spark, [(c, 0, "user", "q") for c in range(1, 60)])


def test_empty_table(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block, piece", [(2, 2), (3, 7)])
def test_long_and_many_equal_conversations(spark, monkeypatch, block, piece):
    """Half of all turns in one conversation, many equal ones, and prefixes of others."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rng = random.Random(block)
    rows = [(400, t, "user", "t" * (t % 7)) for t in range(150)]
    for c in rng.sample(range(-50, 900), 60):
        rows += [(c, t, "user", rng.choice("ab") if t > 2 else "same") for t in range(rng.randrange(1, 9))]
    rows += [(c, t, "user", "equal") for c in range(1000, 1040) for t in range(6)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    check(spark, rows)


def test_turns_of_one_conversation_span_ranges(spark):
    df = spark.range(5000).selectExpr("7 AS conv_id", "id % 50 AS turn", "'user' AS role", "CAST(id AS STRING) AS text")
    got = prefix_trie.turns(df.repartition(8)).orderBy("at").collect()
    want = sorted(((i % 50, str(i)) for i in range(5000)))
    assert [r["at"] for r in got] == list(range(1, 5001))
    assert [r["digest"] for r in got] == [hashlib.sha256(f"4:user{t}".encode()).hexdigest() for _, t in want]


def test_query_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
