"""Near-equal lines against all pairs."""

import random

from ledgerspark.llm import line_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def drops(spark, docs):
    return {(r["doc_id"], r["n_lines"], tuple(r["dropped"])) for r in line_dedup.summary(spark.createDataFrame(docs, SCHEMA)).collect()}


def wanted(docs):
    return {(i, 0 if t is None else t.count("\n") + 1, tuple(gone)) for (i, t), gone in zip(docs, brute.dropped_lines(docs))}


def test_whole_small_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert drops(spark, docs) == wanted(docs)


def test_edited_lines_of_all_lengths(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvwzéß日本") for _ in range(rng.randrange(2, 9)))
    docs = []
    for i in range(60):
        line = " ".join(word() for _ in range(rng.choice([1, 3, 8, 13, 14, 16, 30, 60, 120])))
        edited = line + "!" if rng.random() < 0.5 else line.replace(line.split(" ")[0], word(), 1)
        docs += [(2 * i, f"{line}\n{word()} own"), (2 * i + 1, f" {edited}\t\n\n  \n{line}")]
    assert drops(spark, docs) == wanted(docs)


def test_a_crowd_of_edits_is_one_component(spark):
    """More variants of a line than any pairing of all with all would like."""
    rng = random.Random(2)
    base = [f"word{i:02d}" for i in range(60)]
    docs = [(i, " ".join([*base[: i % 50], f"edit{rng.randrange(10**6)}", *base[i % 50 + 1 :]])) for i in range(300)]
    assert drops(spark, docs) == wanted(docs)


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " \n\t\n"), (4, "a"), (5, "a\na"), (None, "a\nb"), (6, "b"), (7, long), (8, long + " end"), (9, "\n\nc\n")]
    assert drops(spark, docs) == wanted(docs)
    assert drops(spark, []) == set()


def test_ids_of_any_type_and_names_that_the_job_uses_itself(spark):
    rows = [("a2", "same line here\nown", 1, 2, 3), ("a1", "same line here", 4, 5, 6), (None, "same line here\nmore", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id string, text string, __version int, gone_id int, Own_Version int")
    out = line_dedup.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == [("a1", "same line here", 4, 5, 6), ("a2", "own", 1, 2, 3), (None, "more", 7, 8, 9)]


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "same line here\nown", 5, 9, "k"), (1, "same line here\nown", 5, 9, "k"), (2, "same line here\nother\n", 6, 9, "l"), (3, "same line here", 7, 9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, n_chars long, drop string")
    out = line_dedup.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "same line here\nown", 5, 18, "k")] * 2 + [(2, "other\n", 6, 6, "l")]


def test_every_pair_of_a_crowd_is_found(spark):
    """Lines that are similar to one partner only (0.82) and nearly similar to all others (0.79)."""
    rng = random.Random(8)
    base = "a template of fifty one signs, the same everywhere:"
    tail = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    docs = [(i, base + chr(0x4E00 + i // 2) + tail()) for i in range(4000)]
    gone = {i for i, _, dropped in drops(spark, docs) if dropped}
    assert gone == {i for i in range(4000) if i % 2}


def test_repetitive_lines_of_any_length_meet(spark):
    rng = random.Random(9)
    docs = [(0, "=" * 40), (1, "=" * 400), (2, "=" * 100)]
    for i in range(3, 21, 2):
        phrase = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(49)) + "."
        docs += [(i, phrase * 12), (i + 1, phrase * 200)]
    assert {i for i, _, dropped in drops(spark, docs) if dropped} == {1, 2, *range(4, 21, 2)}


def test_shingles_are_signed_in_blocks(spark):
    """A row holds eight shingles, so 93 of them take 12 rows, whose minima are those of all."""
    lines = [(1, "".join(chr(97 + i * i % 26) for i in range(100))), (2, "short"), (3, "ninesigns"), (3, "ninesigns")]
    df = spark.createDataFrame(lines, "key long, line string")
    blocks = line_dedup._blocks(df).collect()
    assert sorted((r["key"], r["n"]) for r in blocks) == [(1, 5), *[(1, 8)] * 11, (2, 1), (3, 2), (3, 2)]
    assert {r["key"]: r["weight"] for r in line_dedup.signatures(df).collect()} == {1: 93, 2: 1, 3: 4}
    shingles = {1: [lines[0][1][i : i + 8] for i in range(93)], 2: ["short"], 3: ["ninesign", "inesigns"]}
    single = spark.createDataFrame([(k, x) for k, found in shingles.items() for x in found], "key long, line string")
    signed = {k: {r[f"h{j}"] for r in blocks if r["key"] == k for j in range(line_dedup.BLOCK)} for k in (2, 3)}
    alone = {}
    for r in line_dedup._blocks(single).collect():
        assert len({r[f"h{j}"] for j in range(line_dedup.BLOCK)}) == 1
        alone.setdefault(r["key"], set()).add(r["h0"])
    assert signed == {k: alone[k] for k in (2, 3)}
    assert alone[1] == {r[f"h{j}"] for r in blocks if r["key"] == 1 for j in range(line_dedup.BLOCK)}


def test_a_small_crowd_needs_no_exact_join(spark, monkeypatch):
    """120 lines of one template, each similar to its partner only, are compared in their buckets."""
    monkeypatch.setattr(line_dedup, "_unfinished_pairs", None)
    rng = random.Random(8)
    base = "a template of fifty one signs, the same everywhere:"
    tail = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    docs = [(i, base + chr(0x4E00 + i // 2) + tail()) for i in range(120)]
    assert {i for i, _, dropped in drops(spark, docs) if dropped} == {i for i in range(120) if i % 2}


def test_shingle_bits_lose_no_similar_pair(spark):
    rng = random.Random(4)
    texts = ["=" * 40, "=" * 400, "short"]
    for n in (1, 3, 10, 40, 150, 600):
        for _ in range(3):
            line = "".join(rng.choice("abcdé日😀 ") for _ in range(8 * n))
            texts += [line, line + "x" * max(1, n // 2), line[: max(1, 6 * n)], line.replace("a", "b", max(1, n // 12))]
    lines = spark.createDataFrame(list(enumerate(texts)), "key int, line string")
    sized = lines.selectExpr("key", "line").withColumn("size", line_dedup.F.size(line_dedup.F.array_distinct(line_dedup._shingles("line"))))
    sized = sized.join(line_dedup.shingle_bits(lines), "key").select("key", "size", "bits")
    one, two = (sized.toDF(f"{x}_key", f"{x}_size", f"{x}_bits") for x in "ab")
    got = {tuple(r) for r in one.join(two, line_dedup._likely("a_", "b_")).select("a_key", "b_key").collect()}
    sets = [brute._shingles(x) for x in texts]
    similar = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if len(x & y) >= line_dedup.SIMILAR * len(x | y)}
    assert len(similar) > len(texts) and similar <= got and len(got) < len(texts) ** 2 / 2
