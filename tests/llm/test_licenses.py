"""License scans against plain Python; the whole table is compared with SQL elsewhere."""

import math
import re
import textwrap

from ledgerspark.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(text, templates=licenses.TEMPLATES, containment=licenses.CONTAINMENT):
    text = lower(text or "")
    words, starts, base, labels, best = re.findall(WORD, text), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        size = len(phrase.split())
        found = [k for k in range(len(words)) if words[k : k + size] == phrase.split()]
        starts += found
        base |= {label} if found else set()
    for label, template in templates:
        listed = re.findall(WORD, lower(template))
        t, width = set(listed), 1
        while width < len(listed):
            width *= 2
        for begin in range(0, len(words), width):
            own = set(words[begin : begin + 2 * width])
            if len(own & t) >= math.ceil(round(containment * len(t), 9)):
                labels.add(label)
                best = max(best, len(own & t) / len(t))
    every = ",".join(sorted(base | labels))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), every, 1.0 if starts else best


def check(spark, texts, **given):
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, labels string")
    got = sorted(map(tuple, licenses.licensed(df, **given).collect()), key=str)
    assert got == sorted(((i, *brute(t, **given)) for i, t in texts), key=str)


def test_phrases_and_odd_rows(spark):
    check(
        spark,
        [
            (1, None),
            (2, ""),
            (3, "GNU General\nPublic... License! the MIT-License, mit license mit license"),
            (3, "CC BY, cc_by ccby cc by"),
            (None, "apache license é日本 Apache\tLicenses"),
            (5, "gnu gnu general public license"),
            (6, "w " * 200_000 + "mit license"),
            (7, "#\n\n--"),
        ],
    )
    check(spark, [])


def test_blocks_with_missing_and_added_words(spark):
    texts = []
    for _, template in licenses.TEMPLATES:
        words = template.split()
        for gone in range(0, 6):
            texts.append((len(texts), "intro\n" + " ".join(words[gone:]) + " and then more words\nend"))
            texts.append((len(texts), " ".join(words[: len(words) - gone]).upper()))
            texts.append((len(texts), " ".join(words[gone // 2 :: 1 + gone % 2])))
    check(spark, texts)
    check(spark, texts, containment=0.6)
    check(spark, texts, templates=(("one", "word"), ("two", "all rights"), ("same", "The the THE")))


def test_wrapped_notices_behind_comment_marks(spark):
    """Every template, wrapped at 72 columns behind any mark and anywhere in a text, is found."""
    docs = []
    for no, (label, template) in enumerate(licenses.TEMPLATES):
        for mark in ("", "# ", "// ", " * ", "-- ", "; "):
            lines = textwrap.wrap(template, 72 - len(mark))
            around = "\n".join(mark + " ".join(f"word{k}x{j}" for j in range(9)) for k in range(no % 7))
            docs.append((f"{label}/{no}/{mark}", around + "\n" + "\n".join(mark + line for line in lines) + "\n" + around))
    df = spark.createDataFrame(docs, "doc_id string, text string")
    for row in licenses.licensed(df).collect():
        assert row["doc_id"].split("/")[0] in row["labels"].split(","), row
