"""Quality rules: counts per document, and a hashed n-gram log-likelihood ratio between a
trusted-target and the raw-corpus multinomial. DataFrame functions only.

Tokens are runs of letters and digits or runs of other signs; their unigrams and bigrams
are hashed to ``BUCKETS`` buckets. The raw multinomial counts every n-gram of all
documents, the target those of all documents whose labels say quality 1. The target is
smoothed towards the raw corpus with ``PRIOR`` pseudo counts: a bucket that the target never has weighs
log(PRIOR / (target + PRIOR)), and without any trusted text every weight is zero. A
document passes if the mean weight of its n-grams is at least ``THRESHOLD``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import let, store, unused, words

BUCKETS = 1 << 14
PRIOR = float(BUCKETS)
THRESHOLD = -0.25
# Trusted ids that are broadcast to the documents; more of them shuffle both sides.
MOST_BROADCAST = 1_000_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOL = r"[#*$%&|<>]"
NOT_SPACE = r"[^ \t-\r]"
_TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\s\p{L}\p{M}\p{N}]+"


def hashes(text: Column) -> Column:
    """Hashes of all unigrams and bigrams of a text, repeats included."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))

    def grams(h: Column) -> Column:
        rest = F.greatest(F.size(h) - 1, F.lit(0))
        return F.concat(h, F.zip_with(F.slice(h, 1, rest), F.slice(h, 2, rest), lambda a, b: F.xxhash64(a, b)))

    return let(F.transform(tokens, lambda t: F.xxhash64(t)), grams)


def _bucket(h: Column) -> Column:
    """A hash modulo ``BUCKETS``, a power of two."""
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids whose labels all say quality 1; null ids and labels do not count."""
    sure = labels.groupBy("doc_id").agg(F.min("quality").alias("worst")).where("worst = 1 AND doc_id IS NOT NULL")
    return sure.select("doc_id")


def bucket_counts(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """``bucket``, ``raw`` and ``target``: its n-grams in all documents and in the trusted ones.

    The hashes are a column before an outer explode takes them apart: an explode of lambdas
    runs row by row, and one that is not outer gets a filter that computes the array again.
    """
    mark = store(trusted.select("doc_id").distinct().withColumn("trusted", F.lit(1)), "trusted")
    marked = documents.select("doc_id", "text").join(F.broadcast(mark) if mark.count() <= MOST_BROADCAST else mark, "doc_id", "left")
    grams = marked.select("trusted", hashes(F.col("text")).alias("grams"))
    single = grams.select("trusted", F.explode_outer("grams").alias("h")).where("h IS NOT NULL")
    return single.groupBy(_bucket(F.col("h")).alias("bucket")).agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))


def weights(documents: DataFrame, trusted: DataFrame) -> list[float]:
    """Log-likelihood ratio of each bucket, from all documents. ``trusted``: ``doc_id``, of
    any number; what comes back is one row per bucket."""
    rows = bucket_counts(documents, trusted).collect()
    raw, target = sum(r["raw"] for r in rows), sum(r["target"] for r in rows)
    found = [0.0] * BUCKETS
    for r in rows:
        share = r["raw"] / raw
        found[r["bucket"]] = round(math.log((r["target"] + PRIOR * share) / ((target + PRIOR) * share)), 6)
    return found


def score(text: Column, weight: list[float]) -> Column:
    """Mean weight of a text's n-grams; 0 if it has none."""
    table = F.split(F.lit(",".join(map(str, weight))), ",").cast("array<double>")
    total = lambda found: F.aggregate(found, F.lit(0.0), lambda s, h: s + F.get(table, _bucket(h)))
    return let(hashes(text), lambda found: F.coalesce(F.try_divide(total(found), F.size(found)), F.lit(0.0)))


def _repeated(found: Column) -> Column:
    """Words in 3-word windows that a text has twice or more, from its words. Windows count
    as equal if their 64-bit hashes are. Only a text with a repeated hash sorts them."""

    def again(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(_sorted(h), covered)).otherwise(F.lit(0))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), spread)

    def spread(p: Column) -> Column:
        new = F.transform(p, lambda x, k: F.least(F.lit(3), F.get(p, k + 1) - x))
        return F.aggregate(new, F.lit(0), lambda s, x: s + x)

    def windows(w: Column) -> Column:
        starts = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return let(let(F.transform(found, lambda x: F.xxhash64(x)), windows), again)


def _sorted(hashes: Column) -> Column:
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def counts(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    both = let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("again"), F.length(F.array_join(w, "")).alias("chars")))
    return [
        both.alias("both"),
        F.regexp_count(text, F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ]


def judged(documents: DataFrame, weight: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``kept`` and ``score``.

    A null text counts as empty and fails; repeated rows are judged each; other columns
    are ignored.
    """
    text = F.col("text")
    rows = documents.select("doc_id", *counts(text), score(text, weight).alias("score"))
    n, again, chars = (F.col(f"both.{c}").cast("long") for c in ("n", "again", "chars"))
    rows = rows.select("doc_id", n.alias("n_words"), chars.alias("word_chars"), "n_symbols", "n_dup_lines", again.alias("n_repeat_words"), "score")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def filtered(documents: DataFrame, weight: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns. Null and empty texts go; repeated
    rows are judged each; an empty table stays empty."""
    text, mark = F.col("text"), unused("both", documents.columns)
    rows = documents.withColumn(mark, counts(text)[0])
    long_enough = (F.col(f"{mark}.n") >= MIN_WORDS) & (100 * F.col(f"{mark}.again") <= MAX_REPEAT_PERCENT * F.col(f"{mark}.n"))
    return rows.where(long_enough).drop(mark).where(score(text, weight) >= threshold)
