"""Exact set-similarity self-join at a Jaccard similarity of 0.8. DataFrame functions only.

Sets are lists of hashes in one order. Two sets with enough in common have their first
common hash among the first n - ceil(4n/5) + 1 of the larger one and the first
n - ceil(8n/9) + 1 of the smaller one, which gives prefix, size and positional filters
without loss. Only pairs of different components are wanted: a hash whose holders are all
of one component is left out, and of a hash's most frequent component no two are paired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store


def rarest_first(hashes: DataFrame) -> DataFrame:
    """``key``, ``component`` and ``own`` (hashes, those in fewest sets first) from single
    ones: ``key``, ``component``, ``h``."""
    hashes = store(hashes, "hashes")
    counts = store(hashes.groupBy("h").agg(F.count("*").alias("n")), "counts")
    ordered = hashes.join(counts, "h").groupBy("key", "component").agg(F.array_sort(F.collect_list(F.struct("n", "h"))).alias("own"))
    return ordered.select("key", "component", F.col("own.h").alias("own"))


def across(sets: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of keys of different components that may be similar enough; all
    that are so are among them. ``sets``: ``key``, ``component`` and ``own`` (distinct hashes)."""
    sized = sets.select("key", "component", "own", F.size("own").alias("n"))
    prefix = F.slice("own", F.lit(1), F.expr("CAST(n - (4 * n + 4) DIV 5 + 1 AS INT)"))
    entries = sized.select("key", "component", "n", F.posexplode(prefix).alias("at", "h"))
    entries = store(entries.withColumn("short", F.expr("at <= n - (8 * n + 8) DIV 9")), "entries")
    holders = entries.groupBy("h", "component").agg(F.count("*").alias("members"), F.max("short").alias("short"))
    tops = holders.groupBy("h").agg(F.max_by("component", "members").alias("top"), F.count("*").alias("n"), F.max("short").alias("short"))
    mixed = store(entries.join(tops.where("n > 1 AND short").select("h", "top"), "h"), "mixed")
    rest = F.col("component") != F.col("top")
    both = _joined(mixed.where(F.col("short") & rest), mixed).union(_joined(mixed.where(F.col("short") & ~rest), mixed.where(rest)))
    return store(both.distinct(), "across")


def _joined(smaller: DataFrame, larger: DataFrame) -> DataFrame:
    s, x = smaller.alias("s"), larger.alias("x")
    fits = (
        "s.component <> x.component AND (s.n < x.n OR s.n = x.n AND s.key < x.key) AND 5 * s.n >= 4 * x.n "
        "AND 9 * least(s.n - s.at, x.n - x.at) >= 4 * (s.n + x.n)"
    )
    return s.join(x, (F.col("s.h") == F.col("x.h")) & F.expr(fits)).select(F.col("s.key").alias("a"), F.col("x.key").alias("b"))
