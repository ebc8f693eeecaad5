"""Benchmark decontamination by spaced-seed hashing. DataFrame functions only.

Each mask selects four words of a window of four to nine; the others may differ. The hashes
of every masked window of every text are joined with those of the benchmark. What a hit
says is an alignment, so hits are merged to the alignments of each text and item, without
the texts; these meet text and item once, and the aligned words are compared one by one. An
alignment counts if among ``AROUND`` aligned words in a row at least ``ENOUGH``, or ``SHARE`` of a
shorter item, are the same. The masks were chosen by their recall: of copies of 5 to 60 words
with as many random substitutions as the rule accepts, they find over 0.9 at every length.
Items of three and four words have to be found whole; items of under ``LEAST`` words say
nothing and never match.

The seeds of the benchmark, and the ids of texts with a hit, are broadcast if they are at
most ``MOST_SEEDS`` rows each, else the joins shuffle both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import let, lower_ascii, store, unused

MASKS = ("1111", "11011", "10111", "11101", "110101", "110011", "10100101", "11000101", "101000011", "100101001")
# The mask of items of three words, which no other fits.
SMALLEST = "111"
LEAST = 3
# Items of fewer words have to be found whole.
WHOLE = 5
ENOUGH = 12
SHARE = 0.7
AROUND = 30
MOST_SEEDS = 1_000_000
_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Words of letters and digits, A-Z in lower case; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _key(own: Column, at: Column, mask: str) -> Column:
    """Hash of the words that a mask selects at a place; null where it does not fit."""
    picked = [F.get(own, at + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(at + len(mask) <= F.size(own), F.xxhash64(F.lit(int(mask, 2)), *picked))


def _seeded(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``rows`` (with ``own``, the word hashes) once per masked window: ``at`` and ``key``."""
    size = min(map(len, masks))
    starts = F.when(F.size("own") >= size, F.sequence(F.lit(0), F.size("own") - size))
    placed = rows.select("*", F.explode(starts).alias("at"))
    return placed.select("*", F.explode(F.array(*(_key(F.col("own"), F.col("at"), m) for m in masks))).alias("key")).where("key IS NOT NULL")


def _items(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select("item_id", _hashes(F.col("text")).alias("item")).where(F.size("item") >= LEAST)
    return store(rows.withColumn("no", F.monotonically_increasing_id()), "items")


def matches(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row``, ``item_id``, ``matched`` (most same words of an alignment that counts) and ``at``
    (smallest first word of the item's place) of every text and item with such an alignment.

    ``texts``: ``row`` (different and not null) and ``text``, a stored table.
    """
    items = _items(benchmark)
    own = items.select("no", F.col("item").alias("own"))
    seeds, masks = _seeded(own, MASKS), MASKS
    if own.where(F.size("own") == len(SMALLEST)).limit(1).count():
        seeds, masks = seeds.union(_seeded(own.where(F.size("own") == len(SMALLEST)), (SMALLEST,))), (*MASKS, SMALLEST)
    seeds = store(seeds.select("no", "key", F.col("at").alias("place")), "seeds")
    words = texts.select("row", _hashes(F.col("text")).alias("own"))
    windows = _seeded(words, masks).select("row", "at", "key")
    hits = windows.join(F.broadcast(seeds) if seeds.count() <= MOST_SEEDS else seeds, "key")
    # One row per text and item; its alignments are at most as many as the words of both.
    merged = store(hits.groupBy("row", "no").agg(F.collect_set(F.col("at") - F.col("place")).alias("shifts")), "hits")
    ids = store(merged.select("row").distinct(), "ids")
    few = words.join(F.broadcast(ids) if ids.count() <= MOST_SEEDS else ids, "row", "left_semi")
    found = merged.join(few, "row").join(items, "no")
    size = F.size("item")
    enough = F.when(size < WHOLE, size).otherwise(F.least(F.lit(ENOUGH), F.ceil(size * SHARE)).cast("int"))
    counted = F.transform("shifts", lambda s: F.struct(_same(F.col("item"), F.col("own"), s).alias("matched"), s.alias("at")))
    judged = found.select("row", "item_id", let(counted, lambda x: F.filter(x, lambda y: y["matched"] >= enough)).alias("found")).where(F.size("found") > 0)
    return judged.select("row", "item_id", F.array_max("found.matched").alias("matched"), F.array_min("found.at").alias("at"))


def _same(item: Column, own: Column, shift: Column) -> Column:
    """Most same words among ``AROUND`` aligned ones in a row."""
    begin, end = F.greatest(-shift, F.lit(0)), F.least(F.size(item), F.size(own) - shift)
    equal = F.zip_with(
        F.slice(item, begin + 1, end - begin), F.slice(own, begin + shift + 1, end - begin), lambda a, b: F.when(a == b, 1).otherwise(0)
    )

    def slid(x: Column) -> Column:
        gone = lambda k: F.when(k >= AROUND, F.get(x, k - AROUND)).otherwise(0)
        new = F.transform(x, lambda v, k: v - gone(k))
        start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))
        step = lambda s, v: F.struct((s["now"] + v).alias("now"), F.greatest(s["best"], s["now"] + v).alias("best"))
        return F.aggregate(new, start, step, lambda s: s["best"])

    return let(equal, slid)


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id``, ``item_id``,
    ``n_matched`` (most same words of an alignment) and ``first_word`` (smallest start of the
    item in the text, below zero if the text begins within it).

    Null texts and items count as empty. Documents without an id are one group; rows that
    repeat an id are too. Clean documents do not appear; other columns are ignored.
    """
    held = store(documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "rows")
    found = store(matches(held.select("row", "text"), benchmark), "found")
    ids = found.select("row").distinct()
    named = held.select("row", "doc_id").join(F.broadcast(ids) if ids.count() <= MOST_SEEDS else ids, "row", "left_semi").join(found, "row")
    return named.groupBy("doc_id", "item_id").agg(F.max("matched").cast("long").alias("n_matched"), F.min("at").cast("long").alias("first_word"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark item in their text, with all their columns.

    Null and empty texts stay; repeated rows are judged each; an empty benchmark keeps all.
    """
    rid = unused("row", documents.columns)
    held = store(documents.withColumn(rid, F.monotonically_increasing_id()), "rows")
    found = matches(held.select(F.col(rid).alias("row"), "text"), benchmark)
    leaked = store(found.select(F.col("row").alias(rid)).distinct(), "leaked")
    return held.join(leaked, rid, "left_anti").drop(rid)


def oracle() -> str:
    """``contaminated`` over ``documents`` and ``benchmark`` in SQL: windows are compared as
    texts, not by hash. For benchmarks without items of three words."""
    split = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
    def masked(k: int, mask: str) -> str:
        on = " || ' ' || ".join(f"w[a + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")
        return f"[{{'at': a, 'key': '{k} ' || {on}}} FOR a IN range(len(w) - {len(mask) - 1})]"

    windows = "unnest(flatten([" + ", ".join(masked(k, m) for k, m in enumerate(MASKS)) + "]))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS no, doc_id, {split} AS w FROM documents),
items AS (SELECT row_number() OVER () AS no, item_id, {split} AS w FROM benchmark),
doc_windows AS (SELECT no, u.at AS at, u.key AS key FROM (SELECT no, {windows} AS u FROM docs)),
item_windows AS (SELECT no, u.at AS place, u.key AS key FROM (SELECT no, {windows} AS u FROM items)),
hits AS (SELECT DISTINCT d.no, i.no AS item, d.at - i.place AS shift FROM doc_windows d JOIN item_windows i USING (key)),
pairs AS (
  SELECT doc_id, item_id, shift, len(i.w) AS size,
         list_transform(list_zip(i.w[greatest(-shift, 0) + 1:least(len(i.w), len(d.w) - shift)], d.w[greatest(-shift, 0) + shift + 1:least(len(i.w), len(d.w) - shift) + shift]), lambda p: p[1] = p[2]) AS same
  FROM hits h JOIN docs d ON d.no = h.no JOIN items i ON i.no = h.item),
counted AS (SELECT doc_id, item_id, shift, size, list_max([len(list_filter(same[k + 1:k + {AROUND}], lambda x: x)) FOR k IN range(greatest(len(same) - {AROUND}, 0) + 1)]) AS matched FROM pairs)
SELECT doc_id, item_id, CAST(max(matched) AS BIGINT) AS n_matched, CAST(min(shift) AS BIGINT) AS first_word
FROM counted WHERE matched >= CASE WHEN size < {WHOLE} THEN size ELSE least({ENOUGH}, ceil(size * {SHARE})) END GROUP BY doc_id, item_id
"""
