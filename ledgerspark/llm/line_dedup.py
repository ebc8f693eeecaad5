"""Line dedup: near-equal lines of all documents by MinHash, one line per component stays.
DataFrame functions only.

A line counts without outer spaces; lines without any other sign are not looked at. Equal
lines meet by a 64-bit hash, their key. For different ones, the shingles of ``SHINGLE``
characters of a line (UTF-16 units; the whole line if shorter) are hashed, and under each of
``BANDS`` x ``ROWS`` masks the smallest hash is the signature. Lines that agree in all rows
of a band are candidates: at a similarity of 0.8 a pair is missed about once in 1,000.
All shingles are signed, so a long or repetitive line is signed like any other of its set.

What is compared is the exact Jaccard similarity of whole shingle sets (code points here;
shingles count as equal if their 64-bit hashes are), ``SIMILAR`` or more. First every line of
a bucket meets the bucket's line of most copies. Then, in a bucket of at most ``CROWD`` lines,
all other pairs that are not in one component yet are compared. There sizes and ``WORDS``
64-bit words of shingle bits rule pairs out without loss before shingles are compared: a bit
that only one line has stands for a shingle that only one has. A larger bucket is worked off in rounds: the lines of
most copies in each of ``LEADS`` parts lead, all others are compared with them, those that
are similar leave, and the rest choose the next leads, until fewer than one in ``STOP``
comparisons of a round is a link. So a crowd of copies and edits costs a few comparisons a
line and bucket, not a square. Then every crowded bucket whose lines are not one component
yet is worked off to the end: an exact join on prefixes of the shingles, rarest first
(``similar.py``), pairs its lines across components. Buckets, and the texts of their lines,
are picked by broadcasts if they are at most ``MOST_KEYS``, else by shuffles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import components, let, store, unused
from ledgerspark.llm.similar import across, rarest_first

SHINGLE = 8
BANDS = 10
ROWS = 3
SIMILAR = 0.8
CROWD = 256
LEADS = 4
STOP = 20
BLOCK = 8
WIDE_BLOCK = 32
WORDS = 16
MOST_KEYS = 1_000_000
_MOST_WEIGHT = (1 << 21) - 1
_SPACES = " \t\x0b\x0c\r"


def _lines(documents: DataFrame) -> DataFrame:
    """``id`` and ``version`` (hash of the text) of each document with text, ``no`` and
    ``line`` (trimmed) of each of its lines that has a sign, and ``key``."""
    ident = [F.col("doc_id").alias("id"), F.xxhash64("text").alias("version")]
    lines = documents.where("text IS NOT NULL").select(*ident, F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.select("id", "version", "no", _trimmed("line").alias("line")).where("line <> ''")
    return lines.withColumn("key", F.xxhash64("line"))


def _trimmed(line: str) -> Column:
    """The line without outer spaces; trimming reads a whole line, so only those that have some are."""
    outer = [F.startswith(line, F.lit(x)) | F.endswith(line, F.lit(x)) for x in _SPACES]
    return F.when(reduce(Column.__or__, outer), F.trim(line, F.lit(_SPACES))).otherwise(F.col(line))


def _blocks(lines: DataFrame, block: int = BLOCK, unit: int = 2) -> DataFrame:
    """``key``, hashes ``h0``, ``h1``, ... of ``block`` shingles side by side, and their number
    ``n``: the last block of a line repeats the line's last shingle. A shingle is cut from
    UTF-16 units, or from code points if a ``unit`` has four bytes."""
    wide = unit * SHINGLE
    units = lines.select("key", F.encode("line", "UTF-16BE" if unit == 2 else "UTF-32").alias("units"))
    units = units.withColumn("last", F.greatest(F.octet_length("units") - wide + 1, F.lit(1)))
    placed = units.select("key", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(unit * block))).alias("start"))

    def hashed(j: int) -> Column:
        at = F.least(F.col("start") + unit * j, F.col("last"))
        return F.shiftright(F.xxhash64(F.substring("units", at, F.lit(wide))), 32).cast("int")

    n = F.least(F.expr(f"(last - start) DIV {unit} + 1"), F.lit(block))
    return placed.select("key", n.alias("n"), *(hashed(j).alias(f"h{j}") for j in range(block)))


def signatures(lines: DataFrame) -> DataFrame:
    """``key``, ``bands`` and ``weight`` of the signatures of each different line (``key``,
    ``line``). The weight is the number of signed shingles, so it grows with the copies."""
    least = [F.least(*(F.col(f"h{j}").bitwiseXOR(F.lit(mask)) for j in range(WIDE_BLOCK))) for mask in _masks()]
    smallest = [F.min(x).alias(f"m{i}") for i, x in enumerate(least)]
    signed = _blocks(lines, WIDE_BLOCK).groupBy("key").agg(*smallest, F.sum("n").alias("rows"))
    bands = [F.xxhash64(F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS)]
    return signed.select("key", F.least("rows", F.lit(_MOST_WEIGHT)).cast("int").alias("weight"), F.array(*bands).alias("bands"))


def _masks() -> list[int]:
    """Signed 32-bit masks of the rows: multiples of an odd constant, so any bits may differ."""
    return [((i + 1) * 0x9E3779B1 & 0xFFFFFFFF) - (1 << 31) for i in range(BANDS * ROWS)]


def shingle_bits(lines: DataFrame) -> DataFrame:
    """``key`` and ``bits`` of each line (``key``, ``line``): a bit is set for the hash of every
    shingle of code points, in ``WORDS`` words."""

    def word(i: int) -> Column:
        return F.expr(" | ".join(f"if((h{j} & {WORDS - 1}) = {i}, shiftleft(1L, shiftright(h{j}, 16)), 0L)" for j in range(BLOCK)))

    words = _blocks(lines, unit=4).groupBy("key").agg(*(F.bit_or(word(i)).alias(f"w{i}") for i in range(WORDS)))
    return words.select("key", F.array(*(f"w{i}" for i in range(WORDS))).alias("bits"))


def _likely(a: str, b: str) -> Column:
    """Sizes and bits allow ``SIMILAR``: sets of n and m shingles that share c have n + m - 2c
    shingles of their own, at most a ninth of n + m at 0.8, and no fewer than bits of their own."""
    size_a, size_b = F.col(f"{a}size"), F.col(f"{b}size")
    close = F.least(size_a, size_b) >= SIMILAR * F.greatest(size_a, size_b)
    own = F.expr(" + ".join(f"bit_count({a}bits[{i}] ^ {b}bits[{i}])" for i in range(WORDS)))
    return close & (own * (1 + SIMILAR) <= (1 - SIMILAR) * (size_a + size_b) + 1e-6)


def _shingles(line: str) -> Column:
    """Hashes of the shingles of a line, repeats included. Four bytes a code point, so that
    a shingle is cut without reading the line from its start."""
    wide = 4 * SHINGLE

    def cut(units: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(units) - wide + 1, F.lit(1)), F.lit(4))
        return F.transform(starts, lambda at: F.xxhash64(F.substring(units, at, F.lit(wide))))

    return let(F.encode(line, "UTF-32"), cut)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of keys whose lines are similar enough. ``texts``: ``key``,
    ``line`` and ``size``, the number of different shingles, which alone rules out pairs of
    too different size."""
    sizes = texts.select("key", "size")
    likely = pairs.join(sizes.select(F.col("key").alias("a"), F.col("size").alias("size_a")), "a")
    likely = likely.join(sizes.select(F.col("key").alias("b"), F.col("size").alias("size_b")), "b")
    likely = likely.where(F.least("size_a", "size_b") >= SIMILAR * F.greatest("size_a", "size_b"))
    sides = likely.join(texts.select(F.col("key").alias("a"), F.col("line").alias("line_a")), "a")
    sides = sides.join(texts.select(F.col("key").alias("b"), F.col("line").alias("line_b")), "b")
    common = F.size(F.array_intersect(_shingles("line_a"), _shingles("line_b")))
    return sides.where(let(common, lambda n: n >= SIMILAR * (F.col("size_a") + F.col("size_b") - n))).select("a", "b")


def _small(table: DataFrame) -> DataFrame:
    """A stored table of numbers, to be broadcast if it is at most ``MOST_KEYS`` rows."""
    return F.broadcast(table) if table.count() <= MOST_KEYS else table


def line_links(lines: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the keys that are similar to another, from all lines
    (``key``, ``line``; repeats allowed)."""
    signed = store(signatures(lines), "signatures")
    entries = signed.select("key", "weight", F.explode("bands").alias("bucket"))
    least, most = F.min("key").alias("least"), F.max("key").alias("most")
    several = store(entries.groupBy("bucket").agg(least, most).where("least <> most").select("bucket"), "several")
    shared = store(entries.join(_small(several), "bucket").distinct(), "shared")
    buckets = store(shared.groupBy("bucket").agg(F.max_by("key", _rank()).alias("lead"), F.count("*").alias("members")), "buckets")
    keys = store(shared.select("key").distinct(), "keys")
    texts = store(lines.select("key", "line").join(_small(keys), "key", "left_semi").distinct().withColumn("size", F.size(F.array_distinct(_shingles("line")))), "texts")

    led = shared.join(buckets, "bucket").where("key <> lead")
    first = store(verified(led.select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct(), texts), "first")
    few = led.where(F.col("members").between(3, CROWD)).select("bucket", "key")
    links = store(first.union(verified(_few_pairs(few, components(first, "a", "b"), texts), texts)), "links")

    crowds = store(shared.join(buckets.where(F.col("members") > CROWD).select("bucket"), "bucket"), "crowds")
    if crowds.isEmpty():
        return components(links, "a", "b")
    near = first.select(F.col("a").alias("lead"), F.col("b").alias("key"))
    crowded = store(led.where(F.col("members") > CROWD).join(near, ["lead", "key"], "left_anti").select("bucket", "key", "weight"), "crowded")
    compared, linked = 0, 0
    while linked * STOP >= compared and not crowded.isEmpty():
        part = F.pmod(F.xxhash64("key", F.lit(compared)), F.lit(LEADS))
        leads = store(crowded.groupBy("bucket", part.alias("part")).agg(F.max_by("key", _rank()).alias("lead")).select("bucket", "lead"), "leads")
        led = crowded.join(leads, "bucket").where("key <> lead")
        pairs = store(led.select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
        more = store(verified(pairs, texts), "more")
        compared, linked = pairs.count(), more.count()
        links = store(links.union(more), "links")
        met = leads.select("bucket", F.col("lead").alias("key"))
        left = led.join(more.select(F.col("a").alias("lead"), F.col("b").alias("key")), ["lead", "key"], "left_semi").select("bucket", "key")
        crowded = store(crowded.join(met.union(left).distinct(), ["bucket", "key"], "left_anti"), "crowded")
    found = components(links, "a", "b")
    more = verified(_unfinished_pairs(crowds.select("bucket", "key"), found, texts), texts)
    return components(links.union(store(more, "last")), "a", "b")


def _few_pairs(few: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs (``a``, ``b``) of lines of different components (``found``) in a bucket (``bucket``,
    ``key``) that sizes and bits allow."""
    mixed = store(_mixed(_grouped(few, found)), "mixed")
    left = store(texts.join(mixed.select("key"), "key", "left_semi"), "left")
    bits = store(left.select("key", "size").join(shingle_bits(left), "key"), "bits")
    sides = mixed.join(bits, "key")
    one = sides.select("bucket", *(F.col(c).alias(f"a_{c}") for c in ("key", "component", "size", "bits")))
    two = sides.select("bucket", *(F.col(c).alias(f"b_{c}") for c in ("key", "component", "size", "bits")))
    allowed = (F.col("a_key") < F.col("b_key")) & (F.col("a_component") != F.col("b_component")) & _likely("a_", "b_")
    return one.join(two, "bucket").where(allowed).select(F.col("a_key").alias("a"), F.col("b_key").alias("b")).distinct()


def _mixed(grouped: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    several = grouped.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return grouped.join(several.where("least <> most").select("bucket"), "bucket")


def _grouped(members: DataFrame, found: DataFrame) -> DataFrame:
    """``bucket``, ``key`` and the key's ``component``, itself if it has no link; stored."""
    joined = members.join(found.withColumnRenamed("node", "key"), "key", "left")
    return store(joined.select("bucket", "key", F.coalesce("component", "key").alias("component")), "grouped")


def _unfinished_pairs(crowds: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidates (``a``, ``b``) for all similar lines of different components in the crowded
    buckets (``bucket``, ``key``) that hold more than one."""
    left = store(_mixed(_grouped(crowds, found)).select("key", "component").distinct(), "left")
    own = texts.join(left, "key").select("key", "component", F.array_distinct(_shingles("line")).alias("own"))
    # Outer, as a plain explode would get a filter on the array's size that computes it again; none is empty.
    return across(rarest_first(own.select("key", "component", F.explode_outer("own").alias("h"))))


def _rank() -> Column:
    """Order by weight, then by bits of the key."""
    return F.shiftleft(F.col("weight").cast("long"), 42).bitwiseOR(F.col("key").bitwiseAND((1 << 42) - 1))


def dropped_lines(documents: DataFrame) -> DataFrame:
    """``id``, ``version`` and ``drop`` (numbers of the lines that go, from 0) of each document
    that loses lines.

    Of a component the line of the smallest id (null last), then smallest version, then
    smallest number stays. Rows that repeat both id and text are one document.
    """
    lines = _lines(documents)
    places = store(lines.drop("line"), "places")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "version", "no")
    keyed = store(places.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")), "keyed")
    links = line_links(lines.select("key", "line"))
    linked = store(keyed.join(links.select(F.col("node").alias("key"), "component"), "key").select("key", "first", "component"), "linked")
    best = store(linked.groupBy("component").agg(F.min("first").alias("best")), "best")
    stays = linked.join(best, "component").select("key", "best")
    kept = keyed.join(stays, "key", "left").where("first <> last OR first <> best").select("key", F.coalesce("best", "first").alias("kept"))
    kept = store(kept, "kept")
    gone = places.select("key", "id", "version", "no", place.alias("place")).join(kept, "key").where("place <> kept")
    return store(gone.groupBy("id", "version").agg(F.array_sort(F.collect_set("no")).alias("drop")), "dropped")


def _marked(documents: DataFrame, drops: DataFrame, drop: str) -> DataFrame:
    """The documents and, as column ``drop``, the numbers of the lines that go (null: none)."""
    ident, version, own = (unused(name, documents.columns) for name in ("gone_id", "gone_version", "own_version"))
    named = drops.select(F.col("id").alias(ident), F.col("version").alias(version), F.col("drop").alias(drop))
    same = F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(own) == F.col(version))
    return documents.withColumn(own, F.xxhash64("text")).join(named, same, "left").drop(ident, version, own)


def summary(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_dropped`` and ``dropped`` (numbers
    of the lines that go, from 0).

    A null text has no line, an empty one has one. Other columns are ignored.
    """
    documents = documents.select("doc_id", "text")
    marked = _marked(documents, dropped_lines(documents), "drop")
    none = F.array().cast("array<int>")
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    gone = F.coalesce("drop", none)
    count = F.when(F.col("text").isNull(), 0).otherwise(lines)
    return marked.select("doc_id", count.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), gone.alias("dropped"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents with the lines that stay, in all their columns; ``n_chars``, if there, is
    counted again. A document that had signs and keeps none goes."""
    drop = unused("drop", documents.columns)
    marked = _marked(documents, dropped_lines(documents.select("doc_id", "text")), drop)
    kept = F.filter(F.split("text", "\n"), lambda line, no: ~F.array_contains(drop, no))
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    rows = marked.withColumn("text", text).where(F.col(drop).isNull() | (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != "")).drop(drop)
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return rows.select(*(F.col(f"`{c}`") for c in documents.columns))
