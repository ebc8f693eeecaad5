"""SimHash near-dedup: 64-bit fingerprints of word shingles, joined on pigeonhole blocks.

Fingerprints at ``DISTANCE`` differing bits or fewer leave two of four 16-bit blocks
intact, so they share one of the six pairs of blocks. Candidates come from a join on those
32-bit keys and are verified by Hamming distance. A key with more than ``CROWD`` different
fingerprints is split further instead of being paired: each of its members also stands
under the 33 values within one bit of its other 32 bits, and two members that differ in at
most two bits share such a value. A value has at most 33 members, so no group is unbounded
and no link is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import components, store, unused

DISTANCE = 2
SHINGLE = 3
CROWD = 32
_SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a UTF-8 text; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begin, end = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(begin), _CHUNK):
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(begin[at : at + _CHUNK], end[at : at + _CHUNK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        set_bits += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(begin), bitorder="little").view("<i8")[0])


def fingerprints(rows: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``rows`` but the text, and ``fp``; a null text counts as empty."""
    kept = [c for c in rows.columns if c != text]
    schema = rows.select(*kept, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.binary())
            fps = pa.array((fingerprint(x.as_py(), shingle) for x in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), fps], names=[*kept, "fp"])

    return rows.select(*kept, text).mapInArrow(run, schema)


def _block(fp: Column, which: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * which).bitwiseAND(0xFFFF)


def _joined(fp: Column, high: int, low: int) -> Column:
    return F.shiftleft(_block(fp, high), 16).bitwiseOR(_block(fp, low))


def block_keys(fps: DataFrame) -> DataFrame:
    """``fp``, ``slot`` and ``key`` of two blocks, and the ``rest`` of the bits; six rows each."""
    fp, choices = F.col("fp"), list(combinations(range(4), 2))
    entries = []
    for slot, (a, b) in enumerate(choices):
        c, d = (i for i in range(4) if i not in (a, b))
        entries.append(F.struct(F.lit(slot).alias("slot"), _joined(fp, a, b).alias("key"), _joined(fp, c, d).alias("rest")))
    return fps.select("fp", F.inline(F.array(*entries)))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Verified links (``src``, ``dst``) that connect distinct fingerprints exactly as all
    pairs within ``DISTANCE`` bits would. ``fps``: one column ``fp``, distinct, stored."""
    keys = block_keys(fps)
    crowded = store(keys.groupBy("slot", "key").count().where(F.col("count") > crowd).select("slot", "key"), "crowded")
    few = keys.join(crowded, ["slot", "key"], "left_anti")
    a, b = few.alias("a"), few.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= DISTANCE
    same = (F.col("a.slot") == F.col("b.slot")) & (F.col("a.key") == F.col("b.key"))
    pairs = a.join(b, same & (F.col("a.fp") < F.col("b.fp")) & near).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    flips = F.array(F.col("rest"), *(F.col("rest").bitwiseXOR(F.lit(1 << i)) for i in range(32)))
    split = keys.join(crowded, ["slot", "key"]).select("fp", "slot", "key", F.explode(flips).alias("middle"))
    groups = split.groupBy("slot", "key", "middle").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = groups.select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst")).where("src <> dst")
    return pairs.union(stars).distinct()


def near_duplicates(rows: DataFrame, fp: str, least: str) -> DataFrame:
    """Per fingerprint ``fp``: ``first``, the smallest ``least`` of its component.

    ``rows``: a stored table with ``fp`` and a column to take the minimum of (nulls do not
    count; a component of nulls only gives null).
    """
    by_fp = store(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(least).alias("own")), "fps")
    found = components(links(by_fp.select("fp")), "src", "dst")
    rooted = store(
        by_fp.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left").select("fp", "own", F.coalesce("component", "fp").alias("root")), "rooted"
    )
    firsts = store(rooted.groupBy("root").agg(F.min("own").alias("first")), "firsts")
    return store(rooted.join(firsts, "root").select("fp", "first"), "members")


def classes(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex) and ``component_id``.

    A null text has fingerprint zero like an empty one. Repeated rows stay; rows without
    an id link like others but never name a component (null if it has no other row).
    Other columns are ignored.
    """
    rows = store(fingerprints(documents.select("doc_id", "text"), "text"), "fingerprints")
    first = near_duplicates(rows, "fp", "doc_id")
    return rows.join(first, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of every component: that of the smallest ``doc_id`` (null last), then the
    first in reading order. All columns are kept, whatever their names.

    Null and empty texts share a fingerprint, so one of them stays; an empty table stays empty."""
    rid, mark = unused("row", documents.columns), "fp"
    rows = documents.withColumn(rid, F.monotonically_increasing_id())
    held = store(rows, "rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(rid).alias("row"))
    marks = store(fingerprints(held.select(order.alias("at"), F.col(rid).alias("row"), F.col("text")), "text"), "fingerprints")
    first = near_duplicates(marks, mark, "at")
    kept = first.select(F.col("first.row").alias(rid)).distinct()
    return held.join(kept, rid, "left_semi").drop(rid)


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
