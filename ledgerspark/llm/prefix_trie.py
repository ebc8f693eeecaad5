"""Trie of conversation prefixes, from whole sequences with weights.

A conversation is never gathered into one row. Its turns get positions by a running count,
and a prefix is known by the running exclusive-or of two 64-bit hashes of (position, SHA-256
of role and text): 128 bits that any executor computes from its own rows. Running values
are taken inside blocks and carried over by the blocks' totals, so a conversation with a
third of all turns is spread over many tasks.

Identical conversations collapse into one sequence: a weight, a representative (the smallest
conversation) and the list of those that end there. Sequences that are proper prefixes of
others are no leaves (anti join). Everything else is an aggregate over the prefixes of the
distinct sequences. A sum over a subtree needs no walk: every node belongs to the smallest
leaf below it, sums run along each leaf's path from its end, and a node adds up its leaves.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store

# Depths that one task sums up in one go; longer paths go over several tasks.
BLOCK = 1024
# Conversation ids of one piece of an end list.
PIECE = 256
# Fixed values of the rebuilt conversations: families of 100 ids, heads of 0 to 5 turns.
FAMILY, HEADS = 100, 6

_NODE = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` (1, 2, ...), ``digest`` (of role and text) and ``chars`` per turn.

    Turns are in the order of ``turn``, null first; equal ones in that of role and text; null
    roles and texts are empty; repeated rows are turns of their own. Rows without ``conv_id``
    belong to no conversation and are left out. Other columns are ignored. The rows are dealt
    by ranges of (conversation, turn) and stored, so a position is the place in its range plus
    the sizes of the ranges before, and a conversation may span several.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.concat(role, F.lit("\0"), text).alias("said"),
        F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )
    dealt = store(rows.repartitionByRange("conv_id", "turn", F.substring("said", 1, 64)).withColumn("part", F.spark_partition_id()), "dealt")
    place = Window.partitionBy("part", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "said")
    local = dealt.select("conv_id", "part", "digest", "chars", F.row_number().over(place).cast("long").alias("place"))
    sizes = dealt.groupBy("part", "conv_id").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "conv_id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return local.join(offsets, ["part", "conv_id"]).select("conv_id", (F.col("before") + F.col("place")).alias("at"), "digest", "chars")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their family's first one: the first h turns of
    ``conv_id - conv_id % family``, then the own turns after the first h, where h is the CRC-32
    of the decimal id modulo ``heads``.

    Returns the turns (``conv_id``, ``depth``, ``digest``, ``chars``) and all conversations
    (``conv_id``, ``length``), of which some may have no turn.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    own = turns.groupBy("conv_id").agg(F.max("at").alias("n")).withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("at") < heads)).withColumnRenamed("conv_id", "base")
    sizes = first.groupBy("base").agg(F.max("at").alias("size"))
    taken = F.least("h", F.coalesce("size", F.lit(0)))
    members = store(own.join(sizes, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "members")
    rest = turns.join(members, "conv_id").where("at > h").select("conv_id", (F.col("taken") + F.col("at") - F.col("h")).alias("depth"), "digest", "chars")
    begin = members.join(first, "base").where("at <= h").select("conv_id", F.col("at").alias("depth"), "digest", "chars")
    return rest.union(begin), members.select("conv_id", "length")


def _running(rows: DataFrame, key: str, step: str, values: list[str], total: Callable, add: Callable[[Column, Column], Column], backwards: bool = False) -> DataFrame:
    """``values`` replaced by their running totals along ``step`` (0, 1, ...) of each key."""
    way = -1 if backwards else 1
    rows = rows.withColumn("block", F.expr(f"{step} DIV {BLOCK}"))
    inside = Window.partitionBy(key, "block").orderBy(F.col(step) * way).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(F.col("block") * way).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, "block").agg(*(total(v).alias(v) for v in values))
    carried = blocks.select(key, "block", *(F.coalesce(total(v).over(before), F.lit(0)).alias(f"carried_{v}") for v in values))
    local = rows.withColumns({v: total(v).over(inside) for v in values}).join(carried, [key, "block"])
    return local.withColumns({v: add(F.col(v), F.col(f"carried_{v}")) for v in values}).drop("block", *(f"carried_{v}" for v in values))


def paths(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Prefixes of each conversation, the empty one included: ``conv_id``, ``length``, ``depth``,
    the prefix as ``k1`` and ``k2``, the one before as ``p1`` and ``p2``, ``chars`` of its last turn."""
    hashed = turns.withColumns({k: F.xxhash64(F.lit(i), "depth", "digest") for i, k in enumerate(("x1", "x2"))}).drop("digest")
    run = _running(hashed.withColumns({"k1": F.col("x1"), "k2": F.col("x2")}), "conv_id", "depth", ["k1", "k2"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    full = run.join(members, "conv_id").select(
        "conv_id", "length", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "chars"
    )
    zero = F.lit(0).cast("long")
    return full.union(members.select("conv_id", "length", zero, zero, zero, zero, zero, zero))


def _digests(lists: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ends of each node, read piece by piece in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            rows = []
            for *key, ids in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "ids"))):
                if key != node:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield _batch(rows)
        if node:
            yield _batch([(*node, state.hexdigest())])

    ordered = lists.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")
    return ordered.select(*_NODE, "ids").mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=[*_NODE, "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """Digest of the sorted ids of the conversations that end at a node. Ids are gathered in
    pieces of at most ``PIECE`` neighbours, and one pass over the sorted pieces hashes them."""
    last = paths.where("depth = length").withColumn("piece", F.expr(f"conv_id DIV {PIECE}"))
    lists = last.groupBy(*_NODE, "piece").agg(F.concat_ws(",", F.array_sort(F.collect_list("conv_id")).cast("array<string>")).alias("ids"))
    return _digests(lists)


def sequences(paths: DataFrame) -> DataFrame:
    """Whole conversations, identical ones once: the node where they end, ``conv_id`` (the
    smallest) and ``weight`` (how many)."""
    last = paths.where("depth = length")
    return last.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))


def trie(paths: DataFrame) -> DataFrame:
    """One row per distinct prefix: ``conv_id`` (smallest conversation that begins with it),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``
    (childless nodes at or below it), ``saved_tokens`` (sum over the nodes at or below it of
    (n_convs - 1) times the code points of the last text) and ``ends_sha256``."""
    whole = store(sequences(paths), "sequences")
    mine = paths.join(whole.select("conv_id", "weight"), "conv_id")
    inner = mine.where("depth < length").select(*_NODE).distinct()
    leaves = whole.join(inner, _NODE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    marked = store(mine.join(leaves, "conv_id", "left"), "marked")
    nodes = marked.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("chars").alias("chars"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"),
    )
    nodes = store(nodes, "nodes")
    owned = nodes.select(F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    along = marked.where("leaf = 1").select("conv_id", *_NODE).join(owned, ["conv_id", "depth"], "left").fillna(0, ["saved"])
    saved = _running(along, "conv_id", "depth", ["saved"], F.sum, lambda a, b: a + b, backwards=True).groupBy(*_NODE).agg(F.sum("saved").alias("saved_tokens"))
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = below.groupBy(*_NODE).agg(F.count("*").alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    joined = nodes.join(children, _NODE, "left").join(saved, _NODE).join(ends(paths), _NODE, "left").join(above, ["depth", "p1", "p2"], "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``trie`` of the rebuilt conversations. An empty table gives no rows, not even a root."""
    told, members = rebuilt(store(turns(conversations), "turns"))
    return trie(store(paths(told, members), "paths"))


def oracle() -> str:
    """SQL of ``rebuilt_trie`` over ``conversations``, with a list of turns per conversation and
    the CRC-32 bit by bit."""
    bits = "flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda crc, bit: CASE WHEN xor(crc, bit) % 2 = 1 THEN xor(xor(crc, bit) >> 1, 3988292384) ELSE xor(crc, bit) >> 1 END"
    return f"""
    WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS said,
            xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295) % {HEADS} AS h
        FROM turns GROUP BY conv_id
    ),
    whole AS (
        SELECT o.conv_id, list_concat(coalesce(list_slice(b.said, 1, o.h), []), list_slice(o.said, o.h + 1, len(o.said))) AS said
        FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {FAMILY}
    ),
    depths AS (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS depth FROM whole),
    prefixes AS (SELECT conv_id, depth, len(said) AS size, list_slice(said, 1, depth) AS node FROM depths),
    nodes AS (
        SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256
        FROM prefixes GROUP BY node, depth
    ),
    children AS (SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
    measured AS (
        SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[depth].text) END AS saved
        FROM nodes n LEFT JOIN children c ON c.node = n.node
    ),
    above AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM measured),
    sums AS (
        SELECT list_slice(node, 1, up) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
        FROM above GROUP BY 1
    )
    SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children,
        CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
    FROM measured m JOIN sums s ON s.node = m.node
    LEFT JOIN nodes p ON m.depth > 0 AND p.node = list_slice(m.node, 1, m.depth - 1)
    """


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
