"""Helpers of several operators: tables in the shared folder, sizes, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, as the contracts define words: \x20 and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[ \t-\r]"


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the planner true sizes, so it
    broadcasts a side only if its files are small. The cluster's retention of the
    checkpoint folder removes the files.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """A column name that a table does not have yet, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, even if lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words of a text, split at ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def _state(labels: DataFrame) -> tuple:
    return tuple(labels.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "parent"))).first())


def components(links: DataFrame, src: str, dst: str) -> DataFrame:
    """Distributed union-find: ``node`` and ``component`` (smallest node reachable).

    Every round each node takes the smallest grandparent of itself and its neighbours, and
    passes it to its own parent, so trees both hook and halve; the rounds grow with the
    logarithm of the longest chain. A node with very many links is on the side of a join
    that the planner can split, since the other side is a stored table. Links with a null
    end and loops are left out.
    """
    pairs = links.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    both = store(pairs.union(pairs.select("v", "u")).distinct(), "links")
    labels = store(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select("node", F.least("node", "v").alias("parent")), "labels")
    state = _state(labels)
    while True:
        tops = labels.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        seen = store(labels.join(tops, "parent").select("node", "parent", "top"), "tops")
        near = both.join(seen.select(F.col("node").alias("v"), "top"), "v").groupBy("u").agg(F.min("top").alias("near"))
        best = seen.join(near, F.col("node") == F.col("u")).select("node", "parent", F.least("top", "near").alias("best"))
        offers = best.select(F.explode(F.array("node", "parent")).alias("node"), "best")
        labels = store(offers.groupBy("node").agg(F.min("best").alias("parent")), "labels")
        if state == (state := _state(labels)):
            return labels.select("node", F.col("parent").alias("component"))
