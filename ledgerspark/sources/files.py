"""Listing, fingerprinting and describing xBase files with Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspark.operators.changes import union_folders
from ledgerspark.sources.locations import open_location
from ledgerspark.sources.xbase import read_header
from ledgerspark.values import SKIPPED_TABLES

FILE_COLUMNS = "source_folder string, table_name string, path string, length bigint, modified timestamp"
XBASE_GLOB = "{*.DBF,*.dbf}"
RANGE_BYTES = 64 * 1024 * 1024
_CHUNK = 1024 * 1024


def _exists(path: str) -> bool:
    system, inner = open_location(path)
    return system.get_file_info(inner).type == fs.FileType.Directory


def list_sources(
    spark: SparkSession,
    folders: Mapping[str, str],
    only_table: str | None = None,
    skip: Iterable[str] = SKIPPED_TABLES,
    glob: str = XBASE_GLOB,
) -> DataFrame:
    """One row per (folder, table): path, size and time. Content is never read.

    ``folders`` maps a folder code to its path; a missing path is skipped. Of several
    files with the same stem the one with a lower-case ending wins, then the last path.
    """
    found = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.lit(code).alias("source_folder"), "path", "length", F.col("modificationTime").alias("modified"))
        for code, path in folders.items()
        if _exists(path)
    ]
    if not found:
        return spark.createDataFrame([], FILE_COLUMNS)
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    files = union_folders(found).withColumn("table_name", F.upper(stem)).filter(~F.col("table_name").isin(*skip))
    if only_table:
        files = files.filter(F.col("table_name") == only_table.upper())
    preferred = F.struct(F.substring_index("path", ".", -1), "path")
    best = files.groupBy("source_folder", "table_name").agg(
        F.max_by(F.struct("path", "length", "modified"), preferred).alias("file")
    )
    return best.select("source_folder", "table_name", "file.*")


def _spread(files: DataFrame) -> DataFrame:
    """One file per row means little data but much work: never coalesce it to one task."""
    return files.repartition(max(2, files.sparkSession.sparkContext.defaultParallelism), "path")


def _range_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hashes = [_md5(*r) for r in zip(batch["path"], batch["first"], batch["size"])]
        yield batch[["path", "first"]].assign(digest=hashes)


def _md5(path: str, first: int, size: int) -> str | None:
    digest, end = hashlib.md5(), first + size
    system, inner = open_location(path)
    try:
        with system.open_input_file(inner) as f:
            for at in range(first, end, _CHUNK):
                digest.update(f.read_at(min(_CHUNK, end - at), at))
    except OSError:
        return None
    return digest.hexdigest()


def fingerprints(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Add a digest of each file's bytes as ``file_hash``; NULL for an unreadable file.

    A file is cut into ranges that are hashed by tasks of their own. A file of one range has
    the MD5 of its bytes, a longer one the MD5 of its ranges' digests in order. A file that
    changes its length after the listing gets another digest with the next listing.
    """
    last = F.greatest(F.expr(f"(length - 1) DIV {range_bytes}"), F.lit(0))
    cut = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("at"))
    first = F.col("at") * range_bytes
    sized = cut.select("path", first.alias("first"), F.least(F.lit(range_bytes), F.col("length") - first).alias("size"))
    spread = sized.repartition(max(2, files.sparkSession.sparkContext.defaultParallelism), "path", "first")
    hashed = spread.mapInPandas(_range_hashes, "path string, first bigint, digest string")
    # One digest per range of a file: a file of 100 GB has about 1,600.
    whole = hashed.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("first", "digest"))).alias("parts"), F.count_if(F.col("digest").isNull()).alias("unread")
    )
    digest = F.when(F.size("parts") == 1, F.col("parts")[0]["digest"]).otherwise(F.md5(F.array_join("parts.digest", "").cast("binary")))
    return files.join(whole.select("path", F.when(F.col("unread") == 0, digest).alias("file_hash")), "path", "left").select(*files.columns, "file_hash")


_CATALOG = """source_folder string, table_name string, full_path string, record_count bigint,
file_size_kb double, last_modified timestamp,
fields array<struct<name:string, type:string, length:int, decimals:int>>"""


def _described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        headers = [read_header(p) for p in batch["path"]]
        yield pd.DataFrame(
            {
                "source_folder": batch["source_folder"],
                "table_name": batch["table_name"],
                "full_path": batch["path"],
                "record_count": [h.record_count for h in headers],
                "file_size_kb": (batch["length"] / 1024).round(1),
                "last_modified": batch["modified"],
                "fields": [
                    [{"name": f.label, "type": f.code, "length": f.length, "decimals": f.decimals} for f in h.fields]
                    for h in headers
                ],
            }
        )


def file_catalog(files: DataFrame) -> DataFrame:
    """Catalog (see :mod:`ledgerspark.plans.profile`) of listed files from their headers."""
    return _spread(files).mapInPandas(_described, _CATALOG)
