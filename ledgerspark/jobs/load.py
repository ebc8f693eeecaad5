"""Load changed xBase files into raw tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from ledgerspark.jobs.store import Store, new_run, now
from ledgerspark.operators.changes import changed_files
from ledgerspark.operators.dedup import exact_dedup
from ledgerspark.operators.evolve import evolve
from ledgerspark.operators.lineage import META_COLUMNS, business_columns, with_lineage
from ledgerspark.schemas import FILE_STATE, SYNC_LOG
from ledgerspark.sources.files import fingerprints, list_sources
from ledgerspark.sources.tables import write_table
from ledgerspark.sources.xbase import read_xbase

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    source_folder: str
    table_name: str
    status: str
    rows: int = 0
    duplicates: int = 0
    message: str | None = None


LOAD_RESULT = "source_folder string, table_name string, status string, rows bigint, duplicates bigint, message string"


def prepare(
    records: DataFrame, folder: str, table: str, previous: T.StructType | None, dedup: bool = True
) -> DataFrame:
    """Decoded records as rows of a raw table: repeats dropped, columns evolved, lineage added."""
    columns = business_columns(records)
    rows = exact_dedup(records, columns, "_seq") if dedup else records.select(*columns, "_seq")
    if previous is not None:
        known = [f for f in previous.fields if f.name not in META_COLUMNS]
        rows = evolve(rows, T.StructType([*known, previous["_seq"]]))
    return with_lineage(rows, folder, table)


def load_file(
    store: Store, file: Row, log_id: str, started: datetime, previous: str | None, dedup: bool = True
) -> LoadResult:
    """Load one file completely or not at all; the result is logged either way.

    ``previous`` is the directory of the slice's current version, if it has one.
    """
    folder, table = file.source_folder, file.table_name
    try:
        target = store.path("raw", table, folder, new_run())
        in_seen, out_seen = Observation(), Observation()
        records = read_xbase(store.spark, [file.path]).observe(in_seen, F.count(F.lit(1)).alias("rows"))
        known = store.spark.read.parquet(previous).schema if previous else None
        rows = prepare(records, folder, table, known, dedup)
        values = business_columns(rows)
        blank = F.when(F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in values]).isNull(), 1)
        rows = rows.observe(out_seen, F.count(F.lit(1)).alias("rows"), F.count(blank).alias("blank"))
        write_table(rows, target)
        # The recorded count comes from the written files. Observed metrics cost no second
        # pass but may count a re-run task twice, so they only feed the messages; for an
        # empty file they are planned away together with the rest of the work.
        kept, duplicates = store.spark.read.parquet(target).count(), 0
        if kept:
            duplicates = max(0, in_seen.get["rows"] - out_seen.get["rows"])
            if out_seen.get["blank"] >= kept:
                log.warning("%s/%s: every row is NULL in all columns", folder, table)
        store.append(
            "file_state", [(folder, table, file.path, file.file_hash, now(), kept, target)], FILE_STATE
        )
        result = LoadResult(folder, table, "success", kept, duplicates)
    except Exception as problem:  # one bad file must not stop the others
        log.exception("%s/%s failed", folder, table)
        result = LoadResult(folder, table, "error", message=str(problem))
    store.append(
        "sync_log",
        [(log_id, folder, table, started, now(), result.rows, result.status, result.message, file.file_hash, result.duplicates)],
        SYNC_LOG,
    )
    return result


def load_sources(
    spark: SparkSession,
    root: str,
    folders: Mapping[str, str],
    mode: str = "incremental",
    only_table: str | None = None,
    dedup: bool = True,
    at_once: int = 4,
) -> list[LoadResult]:
    """Load all files, or just the changed ones. Each load is a Spark job of its own; a
    few are submitted side by side so that small tables do not wait for large ones."""
    store = Store(spark, root)
    files = list_sources(spark, folders, only_table)
    listed = fingerprints(files).collect()  # file names and hashes only: one row per file
    if only_table and not listed:
        raise LookupError(f"table {only_table} is in none of the folders")
    if not listed:
        return []
    schema = "source_folder string, table_name string, path string, length bigint, modified timestamp, file_hash string"
    state = store.file_state()
    todo = changed_files(spark.createDataFrame(listed, schema), state, mode).collect()
    pending = {(f.source_folder, f.table_name) for f in todo}
    skipped = [
        LoadResult(f.source_folder, f.table_name, "skipped")
        for f in listed
        if (f.source_folder, f.table_name) not in pending
    ]
    if not todo:
        return skipped
    current = {(s.source_folder, s.table_name): s.data_path for s in state.collect()}
    started = now()
    ids = [uuid.uuid4().hex for _ in todo]
    running = [
        (i, f.source_folder, f.table_name, started, None, 0, "running", None, f.file_hash, None) for i, f in zip(ids, todo)
    ]
    store.append("sync_log", running, SYNC_LOG)

    def load_one(log_id: str, file: Row) -> LoadResult:
        previous = current.get((file.source_folder, file.table_name))
        return load_file(store, file, log_id, started, previous, dedup)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        done = list(pool.map(load_one, ids, todo))
    return done + skipped


def summary(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """Synced, skipped and failed tables, and rows written."""
    rows = spark.createDataFrame([tuple(vars(r).values()) for r in results], LOAD_RESULT)

    def having(status: str):
        return F.count(F.when(F.col("status") == status, 1))

    return rows.agg(
        having("success").alias("synced"),
        having("skipped").alias("skipped"),
        having("error").alias("errors"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
