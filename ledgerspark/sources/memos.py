"""Texts of memo fields, which lie in a companion file beside the table.

A record holds the number of the block where its memo begins. The distinct numbers are
shuffled by ranges of the companion file; a task opens the file once and reads its range from
front to back, and a join takes the texts to the records.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions.text import clean_text, decode_cp1252
from ledgerspark.sources.locations import exists, open_location

RANGE_BYTES = 64 * 1024 * 1024
WINDOW_BYTES = 1024 * 1024
BATCH_BYTES = 16 * 1024 * 1024

# Endings of companion files, by kind of file.
_ENDINGS = (".FPT", ".fpt", ".DBT", ".dbt")
# Version byte of tables whose memos have a length, block size without one in the
# header, bytes that end a memo without a length, start of a memo with one, type code of text.
_WITH_LENGTH, _BLOCK, _ENDED, _BEGIN, _TEXT = 0x8B, 512, b"\x1a", b"\xff\xff\x08\x00", 1


@dataclass(frozen=True)
class MemoFile:
    path: str
    kind: str
    block: int


def companion(path: str) -> MemoFile | None:
    """The memo file of a table, if it exists: ``fpt`` (big-endian lengths), ``dbt4`` (lengths) or
    ``dbt3`` (ended by 0x1A)."""
    stem = path.rpartition(".")[0]
    for ending in _ENDINGS:
        if exists(stem + ending):
            break
    else:
        return None
    system, inner = open_location(stem + ending)
    with system.open_input_file(inner) as f:
        head = f.read(24)
    if ending.lower() == ".fpt":
        return MemoFile(stem + ending, "fpt", (struct.unpack_from(">H", head, 6)[0] if len(head) >= 8 else 0) or _BLOCK)
    system, inner = open_location(path)
    with system.open_input_file(inner) as f:
        version = f.read(1)
    if version == bytes([_WITH_LENGTH]):
        return MemoFile(stem + ending, "dbt4", (struct.unpack_from("<H", head, 20)[0] if len(head) >= 22 else 0) or _BLOCK)
    return MemoFile(stem + ending, "dbt3", _BLOCK)


class _Window:
    """Bytes of a file that is read from front to back, mostly in large pieces."""

    def __init__(self, f):
        self.f, self.size, self.start, self.held = f, f.size(), 0, b""

    def read(self, at: int, size: int) -> bytes:
        size = max(0, min(size, self.size - at))
        if not self.start <= at <= at + size <= self.start + len(self.held):
            self.start, self.held = at, self.f.read_at(max(size, min(WINDOW_BYTES, self.size - at)), at) if size else b""
        return self.held[at - self.start : at - self.start + size]


def _memo(window: _Window, kind: str, at: int) -> bytes | None:
    """The memo that begins at a byte; None if nothing readable does."""
    if kind == "dbt3":
        found, end = b"", -1
        while end < 0 and (piece := window.read(at + len(found), _BLOCK)):
            end = piece.find(_ENDED)
            found += piece if end < 0 else piece[:end]
        return found or None
    head = window.read(at, 8)
    if len(head) < 8:
        return None
    if kind == "fpt":
        code, length = struct.unpack(">II", head)
        text = window.read(at + 8, length) if code == _TEXT else b""
        return text if len(text) == length and text else None
    length = struct.unpack_from("<I", head, 4)[0] - 8
    if head[:4] != _BEGIN or length <= 0:
        return None
    text = window.read(at + 8, length)
    return text.split(b"\x1f", 1)[0] if len(text) == length else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns))
        out: list[tuple[str, int, bytes | None]] = []
        size = 0
        for (memo, kind, block), wanted in groupby(rows, key=lambda r: r[1:4]):
            system, inner = open_location(memo)
            with system.open_input_file(inner) as f:
                window = _Window(f)
                for source, _, _, _, number in wanted:
                    found = _memo(window, kind, number * block)
                    out.append((source, number, found))
                    size += len(found or b"")
                    if size >= BATCH_BYTES:
                        yield _batch(out)
                        out, size = [], 0
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    kinds = (pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["memo_source", "memo_block", "memo"])


def with_memos(rows: DataFrame, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``rows`` with the texts of memo fields in place of their block numbers. ``rows`` has
    ``_source_path``, one of ``paths``, whose companion files are looked up on the driver."""
    if not columns:
        return rows
    spark, found = rows.sparkSession, {p: companion(p) for p in paths}
    known = [(p, m.path, m.kind, m.block) for p, m in found.items() if m]
    if not known:
        return rows.withColumns({c: F.lit(None).cast("string") for c in columns})
    files = F.broadcast(spark.createDataFrame(known, "_source_path string, memo_path string, kind string, block bigint"))  # a row per file
    numbers = rows.select("_source_path", F.explode(F.array(*columns)).alias("number")).where("number IS NOT NULL").distinct()
    part = F.expr(f"number * block DIV {RANGE_BYTES}")
    spread = numbers.join(files, "_source_path").repartition(F.col("memo_path"), part).sortWithinPartitions("memo_path", "number")
    memos = spread.select("_source_path", "memo_path", "kind", "block", "number").mapInArrow(_read, "memo_source string, memo_block bigint, memo binary")
    texts = memos.select("memo_source", "memo_block", F.nullif(clean_text(decode_cp1252(F.col("memo"))), F.lit("")).alias("memo"))
    order = rows.columns
    for column in columns:
        here = (F.col("_source_path") == F.col("memo_source")) & (F.col(column) == F.col("memo_block"))
        rows = rows.join(texts, here, "left").drop("memo_source", "memo_block", column).withColumnRenamed("memo", column)
    return rows.select(*order)
