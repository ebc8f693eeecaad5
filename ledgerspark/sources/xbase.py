"""xBase (DBF) tables as a Spark batch source.

The source itself only cuts a file into its fixed-width records: ``(path, rec_no, record,
plain)``. A file is split by record ranges, so one large file is read by many tasks.
Turning records into typed columns is left to native expressions (:func:`decode`);
``plain`` tells them that a record is printable ASCII throughout and needs no cleaning.
"""

from __future__ import annotations

import json
import logging
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerspark.functions.coerce import spark_type, typed
from ledgerspark.functions.text import clean_text, decode_cp1252, field_name, strip
from ledgerspark.operators.changes import union_folders
from ledgerspark.sources.locations import open_location
from ledgerspark.sources.memos import with_memos

log = logging.getLogger(__name__)

RECORD_SCHEMA = "path string, rec_no bigint, record binary, plain boolean"
SPLIT_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024


# ---- header --------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    label: str
    code: str
    length: int
    decimals: int
    offset: int

    @property
    def column(self) -> str:
        return field_name(self.label)


@dataclass(frozen=True)
class Header:
    record_count: int = 0
    header_size: int = 0
    record_size: int = 0
    fields: tuple[Field, ...] = ()

    def records_in(self, file_size: int) -> int:
        """Whole records that fit behind the header; a short last one does not count."""
        return max(0, file_size - self.header_size) // self.record_size if self.record_size else 0


# The flag of a live record, and the byte that ends the records.
_LIVE, _END_MARK = 0x20, 0x1A
# Bytes that are type codes; any other byte means character.
_TYPE_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ+"


def _label(raw: bytes) -> str:
    text = raw.replace(b"\0", b"").decode("ascii", "ignore")
    return "".join(c for c in text if " " <= c <= "~").strip()


def parse_header(blob: bytes) -> Header:
    """Header from a file's first bytes. 32-byte blocks, end mark 0x0D."""
    if len(blob) < 32:
        return Header()
    count, header_size, record_size = struct.unpack_from("<IHH", blob, 4)
    fields, offset = [], 1
    for at in range(32, len(blob) - 31, 32):
        block = blob[at : at + 32]
        if block[0] == 0x0D:
            break
        code = chr(block[11]) if block[11] in _TYPE_BYTES else "C"
        if label := _label(block[:11]):
            fields.append(Field(label, code, block[16], block[17], offset))
        offset += block[16]
    return Header(count, header_size, record_size, tuple(fields))


def read_header(path: str) -> Header:
    """Header of one file; an unreadable or empty one has no fields."""
    system, inner = open_location(path)
    with system.open_input_file(inner) as f:
        start = f.read(32)
        if len(start) < 32:
            return Header()
        size = struct.unpack_from("<H", start, 8)[0]
        return parse_header(start + f.read(max(0, size - 32)))


# ---- source --------------------------------------------------------------------


@dataclass
class RecordRange(InputPartition):
    path: str
    header_size: int
    record_size: int
    first: int
    count: int

    def __init__(self, path: str, header_size: int, record_size: int, first: int, count: int):
        super().__init__(None)
        self.path, self.header_size, self.record_size = path, header_size, record_size
        self.first, self.count = first, count


class XbaseDataSource(DataSource):
    """``spark.read.format("xbase")`` with ``path`` or a JSON list ``paths``; ``records`` (JSON list)
    says how many records count in each, ``limit`` how many live ones are wanted of each."""

    @classmethod
    def name(cls) -> str:
        return "xbase"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        given, counts, limit = (self.options.get(o) for o in ("paths", "records", "limit"))
        paths = json.loads(given) if given else [self.options["path"]]
        return XbaseReader(
            paths, counts and json.loads(counts), int(self.options.get("splitBytes", SPLIT_BYTES)), None if limit is None else int(limit)
        )


def _printable(block: bytes, rows: int, width: int) -> np.ndarray:
    codes = np.frombuffer(block, np.uint8).reshape(rows, width)
    return (codes.min(axis=1) >= 0x20) & (codes.max(axis=1) < 0x7F)


def _held(system: fs.FileSystem, inner: str, header: Header) -> int:
    return header.records_in(system.get_file_info(inner).size or 0)


def record_counts(spark: SparkSession, paths: Sequence[str]) -> list[int]:
    """Records of each file before the end mark 0x1A, or all that it holds.

    The driver reads headers, and the one byte where a header's count says that the records
    end. Files without the mark there, which are logged, are searched by a job: each task
    reports the first mark among the flags of a range of records, and the least one counts.
    """
    counts, unsure = {}, []
    for path in paths:
        header = read_header(path)
        system, inner = open_location(path)
        counts[path] = held = _held(system, inner, header)
        if header.record_count == held or not held:
            continue
        if header.record_count < held:
            with system.open_input_file(inner) as f:
                if f.read_at(1, header.header_size + header.record_count * header.record_size) == b"\x1a":
                    counts[path] = header.record_count
                    continue
        log.warning("%s: the header says %d records, the file holds %d", inner, header.record_count, held)
        step = max(1, SPLIT_BYTES // header.record_size)
        unsure += [(path, header.header_size, header.record_size, at, min(step, held - at)) for at in range(0, held, step)]
    if unsure:
        ranges = spark.createDataFrame(unsure, "path string, header_size bigint, width bigint, first bigint, count bigint")
        marks = ranges.repartition(len(unsure)).mapInArrow(_first_marks, "path string, mark bigint").groupBy("path").agg(F.min("mark").alias("mark"))
        counts |= {r.path: r.mark for r in marks.collect()}  # one row per file with a mark
    return [counts[p] for p in paths]


def _first_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, header_size, width, first, count in zip(*(c.to_pylist() for c in batch.columns)):
            system, inner = open_location(path)
            step = max(1, BATCH_BYTES // width)
            with system.open_input_file(inner) as f:
                for at in range(first, first + count, step):
                    rows = min(step, first + count - at)
                    flags = np.frombuffer(f.read_at(rows * width, header_size + at * width), np.uint8)[::width]
                    if (ends := np.flatnonzero(flags == _END_MARK)).size:
                        found.append((path, at + int(ends[0])))
                        break
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([m for _, m in found], pa.int64())], names=["path", "mark"])


class XbaseReader(DataSourceReader):
    def __init__(self, paths: list[str], counts: list[int] | None, split_bytes: int, limit: int | None):
        self.paths, self.counts, self.split_bytes, self.limit = paths, counts, split_bytes, limit

    def partitions(self) -> list[RecordRange]:
        """Ranges of records. With a limit, one for each file, which reads as far as it has to."""
        ranges = []
        for path, records in zip(self.paths, self.counts or [None] * len(self.paths)):
            header = read_header(path)
            if records is None:
                records = _held(*open_location(path), header)
                if self.limit is None and records != header.record_count:
                    raise ValueError(f"{path}: give the number of records, which the header does not say")
            step = records if self.limit is not None else max(1, self.split_bytes // max(1, header.record_size))
            for first in range(0, records, max(1, step)):
                count = min(step, records - first)
                ranges.append(RecordRange(path, header.header_size, header.record_size, first, count))
        return ranges or [RecordRange("", 0, 1, 0, 0)]

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        width, left = partition.record_size, self.limit
        step = max(1, BATCH_BYTES // width)
        if left is not None:
            step = min(step, max(1, 2 * left))
        system, inner = open_location(partition.path)
        with system.open_input_file(inner) as f:
            for first in range(partition.first, partition.first + partition.count, step):
                wanted = min(step, partition.first + partition.count - first)
                block = f.read_at(wanted * width, partition.header_size + first * width)
                rows, ended = len(block) // width, False
                if rows < wanted:
                    raise OSError(f"{partition.path} became shorter while it was read")
                if left is not None:
                    rows, left, ended = _first_live(block, rows, width, left)
                    block = block[: rows * width]
                if rows:
                    yield self._batch(partition.path, first, block, rows, width)
                if ended:
                    return

    @staticmethod
    def _batch(path: str, first: int, block: bytes, rows: int, width: int) -> pa.RecordBatch:
        ends = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(path), rows),
                pa.array(np.arange(first, first + rows, dtype=np.int64)),
                pa.BinaryArray.from_buffers(pa.binary(), rows, [None, ends.buffers()[1], pa.py_buffer(block)]),
                pa.array(_printable(block, rows, width)),
            ],
            names=["path", "rec_no", "record", "plain"],
        )


def _first_live(block: bytes, rows: int, width: int, left: int) -> tuple[int, int, bool]:
    """Rows up to the last wanted live record or the end mark, live records still wanted, and
    whether reading ends here."""
    flags = np.frombuffer(block, np.uint8)[: rows * width : width]
    ends = np.flatnonzero(flags == _END_MARK)
    held = int(ends[0]) if ends.size else rows
    live = np.flatnonzero(flags[:held] == _LIVE)
    if live.size >= left:
        return int(live[left - 1]) + 1 if left else 0, 0, True
    return held, left - int(live.size), bool(ends.size)


def scan_records(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES, limit: int | None = None) -> DataFrame:
    """Records of files; with ``limit`` the first so many live ones of each, and only them are read."""
    spark.dataSource.register(XbaseDataSource)
    reader = spark.read.format("xbase").option("paths", json.dumps(list(paths))).option("splitBytes", str(split_bytes))
    if limit is not None:
        return reader.option("limit", str(limit)).load()
    return reader.option("records", json.dumps(record_counts(spark, paths))).load()


# ---- records to columns ----------------------------------------------------------

# Fields stored as numbers and not as text, by type code and length.
_BINARY = {("I", 4), ("+", 4), ("Y", 8), ("T", 8), ("B", 8)}
# Fixed value: Julian day number of 1970-01-01.
_EPOCH_DAY = 2440588


def _little_endian(raw: Column, first: int, size: int) -> Column:
    """Signed integer of ``size`` bytes from byte ``first`` (counted from 1)."""
    digits = F.hex(F.concat(*[F.substring(raw, i, 1) for i in range(first + size - 1, first - 1, -1)]))
    unsigned = F.conv(digits, 16, 10).cast("decimal(20,0)")
    bound = F.lit(str(1 << (8 * size - 1))).cast("decimal(20,0)")
    return F.when(unsigned >= bound, unsigned - 2 * bound).otherwise(unsigned)


def _binary_value(raw: Column, field: Field) -> Column:
    """Integers, currency in ten-thousandths, doubles, and a Julian day with milliseconds."""
    if field.code == "B":
        return _double(raw)
    if field.code == "Y":
        return (_little_endian(raw, 1, 8) / 10000).cast("decimal(19,4)")
    if field.code == "T":
        day, milliseconds = _little_endian(raw, 1, 4).cast("int"), _little_endian(raw, 5, 4).cast("bigint")
        date = F.date_from_unix_date(day - _EPOCH_DAY).cast("timestamp_ntz")
        return F.when(day > 0, date + F.make_dt_interval(secs=milliseconds / 1000))
    return _little_endian(raw, 1, 4).cast("int" if field.code == "I" else "bigint")


def _double(raw: Column) -> Column:
    """IEEE double of eight little-endian bytes, put together exactly from its parts; NULL
    for infinities and what is not a number."""
    top = F.conv(F.hex(F.concat(F.substring(raw, 8, 1), F.substring(raw, 7, 1))), 16, 10).cast("int")
    exponent = F.shiftright(top, 4).bitwiseAND(0x7FF)
    low = F.conv(F.hex(F.concat(*[F.substring(raw, i, 1) for i in range(6, 0, -1)])), 16, 10).cast("bigint")
    fraction = F.shiftleft(top.bitwiseAND(0xF).cast("bigint"), 48).bitwiseOR(low)
    whole = F.when(exponent == 0, fraction).otherwise(fraction + (1 << 52)).cast("double")
    size = whole * F.pow(F.lit(2.0), (F.greatest(exponent, F.lit(1)) - 1075).cast("double"))
    return F.when(exponent < 0x7FF, F.when(top.bitwiseAND(0x8000) != 0, -size).otherwise(size))


def _pointer(raw: Column, length: int) -> Column:
    """Block number of a memo: four little-endian bytes, or digits; NULL if there is none."""
    number = _little_endian(raw, 1, 4) if length == 4 else F.trim(decode_cp1252(raw)).try_cast("bigint")
    return F.when(number > 0, number.cast("bigint"))


def _value(field: Field) -> Column:
    raw = F.substring("record", field.offset + 1, field.length)
    if field.code == "M":
        return _pointer(raw, field.length)
    if (field.code, field.length) in _BINARY:
        return _binary_value(raw, field)
    special = decode_cp1252(raw)
    special = clean_text(special) if isinstance(spark_type(field.code), T.StringType) else strip(special)
    value = F.nullif(F.when(F.col("plain"), F.trim(raw.cast("string"))).otherwise(special), F.lit(""))
    return typed(value, field.code, field.length, field.decimals)


def decode(records: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Typed columns of the live records (those with a blank flag), after all columns but
    ``record`` and ``plain``.

    Every field is a byte slice run through native functions, so the projection stays
    inside generated code and unused fields are pruned. Only a record with accents or
    control characters pays for decoding and cleaning.
    """
    names = [f.column for f in fields]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"field names collide after normalization: {twice}")
    live = records.filter(F.expr("substring(record, 1, 1) = X'20'"))
    kept = [c for c in records.columns if c not in ("record", "plain")]
    return live.select(*kept, *[_value(f).alias(f.column) for f in fields])


def read_xbase(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES, limit: int | None = None) -> DataFrame:
    """Live records of files of the same table, with ``_source_path`` and
    record number ``_seq``; with ``limit`` the first so many of each file.

    Files whose headers agree are read by one scan; a file with another layout gets
    its own, and a field it lacks is NULL. Memo fields hold the texts of the companion file,
    NULL if there is none.
    """
    layouts: dict[tuple[Field, ...], list[str]] = {}
    for path in paths:
        header = read_header(path)
        if not header.fields:
            raise ValueError(f"header of {path} declares no fields")
        layouts.setdefault(header.fields, []).append(path)
    frames = []
    for fields, same in layouts.items():
        records = scan_records(spark, same, split_bytes, limit)
        rows = decode(records.withColumnsRenamed({"path": "_source_path", "rec_no": "_seq"}), fields)
        frames.append(with_memos(rows, same, [f.column for f in fields if f.code == "M"]))
    return union_folders(frames)


def layout(*columns: tuple[str, str, int, int]) -> tuple[Field, ...]:
    """Fields laid out one after the other behind the deletion flag."""
    fields, offset = [], 1
    for label, code, length, decimals in columns:
        fields.append(replace(Field(label, code, length, decimals, 0), offset=offset))
        offset += length
    return tuple(fields)
