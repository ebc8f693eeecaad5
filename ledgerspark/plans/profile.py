"""Data dictionary: table summary, fields, shared fields and samples.

All of it works on a *catalog*, one row per (folder, table): ``source_folder,
table_name, full_path, record_count, file_size_kb, last_modified, fields`` where fields
is an array of ``(name, type, length, decimals)``. A catalog comes from file headers or
from tables Spark already holds.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerspark.operators.changes import union_folders
from ledgerspark.operators.lineage import business_columns
from ledgerspark.sources.xbase import read_xbase
from ledgerspark.values import (
    FIELD_MEANINGS,
    FIELD_TYPE_LABELS,
    FOLDERS,
    JOIN_HINTS,
    SAMPLE_ROWS,
    TABLE_PURPOSES,
    UNKNOWN_JOIN,
    UNKNOWN_PURPOSE,
)

log = logging.getLogger(__name__)


def _looked_up(values: dict[str, str], key: Column, missing: str | Column) -> Column:
    pairs = [F.lit(text) for pair in values.items() for text in pair]
    missing = F.lit(missing) if isinstance(missing, str) else missing
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), missing)


def xbase_type(kind: T.DataType) -> tuple[str, int, int]:
    """Type code, length and decimals that describe a Spark column in a dictionary."""
    match kind:
        case T.DecimalType():
            return "N", kind.precision, kind.scale
        case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType():
            return "I", 4, 0
        case T.FloatType() | T.DoubleType():
            return "B", 8, 0
        case T.DateType():
            return "D", 8, 0
        case T.BooleanType():
            return "L", 1, 0
        case T.TimestampType() | T.TimestampNTZType():
            return "T", 8, 0
        case _:
            return "C", 0, 0


def catalog_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Catalog of raw tables: folders and record counts come from the rows themselves."""

    def entry(name: str, df: DataFrame) -> DataFrame:
        fields = [
            F.struct(
                F.lit(c.upper()).alias("name"),
                F.lit(code).alias("type"),
                F.lit(length).alias("length"),
                F.lit(decimals).alias("decimals"),
            )
            for c in business_columns(df)
            for code, length, decimals in [xbase_type(df.schema[c].dataType)]
        ]
        return (
            df.groupBy(F.col("_source_folder").alias("source_folder"))
            .agg(F.count("*").alias("record_count"))
            .select(
                "source_folder",
                F.lit(name).alias("table_name"),
                F.lit(None).cast("string").alias("full_path"),
                "record_count",
                F.lit(None).cast("double").alias("file_size_kb"),
                F.lit(None).cast("timestamp").alias("last_modified"),
                F.array(*fields).alias("fields"),
            )
        )

    return union_folders([entry(n, df) for n, df in tables.items()])


def table_summary(catalog: DataFrame) -> DataFrame:
    """One row per table and a closing total row (``TOTAL``, number of tables as name)."""
    tables = catalog.select(
        "source_folder",
        "table_name",
        "record_count",
        F.size("fields").alias("field_count"),
        "file_size_kb",
        "last_modified",
        _looked_up(TABLE_PURPOSES, F.col("table_name"), UNKNOWN_PURPOSE).alias("known_purpose"),
    )
    total = catalog.agg(
        F.count("*").cast("string").alias("table_name"), F.sum("record_count").alias("record_count")
    ).select(F.lit("TOTAL").alias("source_folder"), "table_name", "record_count")
    return tables.unionByName(total, allowMissingColumns=True)


def _fields(catalog: DataFrame) -> DataFrame:
    return catalog.select("source_folder", "table_name", F.explode("fields").alias("field")).select(
        "source_folder", "table_name", "field.*"
    )


def find_relationships(catalog: DataFrame) -> DataFrame:
    """Fields found in more than one table, case ignored, with the tables and a join hint.

    The gathered list has one entry per table, so its size is that of the catalog.
    """
    place = F.concat_ws("/", "source_folder", "table_name")
    shared = _fields(catalog).groupBy(F.upper("name").alias("field_name")).agg(
        F.array_sort(F.collect_set(place)).alias("tables")
    )
    return shared.filter(F.size("tables") > 1).select(
        "field_name",
        F.array_join("tables", ", ").alias("tables"),
        _looked_up(JOIN_HINTS, F.col("field_name"), UNKNOWN_JOIN).alias("join_hint"),
    )


def field_dictionary(catalog: DataFrame) -> DataFrame:
    """One row per field with type label, known meaning and whether it is shared."""
    shared = find_relationships(catalog).select("field_name", F.lit(True).alias("is_join_key"))
    fields = _fields(catalog).withColumn("field_name", F.upper("name"))
    unknown = F.concat(F.lit("Unknown("), F.col("type"), F.lit(")"))
    return fields.join(shared, "field_name", "left").select(
        "source_folder",
        "table_name",
        F.col("name").alias("field_name"),
        "type",
        _looked_up(FIELD_TYPE_LABELS, F.col("type"), unknown).alias("type_label"),
        "length",
        "decimals",
        _looked_up(FIELD_MEANINGS, F.col("field_name"), "").alias("meaning"),
        F.coalesce("is_join_key", F.lit(False)).alias("is_join_key"),
    )


def sample_rows(raw: DataFrame, rows: int = SAMPLE_ROWS, fields: int | None = None, folders: Iterable[str] = FOLDERS) -> DataFrame:
    """First rows of each of the folders in source order, as text, NULL as empty; all fields
    unless ``fields`` asks for the first few.

    A folder's rows are a top-k: each task keeps its ``rows`` first ones and nothing is sorted.
    """
    shown = business_columns(raw)[:fields]
    texts = raw.select("_source_folder", "_seq", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in shown])
    return _numbered(union_folders([texts.filter(F.col("_source_folder") == f).orderBy("_seq").limit(rows) for f in folders]), shown)


def _numbered(first: DataFrame, shown: list[str]) -> DataFrame:
    """The few picked rows of each folder with their place."""
    listed = first.groupBy(F.col("_source_folder").alias("source_folder")).agg(F.array_sort(F.collect_list(F.struct("_seq", *shown))).alias("rows"))
    placed = listed.select("source_folder", F.posexplode("rows").alias("place", "row"))
    return placed.select("source_folder", (F.col("place") + 1).alias("row_no"), *[F.col(f"row.`{c}`").alias(c) for c in shown])


def sample_files(spark: SparkSession, files: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """First live records of each listed xBase file: ``source_folder``, ``table_name``, ``row_no``
    and ``values``, a map of field names to texts. No file is read further than that."""
    frames = []
    for file in files.select("source_folder", "table_name", "path").collect():  # names only: one row per file
        try:
            found = read_xbase(spark, [file.path], limit=rows)
        except ValueError as problem:  # a header without fields has no rows to show
            log.warning("%s: %s", file.path, problem)
            continue
        shown = [c for c in found.columns if c not in ("_source_path", "_seq")]
        values = F.create_map(*[x for c in shown for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))])
        listed = found.agg(F.array_sort(F.collect_list(F.struct("_seq", F.to_json(values).alias("body")))).alias("rows"))
        placed = listed.select(F.posexplode("rows").alias("place", "row"))
        frames.append(
            placed.select(
                F.lit(file.source_folder).alias("source_folder"),
                F.lit(file.table_name).alias("table_name"),
                (F.col("place") + 1).alias("row_no"),
                F.from_json("row.body", "map<string,string>").alias("values"),
            )
        )
    return union_folders(frames) if frames else spark.createDataFrame([], "source_folder string, table_name string, row_no int, values map<string,string>")
