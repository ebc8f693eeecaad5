"""Lineage columns and row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

META_COLUMNS = ("_source_folder", "_source_table", "_synced_at", "_row_hash", "_source_path", "_seq")


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META_COLUMNS]


def row_hash(columns: Sequence[str]) -> Column:
    """First 16 hex digits of the MD5 of the row as JSON, keys sorted and NULLs kept."""
    ordered = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.substring(F.md5(F.to_json(ordered, {"ignoreNullFields": "false"})), 1, 16)


def with_lineage(df: DataFrame, folder: str | Column, table: str | Column) -> DataFrame:
    folder = F.lit(folder) if isinstance(folder, str) else folder
    table = F.lit(table) if isinstance(table, str) else table
    return df.withColumns(
        {
            "_source_folder": folder,
            "_source_table": table,
            "_synced_at": F.current_timestamp(),
            "_row_hash": row_hash(business_columns(df)),
        }
    )
