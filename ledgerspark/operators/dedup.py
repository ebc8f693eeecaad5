"""Removing repeats without ever gathering a group in one place.

What is aggregated is narrow and hashed, so every map task first shrinks its own share of a
group to one row; a key or a set of copies that holds a third of the table reaches the
reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: str, distinct_nulls: bool = False) -> DataFrame:
    """First row per key by ``order``, which is not NULL and unique within a key.

    Only keys and positions are aggregated. The keys found more than once, with their first
    position, are joined back to the rows, so full rows are never sorted to find the first
    one and a row without a repeated key passes as it is. With ``distinct_nulls`` a row
    with a NULL key column never equals another one, as in a SQL unique key.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    found = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    repeated = found.agg(F.min(order).alias("_first"), F.count("*").alias("_copies")).filter("_copies > 1")
    same = [F.col(k) == F.col(n) if distinct_nulls else F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    marked = df.join(repeated.drop("_copies"), same, "left")
    return marked.filter(F.col("_first").isNull() | (F.col(order) == F.col("_first"))).select(*df.columns)


def exact_dedup(df: DataFrame, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per distinct combination of ``columns`` (NULLs equal), with its first ``order``."""
    if order is None:
        return df.select(*columns).distinct()
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def duplicate_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows, distinct rows and dropped repeats per ``by`` (a subset of ``columns``)."""
    copies = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    return copies.groupBy(*by).agg(
        F.sum("_copies").alias("rows_read"),
        F.count("*").alias("rows_kept"),
        (F.sum("_copies") - F.count("*")).alias("duplicates_skipped"),
    )
