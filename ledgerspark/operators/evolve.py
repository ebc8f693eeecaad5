"""Schema evolution: columns are added, never removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _merged_type(old: T.DataType, new: T.DataType) -> T.DataType:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        return T.DecimalType(min(38, whole + scale), scale)
    return old


def evolved_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns first, then the newly seen ones; numbers widen, other types stay."""
    fresh = {f.name: f.dataType for f in new.fields}
    kept = [T.StructField(f.name, _merged_type(f.dataType, fresh.get(f.name, f.dataType))) for f in old.fields]
    known = set(old.fieldNames())
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known])


def evolve(df: DataFrame, old: T.StructType) -> DataFrame:
    """``df`` in the evolved schema: columns it lacks are NULL, values that no longer
    fit a recorded type fail the load instead of changing the column."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in evolved_schema(old, df.schema).fields
        ]
    )
