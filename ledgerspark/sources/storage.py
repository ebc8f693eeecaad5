"""Directories of the lake, on whatever file system Spark reads."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Setting by which Spark removes the shuffle files of a job when the job ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Signs that partition directories write as %XX, besides control characters.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, sorted; none if it does not exist."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place))


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a directory; 0 if it does not exist."""
    system, place = _opened(spark, path)
    return system.getContentSummary(place).getLength() if system.exists(place) else 0


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs of plans made within remove their shuffle files when they end, and not when the
    driver happens to collect its garbage. For jobs that run once: another run shuffles anew."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)


def partition_name(column: str, value: object) -> str:
    """Directory of a partition value, as Spark writes it."""
    if value is None or value == "":
        return f"{column}={NULL_PARTITION}"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in str(value))
