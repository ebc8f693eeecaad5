"""Spark settings the library is written for; pass them to your own session builder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Every hot invoice, customer or item is split at run time by the skew-join settings,
# so adaptive execution has to stay on. Broadcasts are left to measured table sizes.
# HotSpot does not compile methods above 8000 bytes of byte code; decoding a wide xBase
# table is several times faster when such a method is split instead.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which need it to read xBase files, unless it is
    installed there anyway."""
    package = Path(__file__).resolve().parent
    archive = f"{tempfile.mkdtemp()}/{package.name}"  # the driver serves it as long as it runs
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))


def local_session(cores: str | int = 8, app: str = "ledgerspark") -> SparkSession:
    """Session for tests and the benchmark: one machine, few shuffle partitions."""
    spark = (
        recommended(SparkSession.builder.master(f"local[{cores}]").appName(app))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
