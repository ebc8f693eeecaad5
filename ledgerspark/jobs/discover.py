"""Write the data dictionary of a set of folders as JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.plans.profile import find_relationships, sample_files
from ledgerspark.sources.files import file_catalog, list_sources


def dictionary_json(catalog: DataFrame) -> DataFrame:
    """The dictionary as JSON texts: ``section`` is ``report`` (time and totals, one row),
    ``table`` or ``relationship``."""
    totals = catalog.agg(F.count("*").alias("total_tables"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"))
    report = totals.select(
        F.lit("report").alias("section"),
        F.lit("totals").alias("name"),
        F.to_json(F.struct(F.current_timestamp().alias("generated_at"), "total_tables", "total_records")).alias("body"),
    )
    tables = catalog.select(
        F.lit("table").alias("section"),
        F.concat_ws("/", "source_folder", "table_name").alias("name"),
        F.to_json(F.struct("source_folder", "table_name", "full_path", "record_count", "fields")).alias("body"),
    )
    shared = find_relationships(catalog).select(
        F.lit("relationship").alias("section"),
        F.col("field_name").alias("name"),
        F.to_json(F.struct("field_name", F.split("tables", ", ").alias("tables"))).alias("body"),
    )
    return report.unionByName(tables).unionByName(shared)


def discover(spark: SparkSession, folders: Mapping[str, str], target: str) -> DataFrame:
    """Describe every xBase file of the folders, none skipped, and write the JSON report with
    the first rows of each file (``section`` ``sample``)."""
    listed = list_sources(spark, folders, skip=())
    catalog = file_catalog(listed)
    samples = sample_files(spark, listed).select(
        F.lit("sample").alias("section"),
        F.concat_ws("/", "source_folder", "table_name").alias("name"),
        F.to_json(F.struct("row_no", "values")).alias("body"),
    )
    dictionary_json(catalog).unionByName(samples).write.mode("overwrite").json(target)
    return catalog
