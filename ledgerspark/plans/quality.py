"""Verification queries over raw tables, warehouse and load records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ledgerspark.operators.changes import union_folders
from ledgerspark.operators.lineage import business_columns
from ledgerspark.plans.facts import header_load
from ledgerspark.plans.queries import checked_limit
from ledgerspark.plans.warehouse import Warehouse


def revenue_reconciles(raw_lines: DataFrame, wh: Warehouse) -> DataFrame:
    """Line amounts in the raw table and in the fact, per folder.

    Left joins drop nothing, so a difference is the amount of lines repeated because
    their number has several headers.
    """
    raw = raw_lines.groupBy(F.col("_source_folder").alias("source_folder")).agg(
        F.count("*").alias("raw_lines"), F.sum("amount").alias("raw_amount")
    )
    fact = wh.fact_sales.groupBy("source_folder").agg(
        F.count("*").alias("fact_lines"), F.sum("line_amount").alias("fact_amount")
    )
    gap = F.coalesce("fact_amount", F.lit(0)) - F.coalesce("raw_amount", F.lit(0))
    return raw.join(fact, "source_folder", "full").withColumn("difference", gap)


def header_multiplicity(raw_lines: DataFrame, raw_headers: DataFrame, match_type: bool = False) -> DataFrame:
    """Invoice numbers whose lines are repeated because several headers have the number, with
    the lines, the headers and the rows that the sales fact gets from them."""
    load = header_load(raw_lines, raw_headers, match_type)
    names = {"_source_folder": "source_folder", "invno": "invoice_no"} | ({"invtype": "invoice_type"} if match_type else {})
    return load.withColumnsRenamed(names).withColumn("invoice_no", F.col("invoice_no").cast("string"))


def orphan_customers(wh: Warehouse) -> DataFrame:
    """Sales lines whose customer is not in the dimension."""
    return wh.fact_sales.filter(F.col("customer_key").isNull()).agg(F.count("*").alias("orphan_lines"))


def orphan_products(wh: Warehouse) -> DataFrame:
    """Sales lines whose product is not in the dimension."""
    return wh.fact_sales.filter(F.col("product_key").isNull()).agg(F.count("*").alias("orphan_lines"))


COUNTED = (
    "dim_date",
    "dim_customer",
    "dim_product",
    "fact_sales",
    "fact_sales_header",
    "fact_finance",
    "fact_receivables",
)


def row_counts(wh: Warehouse, tables: tuple[str, ...] = COUNTED) -> DataFrame:
    return union_folders(
        [getattr(wh, t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table_name"), "rows") for t in tables]
    )


def raw_load_counts(raw: DataFrame) -> DataFrame:
    """Rows and last load time per folder and table."""
    return raw.groupBy("_source_folder", "_source_table").agg(
        F.count("*").alias("row_count"), F.max("_synced_at").alias("last_sync")
    )


def sync_history(log: DataFrame, rows: int | None = None) -> DataFrame:
    """Latest load attempts. The log is append-only: an attempt's last entry counts."""
    order = F.struct(F.col("ended_at").isNotNull(), "ended_at")
    last = log.groupBy("log_id").agg(F.max_by(F.struct(*log.columns), order).alias("_row")).select("_row.*")
    newest = [F.col("started_at").desc_nulls_first(), F.col("source_folder"), F.col("table_name")]
    return last.orderBy(*newest).limit(checked_limit("sync_history", rows))


def file_freshness(state: DataFrame) -> DataFrame:
    """Recorded files, most recently loaded first."""
    return state.select("source_folder", "table_name", "last_synced", "row_count").orderBy(
        F.col("last_synced").desc_nulls_first(), "source_folder", "table_name"
    )


def latest_invoice_date(wh: Warehouse) -> DataFrame:
    return wh.fact_sales.agg(F.max("invoice_date").alias("latest_invoice_date"))


def all_null_check(raw: DataFrame) -> DataFrame:
    """Share of rows without a single business value, per folder and table."""
    empty = reduce(and_, (F.col(c).isNull() for c in business_columns(raw)))
    blanks = F.sum(F.when(empty, 1).otherwise(0))
    return raw.groupBy("_source_folder", "_source_table").agg(
        F.count("*").alias("rows"), blanks.alias("all_null_rows"), (blanks / F.count("*")).alias("all_null_share")
    )
