"""Roll-ups of query results for cards and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions.labels import name_or_code, short_label
from ledgerspark.plans import queries, views
from ledgerspark.plans.warehouse import Day, Warehouse
from ledgerspark.values import PRODUCT_BARS

_KPIS = (
    "total_revenue",
    "total_invoices",
    "total_customers",
    "total_receivables",
    "today_sales_total",
    "today_invoice_count",
)


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def kpi_totals(wh: Warehouse, folder: str | None = None, as_of: Day = None) -> DataFrame:
    """One row of totals over the folders; customers are added per folder, not distinct.

    Both inputs have one row per folder; stacking them lets one aggregate do it.
    """
    overall = queries.overview(wh, folder).select(
        _zero("total_revenue").alias("total_revenue"),
        "total_invoices",
        F.col("active_customers").alias("total_customers"),
        _zero("total_receivables").alias("total_receivables"),
    )
    today = queries.today_sales(wh, folder, as_of).select(
        _zero("total_sales").alias("today_sales_total"), F.col("invoice_count").alias("today_invoice_count")
    )
    both = overall.unionByName(today, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _KPIS])


def monthly_trend(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    """The latest months, oldest first."""
    latest = queries.monthly_sales(wh, folder, limit)
    return latest.select(
        "source_folder", "month", "invoice_count", _zero("total_sales").alias("total_sales")
    ).orderBy("month", F.col("source_folder").desc())


def cash_flow_series(wh: Warehouse, folder: str | None = None, points: int | None = None) -> DataFrame:
    """The latest (folder, day) points, oldest first."""
    daily = views.cash_flow(wh.scoped(folder))
    latest = daily.orderBy(F.col("voucher_date").desc_nulls_first(), "source_folder").limit(queries.checked_limit("cash_flow_series", points))
    return latest.select(
        "source_folder", "voucher_date", _zero("total_debit").alias("debit"), _zero("total_credit").alias("credit")
    ).orderBy("voucher_date", F.col("source_folder").desc())


def top_products_series(wh: Warehouse, folder: str | None = None, bars: int = PRODUCT_BARS) -> DataFrame:
    """Short label and revenue of the best products."""
    best = queries.top_products(wh, folder, bars)
    label = short_label(name_or_code(F.col("item_description"), F.col("item_code")))
    return best.select(
        "source_folder", "item_code", label.alias("label"), _zero("total_revenue").alias("revenue")
    )
