"""The ten report views. Each shrinks the facts by key first and joins names afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.flags import exact_average, over_limit
from ledgerspark.plans.warehouse import Day, Warehouse, as_day
from ledgerspark.values import SLOW_MOVING_DAYS

CUSTOMER_KEY = ["source_folder", "customer_key"]
PRODUCT_KEY = ["source_folder", "product_key"]


def _as_of(day: Day) -> Column:
    return F.current_date() if day is None else as_day(day)


def ranked(amount: str, *ties: str) -> list[Column]:
    """Largest first with NULLs on top, ties by natural key."""
    return [F.col(amount).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties]]


def sales_summary(wh: Warehouse, start: Day = None, end: Day = None) -> DataFrame:
    """Invoices, amount and quantity per folder and day, external customers."""
    dated = wh.external_sales(start, end).filter(F.col("invoice_date").isNotNull())
    return dated.groupBy("source_folder", "invoice_date").agg(
        F.countDistinct("invoice_no").alias("invoice_count"),
        F.sum("line_amount").alias("total_sales"),
        F.sum("quantity").alias("total_qty"),
    )


def today_sales(wh: Warehouse, as_of: Day = None) -> DataFrame:
    """Invoices and amount per folder on one day, external customers."""
    today = wh.external_sales(_as_of(as_of), _as_of(as_of))
    return today.groupBy("source_folder").agg(
        F.countDistinct("invoice_no").alias("invoice_count"), F.sum("line_amount").alias("total_sales")
    )


def monthly_sales(wh: Warehouse) -> DataFrame:
    """Invoices and amount per folder and month, all customers."""
    dated = wh.fact_sales.filter(F.col("invoice_date").isNotNull())
    return dated.groupBy("source_folder", F.trunc("invoice_date", "MM").alias("month")).agg(
        F.countDistinct("invoice_no").alias("invoice_count"), F.sum("line_amount").alias("total_sales")
    )


def sales_by_customer(wh: Warehouse) -> DataFrame:
    """Purchases per external customer key, without any customer attribute."""
    return wh.external_sales().groupBy(*CUSTOMER_KEY).agg(
        F.countDistinct("invoice_no").alias("invoice_count"),
        F.sum("line_amount").alias("total_purchases"),
        F.min("invoice_date").alias("first_purchase_date"),
        F.max("invoice_date").alias("last_purchase_date"),
    )


def customer_ranking(wh: Warehouse, totals: DataFrame) -> DataFrame:
    """Names and balances for per-customer totals."""
    return wh.dim_customer.join(totals, CUSTOMER_KEY).select(
        "source_folder",
        "ledger_code",
        "customer_name",
        "invoice_count",
        "total_purchases",
        F.col("current_balance").alias("outstanding_balance"),
        "last_purchase_date",
    )


def top_customers(wh: Warehouse) -> DataFrame:
    """All external customers with purchases, largest total first."""
    return customer_ranking(wh, sales_by_customer(wh)).orderBy(
        *ranked("total_purchases", "source_folder", "ledger_code")
    )


def sales_by_product(wh: Warehouse) -> DataFrame:
    """Quantity, revenue and invoices per product key, without any product attribute."""
    known = wh.fact_sales.filter(F.col("product_key").isNotNull())
    return known.groupBy(*PRODUCT_KEY).agg(
        F.sum("quantity").alias("total_qty_sold"),
        F.sum("line_amount").alias("total_revenue"),
        F.countDistinct("invoice_no").alias("times_ordered"),
    )


def product_ranking(wh: Warehouse, totals: DataFrame) -> DataFrame:
    """Descriptions and groups for per-product totals."""
    return wh.dim_product.join(totals, PRODUCT_KEY).select(
        "source_folder",
        "item_code",
        "item_description",
        "item_group",
        "total_qty_sold",
        "total_revenue",
        "times_ordered",
    )


def top_products(wh: Warehouse) -> DataFrame:
    """All sold products, largest revenue first; internal accounts' purchases count."""
    return product_ranking(wh, sales_by_product(wh)).orderBy(*ranked("total_revenue", "source_folder", "item_code"))


def slow_moving(wh: Warehouse, as_of: Day = None, days: int = SLOW_MOVING_DAYS) -> DataFrame:
    """Products never sold, or last sold more than ``days`` before ``as_of``."""
    known = wh.fact_sales.filter(F.col("product_key").isNotNull())
    last = known.groupBy(*PRODUCT_KEY).agg(F.max("invoice_date").alias("last_sold_date"))
    stale = F.col("last_sold_date").isNull() | (F.col("last_sold_date") < F.date_sub(_as_of(as_of), days))
    return (
        wh.dim_product.join(last, PRODUCT_KEY, "left")
        .filter(stale)
        .select(
            "source_folder",
            "item_code",
            "item_description",
            "opening_qty",
            "last_sold_date",
            F.datediff(_as_of(as_of), "last_sold_date").alias("days_since_last_sale"),
        )
        .orderBy(*slowest_first())
    )


def slowest_first() -> list[Column]:
    return [F.col("last_sold_date").asc_nulls_first(), F.col("source_folder"), F.col("item_code")]


def outstanding_receivables(wh: Warehouse) -> DataFrame:
    """External accounts with a positive balance, largest first."""
    owing = wh.dim_customer.filter((F.col("current_balance") > 0) & ~F.col("is_internal_account"))
    return owing.select(
        "source_folder",
        "ledger_code",
        "customer_name",
        F.col("current_balance").alias("outstanding_amount"),
        "credit_limit",
        over_limit(F.col("current_balance"), F.col("credit_limit")).alias("over_credit_limit"),
    ).orderBy(*ranked("outstanding_amount", "source_folder", "ledger_code"))


def cash_flow(wh: Warehouse, start: Day = None, end: Day = None) -> DataFrame:
    """Debits, credits and net movement per folder and day.

    Net movement counts every flag but D as credit, a missing flag too.
    """
    flag, amount = F.col("debit_credit"), F.col("amount")
    return (
        wh.table("fact_finance", "voucher_date", start, end)
        .filter(F.col("voucher_date").isNotNull())
        .groupBy("source_folder", "voucher_date")
        .agg(
            F.sum(F.when(flag == "D", amount).otherwise(0)).alias("total_debit"),
            F.sum(F.when(flag == "C", amount).otherwise(0)).alias("total_credit"),
            F.sum(F.when(flag == "D", amount).otherwise(-amount)).alias("net_movement"),
        )
    )


def ltv_ranking(wh: Warehouse, totals: DataFrame) -> DataFrame:
    return wh.dim_customer.join(totals, CUSTOMER_KEY).select(
        "source_folder",
        "ledger_code",
        "customer_name",
        F.col("first_purchase_date").alias("first_purchase"),
        F.col("last_purchase_date").alias("last_purchase"),
        F.col("invoice_count").alias("total_orders"),
        F.col("total_purchases").alias("lifetime_value"),
        exact_average(F.col("total_purchases"), F.col("invoice_count")).alias("avg_order_value"),
    )


def customer_ltv(wh: Warehouse) -> DataFrame:
    """First and last purchase, orders, total and average order per external customer."""
    return ltv_ranking(wh, sales_by_customer(wh))


def company_overview(wh: Warehouse) -> DataFrame:
    """One row per folder with external sales.

    The lines are first reduced to (customer, invoice) pairs, so the two distinct
    counts expand those pairs and not the lines.
    """
    pairs = wh.external_sales().groupBy(*CUSTOMER_KEY, "invoice_no").agg(F.sum("line_amount").alias("amount"))
    sales = pairs.groupBy("source_folder").agg(
        F.countDistinct("invoice_no").alias("total_invoices"),
        F.sum("amount").alias("total_revenue"),
        F.countDistinct("customer_key").alias("active_customers"),
    )
    owing = wh.dim_customer.filter((F.col("current_balance") > 0) & ~F.col("is_internal_account"))
    receivables = owing.groupBy("source_folder").agg(F.sum("current_balance").alias("total_receivables"))
    return sales.join(receivables, "source_folder", "left")
