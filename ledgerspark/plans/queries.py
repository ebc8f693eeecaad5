"""Parameterized report queries.

``folder`` None or empty means all folders. A limit outside its allowed range is a
``ValueError``. Rankings pick the best keys before any name is joined; the picked rows
number at most the largest allowed limit, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.plans import views
from ledgerspark.plans.views import ranked
from ledgerspark.plans.warehouse import Day, Warehouse
from ledgerspark.values import LIMITS, SLOW_MOVING_DAYS


def checked_limit(query: str, limit: int | None) -> int:
    default, low, high = LIMITS[query]
    wanted = default if limit is None else limit
    if not low <= wanted <= high:
        raise ValueError(f"limit of {query} must be between {low} and {high}, not {wanted}")
    return wanted


def overview(wh: Warehouse, folder: str | None = None) -> DataFrame:
    return views.company_overview(wh.scoped(folder))


def today_sales(wh: Warehouse, folder: str | None = None, as_of: Day = None) -> DataFrame:
    return views.today_sales(wh.scoped(folder), as_of)


def monthly_sales(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    """Newest months first; the limit counts (folder, month) rows, not months."""
    rows = checked_limit("monthly_sales", limit)
    newest = [F.col("month").desc_nulls_first(), F.col("source_folder")]
    return views.monthly_sales(wh.scoped(folder)).orderBy(*newest).limit(rows)


def sales_summary(
    wh: Warehouse, folder: str | None = None, start: Day = None, end: Day = None
) -> DataFrame:
    daily = views.sales_summary(wh.scoped(folder), start, end)
    return daily.orderBy(F.col("invoice_date").desc_nulls_first(), "source_folder")


def top_customers(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    rows, scope = checked_limit("top_customers", limit), wh.scoped(folder)
    best = views.sales_by_customer(scope).orderBy(*ranked("total_purchases", *views.CUSTOMER_KEY)).limit(rows)
    named = views.customer_ranking(scope, F.broadcast(best))
    return named.orderBy(*ranked("total_purchases", "source_folder", "ledger_code")).limit(rows)


def receivables(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    return views.outstanding_receivables(wh.scoped(folder)).limit(checked_limit("receivables", limit))


def customer_ltv(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    rows, scope = checked_limit("customer_ltv", limit), wh.scoped(folder)
    best = views.sales_by_customer(scope).orderBy(*ranked("total_purchases", *views.CUSTOMER_KEY)).limit(rows)
    named = views.ltv_ranking(scope, F.broadcast(best))
    return named.orderBy(*ranked("lifetime_value", "source_folder", "ledger_code")).limit(rows)


def customer_detail(wh: Warehouse, ledger_code: str, folder: str | None = None) -> DataFrame:
    """Profile rows of a ledger code; an unknown code gives no rows."""
    return wh.scoped(folder).dim_customer.filter(F.col("ledger_code") == ledger_code)


def top_products(wh: Warehouse, folder: str | None = None, limit: int | None = None) -> DataFrame:
    rows, scope = checked_limit("top_products", limit), wh.scoped(folder)
    best = views.sales_by_product(scope).orderBy(*ranked("total_revenue", *views.PRODUCT_KEY)).limit(rows)
    named = views.product_ranking(scope, F.broadcast(best))
    return named.orderBy(*ranked("total_revenue", "source_folder", "item_code")).limit(rows)


def slow_moving(
    wh: Warehouse,
    folder: str | None = None,
    limit: int | None = None,
    as_of: Day = None,
    days: int = SLOW_MOVING_DAYS,
) -> DataFrame:
    return views.slow_moving(wh.scoped(folder), as_of, days).limit(checked_limit("slow_moving", limit))


def product_detail(wh: Warehouse, item_code: str, folder: str | None = None) -> DataFrame:
    """Profile rows of an item code; an unknown code gives no rows."""
    return wh.scoped(folder).dim_product.filter(F.col("item_code") == item_code)


def cash_flow(
    wh: Warehouse, folder: str | None = None, start: Day = None, end: Day = None
) -> DataFrame:
    daily = views.cash_flow(wh.scoped(folder), start, end)
    return daily.orderBy(F.col("voucher_date").desc_nulls_first(), "source_folder")


def transactions(
    wh: Warehouse, folder: str | None = None, ledger_code: str | None = None, limit: int | None = None
) -> DataFrame:
    """Newest vouchers with their ledger's name.

    A ledger filter compares the voucher's own key, which is set only for known ledgers,
    with constants of the warehouse's folders, so it reaches the scan.
    """
    rows, scope = checked_limit("transactions", limit), wh.scoped(folder)
    vouchers = scope.fact_finance
    if ledger_code:
        vouchers = vouchers.filter(F.col("ledger_key").isin([f"{f}|{ledger_code}" for f in scope.folders]))
    ties = [c for c in vouchers.columns if c != "voucher_date"]
    newest = [F.col("voucher_date").desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in ties]]
    latest = vouchers.orderBy(*newest).limit(rows)
    # A voucher's key is NULL exactly if the dimension lacks its ledger, so with a NULL key for
    # each folder every voucher finds its one name. The few vouchers are what is broadcast, and
    # they are ranked once; neither the dimension nor the fact is shuffled.
    names = scope.dim_customer.select("source_folder", F.col("customer_key").alias("ledger_key"), "customer_name")
    folders = wh.spark.createDataFrame([(f, None, None) for f in scope.folders], names.schema)
    picked = F.broadcast(latest.withColumnsRenamed({"source_folder": "_folder", "ledger_key": "_key"}))
    same = (F.col("source_folder") == F.col("_folder")) & F.col("ledger_key").eqNullSafe(F.col("_key"))
    named = names.union(folders).join(picked, same).select(*vouchers.columns, "customer_name")
    return named.orderBy(*newest).limit(rows)


def inventory_items(
    wh: Warehouse, folder: str | None = None, item_group: str | None = None, limit: int | None = None
) -> DataFrame:
    rows, items = checked_limit("inventory_items", limit), wh.scoped(folder).dim_product
    if item_group:
        items = items.filter(F.col("item_group") == item_group)
    order = [F.col(c).asc_nulls_last() for c in ("item_description", "source_folder", "item_code")]
    return items.orderBy(*order).limit(rows)


def invoice_header(wh: Warehouse, invoice_no: str, folder: str | None = None) -> DataFrame:
    """Every header of the number, over folders and types."""
    found = wh.scoped(folder).fact_sales_header.filter(F.col("invoice_no") == invoice_no)
    return found.orderBy("source_folder", F.col("invoice_type").asc_nulls_last(), "invoice_date")


def invoice_lines(wh: Warehouse, invoice_no: str, folder: str | None = None) -> DataFrame:
    scope = wh.scoped(folder)
    lines = scope.fact_sales.filter(F.col("invoice_no") == invoice_no)
    names = scope.dim_product.select("source_folder", "product_key", "item_description")
    return lines.join(names, ["source_folder", "product_key"], "left")
