"""Dimension builders. Inputs are raw tables of all folders together."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.functions.flags import financial_year, is_internal, is_service, natural_key, padded_name
from ledgerspark.operators.dedup import keep_first
from ledgerspark.schemas import DIM_CUSTOMER, DIM_DATE, DIM_LEDGER_GROUP, DIM_PRODUCT, conform
from ledgerspark.values import CALENDAR_END, CALENDAR_START, INTERNAL_LEDGER_CODES


def dim_date(spark: SparkSession, start: date | str = CALENDAR_START, end: date | str = CALENDAR_END) -> DataFrame:
    span = spark.range(1).select(F.lit(str(start)).cast("date").alias("first"), F.lit(str(end)).cast("date").alias("last"))
    return calendar(span)


def calendar(span: DataFrame) -> DataFrame:
    """One row per day of a one-row frame ``(first, last)``."""
    days = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_key"))
    day = F.col("date_key")
    parts = {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": padded_name(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_name": padded_name(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": F.weekday(day) >= 5,
        "financial_year": financial_year(day),
    }
    return conform(days, DIM_DATE, parts)


def dim_customer(master: DataFrame, internal_codes: Iterable[str] = INTERNAL_LEDGER_CODES) -> DataFrame:
    """One row per (folder, ledger code), the first in source order."""
    first = keep_first(master.filter(F.col("codecbg").isNotNull()), ["_source_folder", "codecbg"], "_seq")
    return conform(
        first,
        DIM_CUSTOMER,
        {
            "customer_key": natural_key("_source_folder", "codecbg"),
            "source_folder": "_source_folder",
            "ledger_code": "codecbg",
            "customer_name": "desccbg",
            "account_group": "groupcdbg",
            "state": "statecode",
            "place": "place_cdbg",
            "mobile": "mobileno",
            "opening_balance": "opbalcbg",
            "current_balance": "balancebg",
            "credit_limit": "crelimitbg",
            "gst_number": "apgsttbg",
            "is_active": F.lit(True),
            "is_internal_account": is_internal(F.col("codecbg"), internal_codes),
        },
    )


def dim_product(item: DataFrame) -> DataFrame:
    """One row per (folder, item code), the first in source order."""
    first = keep_first(item.filter(F.col("itemcode").isNotNull()), ["_source_folder", "itemcode"], "_seq")
    return conform(
        first,
        DIM_PRODUCT,
        {
            "product_key": natural_key("_source_folder", "itemcode"),
            "source_folder": "_source_folder",
            "item_code": "itemcode",
            "item_description": "desc",
            "item_group": "itemgroup",
            "hsn_code": "hsncode",
            "valuation_method": "valuation",
            "standard_rate": "itemrate",
            "opening_qty": "opbalqty",
            "opening_value": "opbalval",
            "is_service": is_service(_optional(first, "is_service")),
        },
    )


def dim_ledger_group(groups: DataFrame, code: str, name: str, main_group: str) -> DataFrame:
    """One row per (folder, group code) of a group table whose field names the caller
    knows; rows without a code are all kept."""
    first = keep_first(groups, ["_source_folder", code], "_seq", distinct_nulls=True)
    return conform(
        first,
        DIM_LEDGER_GROUP,
        {
            "group_key": natural_key("_source_folder", code),
            "source_folder": "_source_folder",
            "group_code": code,
            "group_name": name,
            "main_group_code": main_group,
        },
    )


def rejects(raw: DataFrame, code: str) -> DataFrame:
    """Master rows that cannot enter a dimension because their code is NULL."""
    return raw.filter(F.col(code).isNull())


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
