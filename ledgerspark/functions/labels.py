"""Texts a report shows in place of codes, flags and NULLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerspark.values import PRODUCT_LABEL_CHARS

DASH = "—"


def _filled(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def name_or_code(name: Column, code: Column) -> Column:
    return F.coalesce(_filled(name), code)


def or_dash(text: Column) -> Column:
    return F.coalesce(_filled(text), F.lit(DASH))


def limit_status(over: Column) -> Column:
    return F.when(over, "Over Limit").otherwise("OK")


def idle_label(days: Column) -> Column:
    return F.coalesce(F.concat(days.cast("string"), F.lit("d")), F.lit("Never sold"))


def movement_label(flag: Column) -> Column:
    return F.when(flag == "D", "Debit").when(flag == "C", "Credit").otherwise(DASH)


def kind_label(is_service: Column) -> Column:
    return F.when(is_service, "Service").otherwise("Goods")


def short_label(text: Column, chars: int = PRODUCT_LABEL_CHARS) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("…"))).otherwise(text)
