"""Flags, keys and calendar labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from ledgerspark.values import INTERNAL_LEDGER_CODES, SERVICE_YES


def natural_key(folder: Column | str, code: Column | str) -> Column:
    """Stable key ``folder|code``; NULL when either part is NULL."""
    return F.concat(folder, F.lit("|"), code)


def is_service(text: Column) -> Column:
    return F.coalesce(F.upper(text).isin(*SERVICE_YES), F.lit(False))


def is_internal(code: Column, codes: Iterable[str] = INTERNAL_LEDGER_CODES) -> Column:
    return F.coalesce(code.isin(*codes), F.lit(False))


def over_limit(balance: Column, limit: Column) -> Column:
    """True only with a positive limit that the balance exceeds."""
    return F.coalesce((limit > 0) & (balance > limit), F.lit(False))


def financial_year(day: Column) -> Column:
    """April-to-March label such as ``FY2025-26``."""
    start = F.year(F.add_months(day, -3))
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def padded_name(day: Column, pattern: str) -> Column:
    """Month or weekday name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def rounded_int(number: Column) -> Column:
    """Nearest integer, halves away from zero (a plain cast would truncate)."""
    return F.round(number, 0).cast("int")


def exact_average(total: Column, count: Column) -> Column:
    """``total / count`` to two decimals, halves away from zero; NULL for a zero count.

    The quotient is cut to whole cents after half a cent is added: decimal division would
    round twice, once to the scale Spark picks and once to two places.
    """
    doubled = (2 * F.nullif(count, F.lit(0))).cast("decimal(20,0)")
    magnitude = F.call_function("div", 200 * F.abs(total) + count, doubled).cast("decimal(20,0)")
    return (F.when(total < 0, -magnitude).otherwise(magnitude) / 100).cast("decimal(22,2)")
