"""Text to typed values by xBase type code; whatever does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerspark.functions.text import clean_text, strip
from ledgerspark.values import LOGICAL_FALSE, LOGICAL_TRUE


def spark_type(code: str, length: int = 18, decimals: int = 0) -> T.DataType:
    """Column type for an xBase type code; decimals keep the header's scale."""
    match code:
        case "B" if length == 8:
            return T.DoubleType()
        case "N" | "F" | "B":
            precision = min(38, max(18, length))
            return T.DecimalType(precision, min(decimals, precision))
        case "Y":
            return T.DecimalType(19, 4)
        case "I":
            return T.IntegerType()
        case "+":
            return T.LongType()
        case "D":
            return T.DateType()
        case "L":
            return T.BooleanType()
        case "T":
            return T.TimestampNTZType()
        case _:
            return T.StringType()


def coerce(text: Column, code: str, length: int = 18, decimals: int = 0) -> Column:
    is_text = isinstance(spark_type(code, length, decimals), T.StringType)
    return typed(clean_text(text) if is_text else F.nullif(strip(text), F.lit("")), code, length, decimals)


def typed(value: Column, code: str, length: int = 18, decimals: int = 0) -> Column:
    """Like :func:`coerce` for text that is already clean, stripped and NULL if empty."""
    match kind := spark_type(code, length, decimals):
        case T.StringType():
            return value
        case T.DateType():
            return F.when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd"))
        case T.BooleanType():
            letter = F.upper(value)
            return F.when(letter.isin(*LOGICAL_TRUE), True).when(letter.isin(*LOGICAL_FALSE), False)
        case T.DecimalType():  # a comma counts as the point; asterisks mark an overflow
            return F.translate(value, ",", ".").try_cast(kind)
        case _:
            return value.try_cast(kind)
