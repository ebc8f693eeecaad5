"""Fixed column types of the warehouse and load-state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Narrowest types of amounts and quantities; a raw table with more digits keeps them.
MONEY = T.DecimalType(18, 2)
QUANTITY = T.DecimalType(18, 3)

# Partition column of stored facts: first day of the month of the fact's date.
MONTH = "_month"
_TEXT, _DATE, _BOOL, _INT, _LONG = (
    T.StringType(),
    T.DateType(),
    T.BooleanType(),
    T.IntegerType(),
    T.LongType(),
)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


DIM_DATE = _schema(
    ("date_key", _DATE),
    ("year", _INT),
    ("quarter", _INT),
    ("month", _INT),
    ("month_name", _TEXT),
    ("day", _INT),
    ("day_name", _TEXT),
    ("week_of_year", _INT),
    ("is_weekend", _BOOL),
    ("financial_year", _TEXT),
)

DIM_CUSTOMER = _schema(
    ("customer_key", _TEXT),
    ("source_folder", _TEXT),
    ("ledger_code", _TEXT),
    ("customer_name", _TEXT),
    ("account_group", _TEXT),
    ("state", _TEXT),
    ("place", _TEXT),
    ("mobile", _TEXT),
    ("opening_balance", MONEY),
    ("current_balance", MONEY),
    ("credit_limit", MONEY),
    ("gst_number", _TEXT),
    ("is_active", _BOOL),
    ("is_internal_account", _BOOL),
)

DIM_PRODUCT = _schema(
    ("product_key", _TEXT),
    ("source_folder", _TEXT),
    ("item_code", _TEXT),
    ("item_description", _TEXT),
    ("item_group", _TEXT),
    ("uom", _TEXT),
    ("hsn_code", _TEXT),
    ("valuation_method", _TEXT),
    ("standard_rate", MONEY),
    ("opening_qty", QUANTITY),
    ("opening_value", MONEY),
    ("is_service", _BOOL),
)

DIM_LEDGER_GROUP = _schema(
    ("group_key", _TEXT),
    ("source_folder", _TEXT),
    ("group_code", _TEXT),
    ("group_name", _TEXT),
    ("main_group_code", _TEXT),
)

FACT_SALES = _schema(
    ("source_folder", _TEXT),
    ("invoice_no", _TEXT),
    ("invoice_date", _DATE),
    ("invoice_type", _TEXT),
    ("customer_key", _TEXT),
    ("product_key", _TEXT),
    ("rep_code", _TEXT),
    ("quantity", QUANTITY),
    ("rate", MONEY),
    ("discount_pct", MONEY),
    ("discount_amt", MONEY),
    ("line_amount", MONEY),
    ("batch_no", _TEXT),
)

FACT_SALES_HEADER = _schema(
    ("source_folder", _TEXT),
    ("invoice_no", _TEXT),
    ("invoice_date", _DATE),
    ("invoice_type", _TEXT),
    ("customer_key", _TEXT),
    ("bill_amount", MONEY),
    ("tax_amount", MONEY),
    ("round_off", MONEY),
    ("total_amount", MONEY),
    ("transport", _TEXT),
    ("due_days", _INT),
)

FACT_FINANCE = _schema(
    ("source_folder", _TEXT),
    ("voucher_no", _TEXT),
    ("voucher_date", _DATE),
    ("ledger_key", _TEXT),
    ("narration", _TEXT),
    ("debit_credit", _TEXT),
    ("amount", MONEY),
    ("rep_code", _TEXT),
)

FACT_RECEIVABLES = _schema(
    ("source_folder", _TEXT),
    ("voucher_no", _TEXT),
    ("voucher_date", _DATE),
    ("customer_key", _TEXT),
    ("voucher_amount", MONEY),
    ("bill_adjusted", MONEY),
    ("bill_amount", MONEY),
    ("ref_invoice_no", _TEXT),
)

SYNC_LOG = _schema(
    ("log_id", _TEXT),
    ("source_folder", _TEXT),
    ("table_name", _TEXT),
    ("started_at", T.TimestampType()),
    ("ended_at", T.TimestampType()),
    ("rows_written", _LONG),
    ("status", _TEXT),
    ("error_msg", _TEXT),
    ("file_hash", _TEXT),
    ("duplicates_skipped", _LONG),
)

FILE_STATE = _schema(
    ("source_folder", _TEXT),
    ("table_name", _TEXT),
    ("file_path", _TEXT),
    ("file_hash", _TEXT),
    ("last_synced", T.TimestampType()),
    ("row_count", _LONG),
    ("data_path", _TEXT),
)

# Partitions of each version: the version that wrote them, their rows, a digest of the rows,
# and of a dimension's keys. ``month`` is NULL for dimensions and undated rows.
WAREHOUSE_PARTS = _schema(
    ("version", _TEXT),
    ("table_name", _TEXT),
    ("source_folder", _TEXT),
    ("month", _DATE),
    ("written_by", _TEXT),
    ("rows", _LONG),
    ("digest", _TEXT),
    ("keys", _TEXT),
)

# What each folder's part of a table was built from.
WAREHOUSE_INPUTS = _schema(
    ("version", _TEXT),
    ("table_name", _TEXT),
    ("source_folder", _TEXT),
    ("signature", _TEXT),
)

WAREHOUSE_TABLES = {
    "dim_date": DIM_DATE,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_ledger_group": DIM_LEDGER_GROUP,
    "fact_sales": FACT_SALES,
    "fact_sales_header": FACT_SALES_HEADER,
    "fact_finance": FACT_FINANCE,
    "fact_receivables": FACT_RECEIVABLES,
}


# Day column whose month partitions a stored fact.
FACT_DAYS = {
    "fact_sales": "invoice_date",
    "fact_sales_header": "invoice_date",
    "fact_finance": "voucher_date",
    "fact_receivables": "voucher_date",
}


def conform(df: DataFrame, schema: T.StructType, columns: dict[str, Column | str] | None = None) -> DataFrame:
    """Project ``df`` to ``schema``; ``columns`` says where renamed ones come from.

    A column that neither mapping nor input provides becomes NULL, since raw tables
    carry only the fields their file header declares. The decimal types of ``schema`` are
    the narrowest: a source with more digits on either side of the point keeps them.
    """
    columns = columns or {}
    present = set(df.columns)
    sources = []
    for field in schema.fields:
        source = columns.get(field.name, field.name)
        if isinstance(source, str):
            source = F.col(source) if source in present else F.lit(None)
        sources.append(source.alias(field.name))
    found = df.select(*sources)
    return found.select(*[F.col(f.name).cast(_lossless(f.dataType, found.schema[f.name].dataType)).alias(f.name) for f in schema.fields])


def _lossless(wanted: T.DataType, given: T.DataType) -> T.DataType:
    if not (isinstance(wanted, T.DecimalType) and isinstance(given, T.DecimalType)):
        return wanted
    scale = max(wanted.scale, given.scale)
    whole = max(wanted.precision - wanted.scale, given.precision - given.scale)
    return T.DecimalType(min(38, whole + scale), scale)
