"""The star schema as one object: where the tables come from, and folder scoping."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.plans import dims, facts
from ledgerspark.schemas import DIM_LEDGER_GROUP, MONTH
from ledgerspark.values import FOLDERS, INTERNAL_LEDGER_CODES

Day = date | str | Column | None


def checked_folder(folder: str | None, known: Iterable[str] = FOLDERS) -> str | None:
    """Upper-cased folder; None or empty means all folders, an unknown one is an error."""
    if not folder:
        return None
    wanted = folder.upper()
    if wanted not in known:
        raise ValueError(f"unknown source folder {folder!r}; expected one of {sorted(known)}")
    return wanted


def as_day(day: Day) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def between(table: DataFrame, day: str, start: Day, end: Day) -> DataFrame:
    """Rows with ``day`` inside the bounds, both inclusive and optional.

    Stored facts are partitioned by month, so the same bounds also prune partitions.
    """
    by_month = MONTH in table.columns
    if start is not None:
        table = table.filter(F.col(day) >= as_day(start))
        table = table.filter(F.col(MONTH) >= F.trunc(as_day(start), "MM")) if by_month else table
    if end is not None:
        table = table.filter(F.col(day) <= as_day(end))
        table = table.filter(F.col(MONTH) <= F.trunc(as_day(end), "MM")) if by_month else table
    return table


class Warehouse:
    """Lazy star-schema tables. Nothing runs until a result is read or written."""

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame], folders: Iterable[str] = FOLDERS):
        self.spark = spark
        self.folders = tuple(folders)
        self._load = cache(load)

    @classmethod
    def from_raw(
        cls,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        folders: Iterable[str] = FOLDERS,
        internal_codes: Iterable[str] = INTERNAL_LEDGER_CODES,
        match_type: bool = False,
        heavy: DataFrame | None = None,
        placed: bool = False,
        whole: bool = False,
    ) -> Warehouse:
        """Tables derived from raw ones; ``raw`` maps a raw table name to its DataFrame.
        ``heavy``: invoice numbers whose lines are to be dealt into shares. ``placed``: the
        lines come from a join by their number; ``whole``: sales are read with all columns
        (see :func:`facts.fact_sales`)."""
        codes = tuple(internal_codes)

        def build(name: str) -> DataFrame:
            match name:
                case "dim_date":
                    return dims.dim_date(spark)
                case "dim_customer":
                    return dims.dim_customer(raw("MASTER"), codes)
                case "dim_product":
                    return dims.dim_product(raw("ITEM"))
                case "dim_ledger_group":
                    return spark.createDataFrame([], DIM_LEDGER_GROUP)
                case "fact_sales":
                    return facts.fact_sales(raw("SALES2"), raw("SALES1"), wh.dim_customer, wh.dim_product, match_type, heavy, placed, whole)
                case "fact_sales_header":
                    return facts.fact_sales_header(raw("SALES1"), wh.dim_customer)
                case "fact_finance":
                    return facts.fact_finance(raw("TRANS"), wh.dim_customer)
                case "fact_receivables":
                    return facts.fact_receivables(raw("BILLADJ"), wh.dim_customer)
            raise KeyError(name)

        wh = cls(spark, build, folders)
        return wh

    def scoped(self, folder: str | None) -> Warehouse:
        """The same warehouse cut to one folder, so that scans prune to its partition."""
        wanted = checked_folder(folder, self.folders)
        if wanted is None:
            return self

        def cut(name: str) -> DataFrame:
            table = self._load(name)
            return table if name == "dim_date" else table.filter(F.col("source_folder") == wanted)

        return Warehouse(self.spark, cut, self.folders)

    def table(self, name: str, day: str | None = None, start: Day = None, end: Day = None) -> DataFrame:
        """A table by name, optionally cut to days."""
        found = self._load(name)
        return (between(found, day, start, end) if day else found).drop(MONTH)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.table("dim_date")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.table("dim_customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.table("dim_product")

    @cached_property
    def dim_ledger_group(self) -> DataFrame:
        return self.table("dim_ledger_group")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self.table("fact_sales")

    @cached_property
    def fact_sales_header(self) -> DataFrame:
        return self.table("fact_sales_header")

    @cached_property
    def fact_finance(self) -> DataFrame:
        return self.table("fact_finance")

    @cached_property
    def fact_receivables(self) -> DataFrame:
        return self.table("fact_receivables")

    @cached_property
    def internal_keys(self) -> DataFrame:
        """Keys of internal accounts: at most one per configured code and folder."""
        internal = self.dim_customer.filter("is_internal_account")
        return internal.select("source_folder", "customer_key")

    def external_sales(self, start: Day = None, end: Day = None) -> DataFrame:
        """Sales lines of known customers that are not internal accounts.

        A fact's customer key is NULL unless the dimension has the customer, so no join
        to the dimension is needed to drop orphans; only the internal keys are looked
        up. Their number is bounded by codes x folders, whatever the size of the data,
        which is why broadcasting them is safe and the lines are not shuffled.
        """
        known = self.table("fact_sales", "invoice_date", start, end).filter(F.col("customer_key").isNotNull())
        return known.join(F.broadcast(self.internal_keys), ["source_folder", "customer_key"], "left_anti")
