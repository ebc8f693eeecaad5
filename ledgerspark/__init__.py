"""Ledger analytics on Spark: load xBase tables, build a star schema, report on it."""

from ledgerspark.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
