"""Hand-made raw tables for the semantics tests."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.plans.warehouse import Warehouse

SCHEMAS = {
    "MASTER": "_source_folder string, _seq bigint, codecbg string, desccbg string, groupcdbg string, balancebg decimal(18,2), crelimitbg decimal(18,2)",
    "ITEM": "_source_folder string, _seq bigint, itemcode string, desc string, itemgroup string, opbalqty decimal(18,3), is_service string",
    "SALES1": "_source_folder string, _seq bigint, invnoebg decimal(18,0), invdatebg date, invtypebg string, cuscodebg string, totaliong decimal(18,2), duedaysg decimal(10,1)",
    "SALES2": "_source_folder string, invno decimal(18,0), invtype string, cuscode string, itemcode string, qty decimal(18,3), amount decimal(18,2)",
    "TRANS": "_source_folder string, vounoe decimal(18,0), voudate date, codee string, drcrate string, vou_amt decimal(18,2)",
    "BILLADJ": "_source_folder string, vouno decimal(18,0), voudate date, cuscode string, vou_amt decimal(18,2)",
}


def money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def day(text: str | None) -> date | None:
    return None if text is None else date.fromisoformat(text)


def ledger(spark: SparkSession, **rows: list[tuple]) -> Warehouse:
    """Warehouse over the given raw rows; tables not given are empty."""

    def raw(name: str) -> DataFrame:
        return spark.createDataFrame(rows.get(name, []), SCHEMAS[name])

    return Warehouse.from_raw(spark, raw)


def listed(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
