"""Raw ledger tables derived from the given parquet tables.

Every input row is used. Edge cases are planted by recoding values or repeating rows,
never by leaving rows out; FIXTURES.md lists the rules.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.plans.warehouse import Warehouse

AS_OF = "1998-06-15"
COPY_STEP = 10**12
SHIFT = 10**15


def _folder(key: str) -> Column:
    slot = F.col(key) % 3
    return F.when(slot == 0, "ZF2526").when(slot == 1, "ZF2627").otherwise("ZFN2526")


def _code(key: str) -> Column:
    return F.call_function("div", F.col(key), F.lit(3)).cast("string")


def _money(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def _number(col: Column) -> Column:
    return col.cast("decimal(18,0)")


class LedgerData:
    """The six raw tables by name, each with folder, table and source position."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cache
    def __call__(self, name: str) -> DataFrame:
        return getattr(self, name.lower())().withColumn("_source_table", F.lit(name))

    def warehouse(self, **options) -> Warehouse:
        return Warehouse.from_raw(self.spark, self, placed=True, **options)

    def master(self) -> DataFrame:
        key, balance = F.col("c_custkey"), _money("c_acctbal")
        repeat = F.when(key % 50 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        rows = self.table("customer").withColumn("copy", F.explode(repeat))
        again = F.col("copy") == 1
        limit = F.when(~again & (F.col("c_nationkey") != 24), _money((F.col("c_nationkey") % 10) * 1000))
        return rows.select(
            _folder("c_custkey").alias("_source_folder"),
            (key + F.col("copy").cast("bigint") * COPY_STEP).alias("_seq"),
            F.when(key % 101 == 100, F.concat(F.lit("G"), _code("c_custkey"))).otherwise(_code("c_custkey")).alias("codecbg"),
            F.when(again, F.concat(F.lit("DUP "), "c_name")).otherwise(F.col("c_name")).alias("desccbg"),
            F.col("c_mktsegment").alias("groupcdbg"),
            F.col("c_nationkey").cast("string").alias("statecode"),
            F.lower("c_mktsegment").alias("place_cdbg"),
            (key + 9000000000).cast("string").alias("mobileno"),
            _money(balance - F.lit("100.00").cast("decimal(18,2)")).alias("opbalcbg"),
            F.when(again, _money(F.lit(0))).otherwise(balance).alias("balancebg"),
            limit.alias("crelimitbg"),
            F.concat(F.lit("GST"), key.cast("string")).alias("apgsttbg"),
        )

    def item(self) -> DataFrame:
        key, price, size = F.col("p_partkey"), _money("p_retailprice"), F.col("p_size")
        folders = F.array(F.lit("ZF2526"), F.lit("ZF2627"), F.lit("ZFN2526"))
        service = F.when(size % 5 == 0, "y").when(size % 5 == 1, "TRUE").when(size % 5 == 3, "N").when(size % 5 == 4, "F")
        return self.table("part").select(
            F.explode(folders).alias("_source_folder"),
            key.alias("_seq"),
            F.when(key % 89 == 88, F.concat(F.lit("G"), key.cast("string"))).otherwise(key.cast("string")).alias("itemcode"),
            F.col("p_name").alias("desc"),
            F.col("p_brand").alias("itemgroup"),
            F.substring("p_type", 1, 3).alias("uom"),
            (size + 1000).cast("string").alias("hsncode"),
            F.col("p_type").alias("valuation"),
            (price + F.lit("0.0025").cast("decimal(5,4)")).cast("decimal(18,4)").alias("itemrate"),
            size.cast("decimal(18,3)").alias("opbalqty"),
            _money(price * size).alias("opbalval"),
            service.alias("is_service"),
        )

    def sales1(self) -> DataFrame:
        key, total = F.col("o_orderkey"), _money("o_totalprice")
        none = F.lit(None).cast("int")
        copies = F.array_compact(
            F.array(
                F.lit(0),
                F.when(key % 40 == 3, 1).otherwise(none),
                F.when(key % 60 == 5, 2).otherwise(none),
                F.when(key % 200 == 9, 3).otherwise(none),
                F.when(key % 200 == 9, 4).otherwise(none),
            )
        )
        rows = self.table("orders").withColumn("copy", F.explode(copies))
        copy, day = F.col("copy"), F.col("o_orderdate").cast("date")
        amount = F.when(copy == 2, total + F.lit("1.00").cast("decimal(18,2)")).otherwise(total)
        ten = F.lit("10.00").cast("decimal(18,2)")
        return rows.select(
            _folder("o_custkey").alias("_source_folder"),
            (key + copy.cast("bigint") * COPY_STEP).alias("_seq"),
            _number(F.when(key % 53 == 52, key + SHIFT).otherwise(key)).alias("invnoebg"),
            F.when(copy == 1, F.date_add(day, 7)).otherwise(day).alias("invdatebg"),
            F.when(copy == 1, "CN").when(copy < 3, "SI").alias("invtypebg"),
            _code("o_custkey").alias("cuscodebg"),
            _money(amount - ten).alias("billamtg"),
            ten.alias("taxamtng"),
            _money(F.lit(0)).alias("roundoffg"),
            _money(amount).alias("totaliong"),
            F.col("o_orderpriority").alias("transportg"),
            ((key % 60).cast("decimal(10,1)") + F.lit("0.5").cast("decimal(10,1)")).cast("decimal(10,1)").alias("duedaysg"),
        )

    def sales2(self) -> DataFrame:
        # Casts stand below the join, where they make what is shuffled smaller, and the join is
        # by the number, so that the lines lie where their headers are looked up.
        part = F.col("l_partkey")
        number, order = _number(F.col("l_orderkey")).alias("invno"), _number(F.col("o_orderkey")).alias("_order")
        lines = self.table("lineitem").select(
            number,
            part,
            "l_suppkey",
            F.col("l_quantity").cast("decimal(18,3)").alias("qty"),
            _money("l_discount").alias("discount"),
            _money("l_linenumber").alias("disamt"),
            _money("l_extendedprice").alias("amount"),
            F.concat("l_returnflag", "l_linestatus").alias("batchno"),
        )
        orders = self.table("orders").select(order, "o_custkey").hint("shuffle_hash")
        return lines.join(orders, F.col("invno") == F.col("_order")).select(
            _folder("o_custkey").alias("_source_folder"),
            "invno",
            F.lit("SI").alias("invtype"),
            _code("o_custkey").alias("cuscode"),
            F.when(part % 97 == 0, part + 1).otherwise(part).cast("string").alias("itemcode"),
            F.col("l_suppkey").cast("string").alias("repcode"),
            "qty",
            (_money(part % 900 + 100) + (part % 10000).cast("decimal(6,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,4)").alias("itemrate"),
            "discount",
            "disamt",
            "amount",
            "batchno",
        )

    def trans(self) -> DataFrame:
        kind = F.col("event_type")
        flag = F.when(kind.isin("purchase", "signup"), "D").when(kind.isin("click", "view"), "C")
        return self.table("events").select(
            _folder("user_id").alias("_source_folder"),
            F.col("event_id").alias("_seq"),
            _number(F.col("event_id")).alias("vounoe"),
            F.col("ts").cast("date").alias("voudate"),
            _code("user_id").alias("codee"),
            F.col("props").alias("naration"),
            flag.alias("drcrate"),
            _money("value").alias("vou_amt"),
            kind.alias("repcode"),
        )

    def billadj(self) -> DataFrame:
        total, status = _money("o_totalprice"), F.col("o_orderstatus")
        less = total - F.lit("100.00").cast("decimal(18,2)")
        return self.table("orders").select(
            _folder("o_custkey").alias("_source_folder"),
            F.col("o_orderkey").alias("_seq"),
            _number(F.col("o_orderkey")).alias("vouno"),
            F.date_add(F.col("o_orderdate").cast("date"), 30).alias("voudate"),
            _code("o_custkey").alias("cuscode"),
            total.alias("vou_amt"),
            _money(F.when(status == "F", total).when(status == "P", less)).alias("billadj"),
            total.alias("billamt"),
            _number(F.col("o_orderkey")).alias("invno"),
        )
