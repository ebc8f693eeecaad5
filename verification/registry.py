"""Every registered query by name, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerspark.functions import coerce as typed
from ledgerspark.functions import flags, labels
from ledgerspark.functions.text import clean_text
from ledgerspark.jobs.discover import dictionary_json
from ledgerspark.jobs.rebuild import Rebuild
from ledgerspark.jobs.store import Store
from ledgerspark.operators import changes, dedup, evolve, lineage
from ledgerspark.plans import dims, profile, quality, queries, series, views
from ledgerspark.plans.warehouse import Warehouse
from ledgerspark.schemas import FACT_SALES, FILE_STATE, SYNC_LOG, WAREHOUSE_PARTS, conform
from ledgerspark.sources import tables, xbase
from ledgerspark.sources.storage import freed_shuffles
from ledgerspark.values import FOLDERS
from verification.ledger_data import AS_OF, COPY_STEP, LedgerData

RAW_NAMES = ("MASTER", "ITEM", "SALES1", "SALES2", "TRANS", "BILLADJ")


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines agree on: DECIMAL as DOUBLE, INT as BIGINT."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        match field.dataType:
            case T.DecimalType():
                return column.cast("double").alias(field.name)
            case T.IntegerType() | T.ShortType() | T.ByteType():
                return column.cast("bigint").alias(field.name)
            case _:
                return column

    return df.select(*[plain(f) for f in df.schema.fields])


def shared_dir(spark: SparkSession) -> str:
    """A fresh directory in the cluster's shared checkpoint folder; local runs that set
    none get a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


# ---- load-side operators over the derived tables ----------------------------------


def _dbf_scan(d: LedgerData) -> DataFrame:
    """All orders written as fixed-width records, then read back by the decoder."""
    key = F.col("o_orderkey")
    fields = xbase.layout(
        ("INVNO", "N", 18, 0), ("INVDATE", "D", 8, 0), ("TOTAL", "N", 14, 2), ("LABEL", "C", 24, 0), ("PAID", "L", 1, 0)
    )
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd")
    total = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    status, odd = F.col("o_orderstatus"), key % 2 == 1
    text = F.concat(
        F.when(key % 37 == 5, "*").when(key % 37 == 6, "x").otherwise(" "),
        F.lpad(key.cast("string"), 18, " "),
        F.when(key % 97 == 13, "20251301").otherwise(day),
        F.lpad(F.when(key % 89 == 7, "**").when(key % 3 == 1, F.translate(total, ".", ",")).otherwise(total), 14, " "),
        F.rpad(F.concat("o_orderpriority", F.when(odd, " \x80é").otherwise("")), 24, " "),
        F.when(status == "F", "T").when(status == "P", "?").otherwise("f"),
    )
    records = d.table("orders").select(F.encode(text, "ISO-8859-1").alias("record"), (~odd).alias("plain"))
    return xbase.decode(records, fields)


def _coerce_types(d: LedgerData) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    total = F.concat(F.lit("  "), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(" "))
    number = F.when(key % 11 == 4, "abc").when(key % 13 == 6, "   ").otherwise(total)
    day = F.when(key % 17 == 9, "20251301").otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd"))
    whole = F.when(key % 19 == 2, "12x").otherwise((key % 100000).cast("string"))
    flag = F.when(status == "F", "t").when(status == "P", "?").otherwise("n")
    return d.table("orders").select(
        key.alias("id"),
        typed.coerce(number, "N", 18, 2).alias("number"),
        typed.coerce(day, "D").alias("day"),
        typed.coerce(whole, "I").alias("whole"),
        typed.coerce(flag, "L").alias("flag"),
    )


def _repeated_lines(d: LedgerData) -> DataFrame:
    again = F.when(F.col("invno") % 70 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    seq = F.col("invno") * 8 + F.col("disamt") + F.col("copy") * COPY_STEP
    return d.sales2().withColumn("copy", F.explode(again)).withColumn("_seq", seq.cast("bigint")).drop("copy")


def _exact_dedup(d: LedgerData) -> DataFrame:
    lines = _repeated_lines(d)
    unique = dedup.exact_dedup(lines, [c for c in lines.columns if c != "_seq"], "_seq")
    return unique.withColumn("invno", F.col("invno").cast("string")).withColumnRenamed("_source_folder", "source_folder")


def _duplicate_counts(d: LedgerData) -> DataFrame:
    lines = _repeated_lines(d).withColumnRenamed("_source_folder", "source_folder").drop("_seq")
    return dedup.duplicate_counts(lines, lines.columns, ["source_folder"])


def _row_hash(d: LedgerData) -> DataFrame:
    rows = d.master().withColumn("statecode", F.when(F.col("statecode") != "24", F.col("statecode")))
    return rows.select(F.col("_source_folder").alias("source_folder"), "codecbg", "_seq", lineage.row_hash(lineage.business_columns(rows)).alias("row_hash"))


def _lineage_columns(d: LedgerData) -> DataFrame:
    rows = lineage.with_lineage(d.sales1(), F.col("_source_folder"), "SALES1")
    return rows.groupBy("_source_folder", "_source_table").agg(
        F.count("*").alias("rows"), F.countDistinct("_row_hash").alias("hashes")
    )


def _evolve_schema(d: LedgerData) -> DataFrame:
    rows = d.master().select(
        F.col("_source_folder").alias("source_folder"), "codecbg", "_seq", "place_cdbg", "balancebg", "apgsttbg"
    )
    before = rows.filter("source_folder = 'ZF2526'").drop("apgsttbg")
    after = evolve.evolve(rows.filter("source_folder <> 'ZF2526'").drop("place_cdbg"), before.schema)
    return changes.union_folders([before, after])


def _fingerprinted(rows: DataFrame, table: str) -> DataFrame:
    digest = F.md5(F.concat_ws("|", F.count("*").cast("string"), F.sum("_seq").cast("string")))
    return rows.groupBy(F.col("_source_folder").alias("source_folder")).agg(digest.alias("file_hash")).select(
        "source_folder", F.lit(table).alias("table_name"), "file_hash"
    )


def _changed_files(d: LedgerData) -> DataFrame:
    master, item = d.master(), d.item()
    now = _fingerprinted(master, "MASTER").unionByName(_fingerprinted(item, "ITEM"))
    before = _fingerprinted(master.filter(~F.col("desccbg").startswith("DUP ")), "MASTER").unionByName(
        _fingerprinted(item.filter("_source_folder <> 'ZFN2526'"), "ITEM")
    )
    return changes.changed_files(now, before)


def _daily_state(rows: DataFrame, table: str, day: str) -> DataFrame:
    counted = rows.groupBy(F.col("_source_folder").alias("source_folder"), F.col(day).cast("timestamp").alias("last_synced"))
    return conform(counted.agg(F.count("*").alias("row_count")), FILE_STATE, {"table_name": F.lit(table)})


def _file_state_upsert(d: LedgerData) -> DataFrame:
    old, new = _daily_state(d.sales1(), "SALES1", "invdatebg"), _daily_state(d.billadj(), "BILLADJ", "voudate")
    return changes.upsert_state(old, new).select(
        "source_folder", "table_name", F.col("last_synced").cast("date").alias("last_synced"), "row_count"
    )


def _replace_slice(d: LedgerData) -> DataFrame:
    existing = d("SALES1").select("_source_folder", "_source_table", "totaliong")
    fresh = d.billadj().filter("_source_folder = 'ZF2627'").select(
        "_source_folder", F.lit("SALES1").alias("_source_table"), F.col("vou_amt").alias("totaliong")
    )
    replaced = changes.replace_slice(existing, fresh, "ZF2627", "SALES1")
    return replaced.groupBy(F.col("_source_folder").alias("source_folder"), F.col("_source_table").alias("table_name")).agg(
        F.count("*").alias("rows"), F.sum("totaliong").alias("total")
    )


def _sync_history(d: LedgerData) -> DataFrame:
    daily = _daily_state(d.sales1(), "SALES1", "invdatebg")
    started, key = F.col("last_synced"), F.concat_ws("|", "source_folder", F.col("last_synced").cast("string"))
    done = conform(
        daily, SYNC_LOG,
        {"log_id": key, "started_at": started, "ended_at": started, "rows_written": "row_count", "status": F.lit("success")},
    )
    running = conform(daily, SYNC_LOG, {"log_id": key, "started_at": started, "rows_written": F.lit(0), "status": F.lit("running")})
    return quality.sync_history(running.unionByName(done)).select(
        "source_folder", "table_name", F.col("started_at").cast("date").alias("started_day"), "rows_written"
    )


def _file_freshness(d: LedgerData) -> DataFrame:
    def state(rows: DataFrame, table: str, day: str) -> DataFrame:
        per_folder = rows.groupBy(F.col("_source_folder").alias("source_folder")).agg(
            F.max(F.col(day).cast("timestamp")).alias("last_synced"), F.count("*").alias("row_count")
        )
        return conform(per_folder, FILE_STATE, {"table_name": F.lit(table)})

    both = state(d.sales1(), "SALES1", "invdatebg").unionByName(state(d.trans(), "TRANS", "voudate"))
    return quality.file_freshness(both).select(
        "source_folder", "table_name", F.col("last_synced").cast("date").alias("last_day"), "row_count"
    )


def _union_folders(d: LedgerData) -> DataFrame:
    item = d.item().select(
        F.col("_source_folder").alias("source_folder"),
        F.col("itemcode").alias("item_code"),
        F.col("desc").alias("item_description"),
        "uom",
        F.col("opbalval").alias("opening_value"),
    )
    parts = [item.filter(F.col("source_folder") == f) for f in ("ZF2526", "ZF2627", "ZFN2526")]
    parts[1] = parts[1].drop("uom")
    return changes.union_folders(parts)


def _read_write_table(d: LedgerData) -> DataFrame:
    path = shared_dir(d.spark)
    written = d.warehouse(whole=True).fact_sales
    tables.write_table(written, path, ["source_folder"])
    return tables.read_table(d.spark, path, written.schema).select(*FACT_SALES.fieldNames())


def _incremental_rebuild(d: LedgerData) -> DataFrame:
    """Two warehouse versions over stored raw slices, the second after the lines of one folder
    have changed: what each month holds, and which version wrote its partition."""
    store = Store(d.spark, shared_dir(d.spark))
    for name in RAW_NAMES:
        # Lines lie by their order; sorted by number they take less room.
        rows = d(name).sortWithinPartitions("_source_folder", "invno") if name == "SALES2" else d(name)
        with freed_shuffles(d.spark):
            rows.write.option("compression", tables.CODEC).partitionBy("_source_folder").parquet(store.path("raw", name))
    slices = {(f, name): store.path("raw", name, f"_source_folder={f}") for f in FOLDERS for name in RAW_NAMES}
    lines = d.spark.read.parquet(slices["ZF2526", "SALES2"])
    changed = F.when(F.col("invno") % 7 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)")
    lines.withColumn("amount", changed).write.option("compression", tables.CODEC).parquet(store.path("raw", "changed"))
    before = None
    for version, now in (("first", slices), ("second", slices | {("ZF2526", "SALES2"): store.path("raw", "changed")})):
        rebuild = Rebuild(store, version, now, before)
        rebuild.dimensions(Warehouse.from_raw(d.spark, rebuild.raw))
        rebuild.facts()
        rebuild.record()
        before = version
    month = F.trunc("invoice_date", "MM").alias("month")
    held = store.warehouse("second").fact_sales.groupBy("source_folder", month).agg(F.count("*").alias("rows"), F.sum("line_amount").alias("revenue"))
    parts = store.records("warehouse_parts", WAREHOUSE_PARTS).filter("version = 'second' AND table_name = 'fact_sales'")
    parts = parts.select(F.col("source_folder").alias("_folder"), F.col("month").alias("_month"), "written_by")
    same = (F.col("source_folder") == F.col("_folder")) & F.col("month").eqNullSafe(F.col("_month"))
    return held.join(parts, same, "full").drop("_folder", "_month")


# ---- scalar functions over the derived tables --------------------------------------


def _clean_text(d: LedgerData) -> DataFrame:
    text = d.table("documents").select("doc_id", clean_text("text").alias("cleaned"))
    return text.select("doc_id", F.md5("cleaned").alias("cleaned_md5"), F.length("cleaned").alias("cleaned_chars"))


def _financial_year(d: LedgerData) -> DataFrame:
    return d.sales1().groupBy(flags.financial_year(F.col("invdatebg")).alias("financial_year")).agg(
        F.count("*").alias("invoices"), F.sum("totaliong").alias("total_amount")
    )


def _parse_service_flag(d: LedgerData) -> DataFrame:
    text = F.col("is_service")
    return d.item().groupBy(
        F.col("_source_folder").alias("source_folder"), text.alias("raw_text"), flags.is_service(text).alias("is_service")
    ).agg(F.count("*").alias("items"))


def _internal_flag(d: LedgerData) -> DataFrame:
    return d.warehouse().dim_customer.filter("is_internal_account").select("source_folder", "ledger_code", "customer_name")


def _over_limit_flag(d: LedgerData) -> DataFrame:
    limit = F.col("credit_limit")
    return d.warehouse().dim_customer.groupBy(
        "source_folder", limit.isNull().alias("no_limit"), flags.over_limit(F.col("current_balance"), limit).alias("over_credit_limit")
    ).agg(F.count("*").alias("customers"))


def _display_labels(d: LedgerData) -> DataFrame:
    wh = d.warehouse()
    kinds = wh.dim_product.select("source_folder", "item_code", "is_service")
    name = labels.name_or_code(F.col("item_description"), F.col("item_code"))
    return views.slow_moving(wh, AS_OF).join(kinds, ["source_folder", "item_code"]).select(
        "source_folder",
        "item_code",
        name.alias("display_name"),
        labels.short_label(name, 8).alias("short_name"),
        labels.idle_label(F.col("days_since_last_sale")).alias("idle"),
        labels.kind_label(F.col("is_service")).alias("kind"),
    )


def _display_labels_customers(d: LedgerData) -> DataFrame:
    return views.outstanding_receivables(d.warehouse()).select(
        "source_folder",
        "ledger_code",
        labels.name_or_code(F.col("customer_name"), F.col("ledger_code")).alias("display_name"),
        labels.limit_status(F.col("over_credit_limit")).alias("limit_status"),
    )


def _display_labels_vouchers(d: LedgerData) -> DataFrame:
    return d.warehouse().fact_finance.groupBy(
        "source_folder", labels.movement_label(F.col("debit_credit")).alias("movement")
    ).agg(F.count("*").alias("vouchers"))


def _dim_date(d: LedgerData) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return dims.calendar(d.table("orders").agg(F.min(day).alias("first"), F.max(day).alias("last")))


def _dim_ledger_group(d: LedgerData) -> DataFrame:
    groups = d.item().select(
        "_source_folder", "_seq", "itemgroup", F.concat_ws(" ", "valuation", "desc").alias("name"), "uom"
    )
    return dims.dim_ledger_group(groups, "itemgroup", "name", "uom")


def _catalog(d: LedgerData) -> DataFrame:
    return profile.catalog_of({name: d(name) for name in RAW_NAMES})


def _dictionary(d: LedgerData) -> DataFrame:
    """The JSON texts read back; the time of the report is left out."""
    kind = "record_count bigint, fields array<struct<name: string, type: string, length: int, decimals: int>>, tables array<string>, total_tables bigint, total_records bigint"
    read = dictionary_json(_catalog(d)).withColumn("read", F.from_json("body", kind))
    field = F.expr("transform(read.fields, f -> concat_ws(':', f.name, f.type, f.length, f.decimals))")
    return read.select(
        "section",
        "name",
        "read.record_count",
        F.array_join(F.array_sort(field), ",").alias("fields"),
        F.array_join("read.tables", ", ").alias("tables"),
        "read.total_tables",
        "read.total_records",
    )


def _all_null_check(d: LedgerData) -> DataFrame:
    """All raw tables; every tenth voucher is emptied."""
    vouchers, empty = d("TRANS"), F.col("_seq") % 10 == 3
    values = {c: F.when(~empty, F.col(c)) for c in lineage.business_columns(vouchers)}
    tables = [vouchers.withColumns(values) if name == "TRANS" else d(name) for name in RAW_NAMES]
    return changes.union_folders([quality.all_null_check(t) for t in tables])


def _sample_rows_all(d: LedgerData) -> DataFrame:
    """First rows of all raw tables by their first three fields."""

    def sampled(name: str) -> DataFrame:
        table = d(name)
        if "_seq" not in table.columns:
            table = table.withColumn("_seq", (F.col("invno") * 8 + F.col("disamt")).cast("bigint"))
        found = profile.sample_rows(table, fields=3)
        shown = [c for c in found.columns if c not in ("source_folder", "row_no")]
        return found.select("source_folder", F.lit(name).alias("table_name"), "row_no", F.concat_ws("|", *shown).alias("shown"))

    return changes.union_folders([sampled(name) for name in RAW_NAMES])


def _raw_load_counts(d: LedgerData) -> DataFrame:
    rows = [
        lineage.with_lineage(d(name), F.col("_source_folder"), name).select("_source_folder", "_source_table", "_row_hash", "_synced_at")
        for name in RAW_NAMES
    ]
    return quality.raw_load_counts(changes.union_folders(rows)).drop("last_sync")


def _rejects(d: LedgerData) -> DataFrame:
    """Customers of whom some lose their code by recoding."""
    master = d.master().withColumn("codecbg", F.when(F.col("_seq") % 10 != 4, F.col("codecbg")))
    return dims.rejects(master, "codecbg").select(F.col("_source_folder").alias("source_folder"), "_seq", "desccbg", "mobileno")

OVER_DATA: dict[str, Callable[[LedgerData], DataFrame]] = {
    # sources and load
    "dbf_scan": _dbf_scan,
    "changed_files": _changed_files,
    "file_state_upsert": _file_state_upsert,
    "replace_slice": _replace_slice,
    "evolve_schema": _evolve_schema,
    "exact_dedup": _exact_dedup,
    "duplicate_counts": _duplicate_counts,
    "row_hash": _row_hash,
    "lineage_columns": _lineage_columns,
    "read_write_table": _read_write_table,
    "incremental_rebuild": _incremental_rebuild,
    "union_folders": _union_folders,
    # scalar functions
    "clean_text": _clean_text,
    "coerce_types": _coerce_types,
    "parse_service_flag": _parse_service_flag,
    "financial_year": _financial_year,
    "internal_flag": _internal_flag,
    "over_limit_flag": _over_limit_flag,
    "display_labels": _display_labels,
    "display_labels_customers": _display_labels_customers,
    "display_labels_vouchers": _display_labels_vouchers,
    # dimensions
    "dim_date": _dim_date,
    "dim_customer_rejects": _rejects,
    "dim_ledger_group": _dim_ledger_group,
    # profile
    "table_summary": lambda d: profile.table_summary(_catalog(d)).drop("file_size_kb", "last_modified"),
    "field_dictionary": lambda d: profile.field_dictionary(_catalog(d)),
    "find_relationships": lambda d: profile.find_relationships(_catalog(d)),
    "sample_rows": lambda d: profile.sample_rows(d.trans()),
    "sample_rows_all": _sample_rows_all,
    "dictionary_json": _dictionary,
    # checks on raw data and load records
    "check_revenue_reconciles": lambda d: quality.revenue_reconciles(d.sales2(), d.warehouse()),
    "header_multiplicity": lambda d: quality.header_multiplicity(d.sales2(), d.sales1()),
    "raw_load_counts": _raw_load_counts,
    "sync_history": _sync_history,
    "file_freshness": _file_freshness,
    "all_null_check": _all_null_check,
    # sales read with all columns
    "fact_sales_match_type": lambda d: d.warehouse(match_type=True, whole=True).fact_sales,
    "fact_sales": lambda d: d.warehouse(whole=True).fact_sales,
    "q_invoice_lines": lambda d: queries.invoice_lines(d.warehouse(whole=True), "83"),
}

OVER_WAREHOUSE = {
    "dim_customer": lambda w: w.dim_customer,
    "dim_product": lambda w: w.dim_product,
    "fact_sales_header": lambda w: w.fact_sales_header,
    "fact_finance": lambda w: w.fact_finance,
    "fact_receivables": lambda w: w.fact_receivables,
    "folder_filter": lambda w: w.scoped("zfn2526").fact_sales,
    # views
    "sales_summary": views.sales_summary,
    "today_sales": lambda w: views.today_sales(w, AS_OF),
    "monthly_sales": views.monthly_sales,
    "top_customers": views.top_customers,
    "top_products": views.top_products,
    "slow_moving": lambda w: views.slow_moving(w, AS_OF),
    "outstanding_receivables": views.outstanding_receivables,
    "cash_flow": views.cash_flow,
    "customer_ltv": views.customer_ltv,
    "company_overview": views.company_overview,
    # parameterized queries
    "q_overview": queries.overview,
    "q_overview_folder": lambda w: queries.overview(w, "ZF2526"),
    "q_today_sales": lambda w: queries.today_sales(w, as_of=AS_OF),
    "q_monthly_sales": queries.monthly_sales,
    "q_sales_summary": lambda w: queries.sales_summary(w, start="1997-01-01", end="1997-12-31"),
    "q_top_customers": queries.top_customers,
    "q_top_customers_folder": lambda w: queries.top_customers(w, "zf2526", 15),
    "q_receivables": queries.receivables,
    "q_customer_ltv": queries.customer_ltv,
    "q_customer_detail": lambda w: queries.customer_detail(w, "11"),
    "q_top_products": queries.top_products,
    "q_slow_moving": lambda w: queries.slow_moving(w, as_of=AS_OF),
    "q_product_detail": lambda w: queries.product_detail(w, "42"),
    "q_cash_flow": lambda w: queries.cash_flow(w, start="2024-01-05", end="2024-01-20"),
    "q_transactions": queries.transactions,
    "q_transactions_ledger": lambda w: queries.transactions(w, ledger_code="7", limit=25),
    "q_inventory_items": lambda w: queries.inventory_items(w, item_group="Brand#2"),
    "q_invoice_header": lambda w: queries.invoice_header(w, "83"),
    # series
    "kpi_totals": lambda w: series.kpi_totals(w, as_of=AS_OF),
    "monthly_trend_series": series.monthly_trend,
    "cash_flow_series": series.cash_flow_series,
    "top_products_series": series.top_products_series,
    # checks
    "check_orphan_customers": quality.orphan_customers,
    "check_orphan_products": quality.orphan_products,
    "row_counts": lambda w: quality.row_counts(w),
    "latest_invoice_date": quality.latest_invoice_date,
}


@lru_cache(maxsize=4)
def _opened(spark: SparkSession, sf_dir: str) -> tuple[LedgerData, Warehouse]:
    """Derived tables and warehouse of a data set: lazy plans, built once per session."""
    data = LedgerData(spark, sf_dir)
    return data, data.warehouse()


def queries_by_name() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_data(build):
        return lambda spark, sf_dir: comparable(build(_opened(spark, sf_dir)[0]))

    def over_warehouse(build):
        return lambda spark, sf_dir: comparable(build(_opened(spark, sf_dir)[1]))

    return {k: over_data(b) for k, b in OVER_DATA.items()} | {k: over_warehouse(b) for k, b in OVER_WAREHOUSE.items()}
