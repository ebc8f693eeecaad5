"""Hand-computed cases for the points where engines disagree."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.functions import flags, labels
from ledgerspark.functions.coerce import coerce
from ledgerspark.functions.text import clean_label, clean_text, field_name
from ledgerspark.operators.changes import changed_files, replace_slice, upsert_state
from ledgerspark.operators.dedup import exact_dedup, keep_first
from ledgerspark.operators.evolve import evolve
from ledgerspark.plans import dims, profile, quality, queries, series, views
from ledgerspark.plans.facts import fact_sales
from ledgerspark.plans.warehouse import checked_folder
from tests.ledgers import SCHEMAS, day, ledger, listed, money

A, B = "ZF2526", "ZF2627"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


# ---- dimensions --------------------------------------------------------------------


def test_first_row_per_code_wins_and_folders_stay_apart(spark):
    wh = ledger(
        spark,
        MASTER=[
            (A, 5, "11", "later", "g", money("1"), None),
            (A, 2, "11", "first", None, None, None),
            (B, 9, "11", "other folder", "g", money("3"), None),
            (A, 1, None, "no code", "g", money("9"), None),
        ],
    )
    rows = listed(wh.dim_customer.orderBy("customer_key"), "customer_key", "customer_name", "account_group", "current_balance")
    assert rows == [(f"{A}|11", "first", None, None), (f"{B}|11", "other folder", "g", Decimal("3.00"))]


def test_null_codes_are_rejected_not_lost(spark):
    raw = spark.createDataFrame([(A, 1, None), (A, 2, "x")], "_source_folder string, _seq long, codecbg string")
    assert listed(dims.rejects(raw, "codecbg"), "_seq") == [(1,)]


def test_internal_codes_in_every_folder(spark):
    codes = ["26", "01", "1", "c", "C", "2"]
    wh = ledger(spark, MASTER=[(f, i, c, c, None, None, None) for f in (A, B) for i, c in enumerate(codes)])
    internal = {r.customer_key for r in wh.dim_customer.filter("is_internal_account").collect()}
    assert internal == {f"{f}|{c}" for f in (A, B) for c in ("26", "01", "C", "2")}


def test_calendar_edges(spark):
    dates = dims.dim_date(spark)
    assert dates.count() == 4018
    rows = {str(r.date_key): r for r in dates.collect()}
    assert (rows["2021-01-03"].week_of_year, rows["2021-01-03"].is_weekend) == (53, True)
    assert rows["2021-01-04"].is_weekend is False
    assert rows["2025-03-31"].financial_year == "FY2024-25"
    assert rows["2025-04-01"].financial_year == "FY2025-26"
    assert rows["2025-05-01"].month_name == "May      " and len(rows["2025-05-01"].day_name) == 9


def test_financial_year_turns_the_century(spark):
    assert one(spark, flags.financial_year(F.lit("2099-04-01").cast("date"))) == "FY2099-00"


@pytest.mark.parametrize("text,expected", [("y", True), ("TRUE", True), ("1", True), ("t", True), ("N", False), ("", False), (None, False)])
def test_service_flag(spark, text, expected):
    assert one(spark, flags.is_service(F.lit(text).cast("string"))) is expected


# ---- facts -------------------------------------------------------------------------


def test_a_number_under_two_types_repeats_its_lines(spark):
    rows = dict(
        SALES1=[
            (A, 1, money("7"), day("2025-01-01"), "SI", "1", None, None),
            (A, 2, money("7"), day("2025-01-02"), "CN", "1", None, None),
        ],
        SALES2=[(A, money("7"), "SI", "1", "i", money("1"), money("10"))],
    )
    wh = ledger(spark, **rows)
    assert sorted(listed(wh.fact_sales, "invoice_date", "line_amount")) == [
        (day("2025-01-01"), Decimal("10.00")),
        (day("2025-01-02"), Decimal("10.00")),
    ]
    raw = {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in rows.items()}
    exact = fact_sales(raw["SALES2"], raw["SALES1"], wh.dim_customer, wh.dim_product, match_type=True)
    assert listed(exact, "invoice_date") == [(day("2025-01-01"),)]


def test_lines_without_header_customer_or_item_are_kept(spark):
    wh = ledger(spark, SALES2=[(A, money("7"), "SI", "1", "i", money("1"), money("10")), (A, None, None, None, None, None, None)])
    assert sorted(listed(wh.fact_sales, "invoice_date", "customer_key", "product_key"), key=str) == [(None, None, None)] * 2


def test_headers_with_null_keys_are_all_kept(spark):
    head = [
        (A, 3, money("7"), None, "SI", "1", money("3"), None),
        (A, 1, money("7"), None, "SI", "1", money("1"), None),
        (A, 2, money("7"), None, None, "1", money("2"), None),
        (A, 4, money("7"), None, None, "1", money("2"), None),
        (A, 5, None, None, "SI", "1", money("5"), None),
        (A, 6, None, None, "SI", "1", money("5"), None),
    ]
    totals = sorted(r.total_amount for r in ledger(spark, SALES1=head).fact_sales_header.collect())
    assert totals == [Decimal(t) for t in ("1.00", "2.00", "2.00", "5.00", "5.00")]


@pytest.mark.parametrize("days,expected", [("30.5", 31), ("-30.5", -31), ("30.4", 30), (None, None)])
def test_due_days_round_half_away_from_zero(spark, days, expected):
    head = [(A, 1, money("7"), None, "SI", "1", None, money(days))]
    assert listed(ledger(spark, SALES1=head).fact_sales_header, "due_days") == [(expected,)]


# ---- views -------------------------------------------------------------------------


def slow_ledger(spark):
    return ledger(
        spark,
        ITEM=[(A, i, c, c, "g", None, None) for i, c in enumerate(["never", "edge", "stale", "fresh"])],
        SALES1=[(A, i, money(str(i)), day(d), "SI", "1", None, None) for i, d in [(1, "2025-01-01"), (2, "2024-12-31"), (3, "2025-03-01")]],
        SALES2=[(A, money(n), "SI", "1", c, money("1"), money("1")) for n, c in [("1", "edge"), ("2", "stale"), ("3", "fresh"), ("9", "never")]],
    )


def test_ninety_days_exactly_is_not_slow(spark):
    rows = listed(views.slow_moving(slow_ledger(spark), "2025-04-01"), "item_code", "days_since_last_sale")
    assert rows == [("never", None), ("stale", 91)]


def test_net_movement_takes_unflagged_amounts_as_credit(spark):
    d = day("2025-01-01")
    wh = ledger(
        spark,
        TRANS=[
            (A, money("1"), d, "1", "D", money("10")),
            (A, money("2"), d, "1", "C", money("3")),
            (A, money("3"), d, "1", None, money("2")),
            (A, money("4"), d, "1", "X", money("1")),
            (B, money("5"), d, "1", "C", None),
            (B, money("6"), None, "1", "D", money("99")),
        ],
    )
    rows = {r.source_folder: r for r in views.cash_flow(wh).collect()}
    assert (rows[A].total_debit, rows[A].total_credit, rows[A].net_movement) == (Decimal(10), Decimal(3), Decimal(4))
    assert (rows[B].total_debit, rows[B].total_credit, rows[B].net_movement) == (Decimal(0), None, None)


def sales_ledger(spark):
    return ledger(
        spark,
        MASTER=[(A, 1, "1", "one", None, money("50"), money("0")), (A, 2, "2x", "", None, money("5"), money("4")), (A, 3, "CSTK", "stock", None, money("7"), None)],
        ITEM=[(A, 1, "i", "a very long item description", "g", None, None), (A, 2, "j", None, "g", None, "y")],
        SALES1=[(A, 1, money("1"), day("2025-01-31"), "SI", "1", None, None), (A, 2, money("2"), day("2025-02-01"), "SI", "2x", None, None)],
        SALES2=[
            (A, money("1"), "SI", "1", "i", money("1"), money("10.01")),
            (A, money("1"), "SI", "1", "j", money("2"), money("20")),
            (A, money("2"), "SI", "2x", "i", money("3"), None),
            (A, money("2"), "SI", "CSTK", "i", money("4"), money("1000")),
            (A, money("2"), "SI", "gone", "i", money("5"), money("500")),
        ],
    )


def test_internal_and_orphan_lines_count_only_where_the_reports_say(spark):
    wh = sales_ledger(spark)
    summary = {r.invoice_date: (r.total_sales, r.total_qty) for r in views.sales_summary(wh).collect()}
    assert summary == {day("2025-01-31"): (Decimal("30.01"), Decimal(3)), day("2025-02-01"): (None, Decimal(3))}
    monthly = {r.month: r.total_sales for r in views.monthly_sales(wh).collect()}
    assert monthly == {day("2025-01-01"): Decimal("30.01"), day("2025-02-01"): Decimal("1500.00")}
    products = {r.item_code: r.total_revenue for r in views.top_products(wh).collect()}
    assert products == {"i": Decimal("1510.01"), "j": Decimal("20.00")}
    assert listed(views.company_overview(wh)) == [(A, 2, Decimal("30.01"), 2, Decimal("55.00"))]


def test_a_null_total_ranks_first(spark):
    assert listed(views.top_customers(sales_ledger(spark)), "ledger_code", "total_purchases") == [("2x", None), ("1", Decimal("30.01"))]
    assert listed(queries.top_customers(sales_ledger(spark), limit=1), "ledger_code") == [("2x",)]
    assert listed(queries.customer_ltv(sales_ledger(spark), limit=1), "ledger_code", "avg_order_value") == [("2x", None)]


def test_a_zero_or_missing_limit_is_never_exceeded(spark):
    rows = listed(views.outstanding_receivables(sales_ledger(spark)), "ledger_code", "over_credit_limit")
    assert rows == [("1", False), ("2x", True)]


@pytest.mark.parametrize("total,count,expected", [("0.05", 2, "0.03"), ("-0.05", 2, "-0.03"), ("10.00", 3, "3.33"), ("0.01", 3, "0.00"), ("5.00", 0, None), (None, 3, None)])
def test_average_rounds_half_away_from_zero(spark, total, count, expected):
    value = one(spark, flags.exact_average(F.lit(money(total)).cast("decimal(28,2)"), F.lit(count).cast("bigint")))
    assert value == money(expected)


def test_average_of_more_than_two_decimals(spark):
    for total, count, expected in (("0.0149", 1, "0.01"), ("0.0150", 1, "0.02"), ("-10.005", 1, "-10.01"), ("1.2345", 2, "0.62")):
        value = one(spark, flags.exact_average(F.lit(money(total)).cast("decimal(30,4)"), F.lit(count).cast("bigint")))
        assert value == money(expected)


def test_average_does_not_round_twice(spark):
    # 0.00499999999999... must not become 0.005 and then 0.01
    value = one(spark, flags.exact_average(F.lit(Decimal("49999999999.99")).cast("decimal(28,2)"), F.lit(10_000_000_000_000).cast("bigint")))
    assert value == Decimal("0.00")


# ---- queries -----------------------------------------------------------------------


def test_folder_is_checked():
    assert checked_folder(None) is None and checked_folder("") is None
    assert checked_folder("zf2526") == "ZF2526"
    with pytest.raises(ValueError):
        checked_folder("nope")


@pytest.mark.parametrize("name,query", [("top_customers", queries.top_customers), ("monthly_sales", queries.monthly_sales), ("transactions", queries.transactions), ("slow_moving", queries.slow_moving)])
def test_limits_are_range_checked(spark, name, query):
    wh = ledger(spark)
    for wrong in (0, -1, queries.LIMITS[name][2] + 1):
        with pytest.raises(ValueError):
            query(wh, limit=wrong)
    query(wh, limit=queries.LIMITS[name][2])


def test_unknown_codes_give_no_rows(spark):
    wh = sales_ledger(spark)
    assert queries.customer_detail(wh, "zzz").count() == 0
    assert queries.product_detail(wh, "zzz").count() == 0
    assert queries.invoice_header(wh, "zzz").count() == 0


def test_date_bounds_are_inclusive_and_optional(spark):
    wh = sales_ledger(spark)
    days = lambda **k: [r.invoice_date for r in queries.sales_summary(wh, **k).collect()]
    assert days() == [day("2025-02-01"), day("2025-01-31")]
    assert days(start="2025-02-01") == [day("2025-02-01")]
    assert days(end="2025-01-31") == [day("2025-01-31")]
    assert days(start="2025-01-31", end="2025-02-01") == [day("2025-02-01"), day("2025-01-31")]


def test_a_ledger_filter_drops_vouchers_of_unknown_ledgers(spark):
    wh = ledger(
        spark,
        MASTER=[(A, 1, "1", "one", None, None, None), (B, 1, "1", "uno", None, None, None)],
        TRANS=[(A, money("1"), day("2025-01-01"), "1", "D", money("1")), (B, money("2"), None, "1", "D", money("1")), (A, money("3"), day("2025-01-02"), "9", "D", money("1"))],
    )
    assert listed(queries.transactions(wh, ledger_code="1"), "voucher_no", "customer_name") == [("2", "uno"), ("1", "one")]
    assert listed(queries.transactions(wh), "voucher_no", "customer_name") == [("2", "uno"), ("3", None), ("1", "one")]
    assert queries.transactions(wh, ledger_code="9").count() == 0


def test_kpis_of_an_empty_ledger_are_zero(spark):
    assert listed(series.kpi_totals(ledger(spark), as_of="2025-01-01")) == [(0, 0, 0, 0, 0, 0)]


def test_product_series_shortens_and_falls_back_to_the_code(spark):
    assert listed(series.top_products_series(sales_ledger(spark)), "label") == [("a very long item d…",), ("j",)]


def test_labels(spark):
    text = lambda v: F.lit(v).cast("string")
    assert one(spark, labels.name_or_code(text(""), text("c"))) == "c"
    assert one(spark, labels.or_dash(text(None))) == "—"
    assert one(spark, labels.idle_label(F.lit(12))) == "12d"
    assert one(spark, labels.idle_label(F.lit(None).cast("int"))) == "Never sold"
    assert one(spark, labels.movement_label(text("X"))) == "—"


# ---- text and types ------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw,clean",
    [("a\x00b\x07c", "abc"), ("\t x\ty \n", "x\ty"), ("\xa0x ", "x"), ("a�\x7f", "a"), (" \x01 ", None), ("", None), (None, None), ("é€", "é€")],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, clean_text(F.lit(raw).cast("string"))) == clean
    assert one(spark, clean_label(F.lit(raw).cast("string"))) == (clean or "")


@pytest.mark.parametrize(
    "text,code,expected",
    [
        (" 12.50 ", "N", Decimal("12.50")), ("1e2", "F", Decimal("100.00")), ("NaN", "N", None), ("1,5", "N", Decimal("1.50")), ("***", "N", None), ("", "N", None),
        ("12", "I", 12), ("1.5", "I", None), ("20250131", "D", day("2025-01-31")), ("20251301", "D", None), ("2025-01-31", "D", None),
        ("t", "L", True), ("Y", "L", True), ("1", "L", True), ("F", "L", False), ("?", "L", None), ("n", "L", False), (" ", "L", None),
        ("9000000000", "+", 9000000000), ("12.34567", "Y", Decimal("12.3457")), (" x ", "C", "x"), (None, "N", None),
    ],
)
def test_coerce(spark, text, code, expected):
    assert one(spark, coerce(F.lit(text).cast("string"), code, 10, 2)) == expected


@pytest.mark.parametrize("raw,name", [("INVNOEbG", "invnoebg"), ("DR-CR", "dr_cr"), ("1ST", "f_1st"), ("__x_", "x"), ("--", "field_unknown"), ("é", "field_unknown")])
def test_field_name(raw, name):
    assert field_name(raw) == name


# ---- load operators ------------------------------------------------------------------


def test_exact_dedup_is_idempotent_and_null_safe(spark):
    df = spark.createDataFrame([("a", None, 3), ("a", None, 1), ("a", 1, 2)], "x string, y int, _seq long")
    once = exact_dedup(df, ["x", "y"], "_seq")
    assert sorted(listed(once), key=str) == sorted([("a", None, 1), ("a", 1, 2)], key=str)
    assert sorted(listed(exact_dedup(once, ["x", "y"], "_seq")), key=str) == sorted(listed(once), key=str)


def test_keep_first_treats_null_keys_as_asked(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", 4, "d"), ("k", 3, "c")], "k string, _seq long, v string")
    assert sorted(listed(keep_first(df, ["k"], "_seq"), "v")) == [("a",), ("c",)]
    assert sorted(listed(keep_first(df, ["k"], "_seq", distinct_nulls=True), "v")) == [("a",), ("b",), ("c",)]


def test_changed_files(spark):
    state = spark.createDataFrame([("A", "T", "h1"), ("A", "U", None)], "source_folder string, table_name string, file_hash string")
    files = spark.createDataFrame([("A", "T", "h2"), ("A", "U", None), ("B", "T", "h1")], state.schema)
    assert sorted(listed(changed_files(files, state), "source_folder", "table_name")) == [("A", "T"), ("B", "T")]
    assert changed_files(files, state, "full").count() == 3
    with pytest.raises(ValueError):
        changed_files(files, state, "sometimes")


def test_upsert_prefers_the_newer_and_on_a_tie_the_new_side(spark):
    schema = "source_folder string, table_name string, file_hash string, last_synced timestamp"
    t = lambda n: datetime(2025, 1, n)
    old = spark.createDataFrame([("A", "T", "old", t(2)), ("A", "U", "kept", t(5))], schema)
    new = spark.createDataFrame([("A", "T", "new", t(2)), ("A", "U", "late", t(4)), ("B", "T", "first", t(1))], schema)
    assert sorted(listed(upsert_state(old, new), "source_folder", "table_name", "file_hash")) == [("A", "T", "new"), ("A", "U", "kept"), ("B", "T", "first")]


def test_replace_slice_also_empties(spark):
    rows = spark.createDataFrame([("A", "T", 1), ("A", "U", 2), ("B", "T", 3)], "_source_folder string, _source_table string, v int")
    assert sorted(listed(replace_slice(rows, rows.limit(0), "A", "T"), "v")) == [(2,), (3,)]


def test_evolution_adds_and_widens_but_never_drops(spark):
    old = spark.createDataFrame([], "a string, n decimal(18,2)").schema
    got = evolve(spark.createDataFrame([(Decimal("1.234"), 5)], "n decimal(18,3), b int"), old)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("a", "string"), ("n", "decimal(19,3)"), ("b", "int")]
    assert listed(got) == [(None, Decimal("1.234"), 5)]


# ---- checks ----------------------------------------------------------------------------


def test_reconciliation_shows_fan_out(spark):
    rows = dict(
        SALES1=[(A, i, money("7"), None, t, "1", None, None) for i, t in enumerate(("SI", "CN"))],
        SALES2=[(A, money("7"), "SI", "1", "i", money("1"), money("10"))],
    )
    lines = spark.createDataFrame(rows["SALES2"], SCHEMAS["SALES2"])
    assert listed(quality.revenue_reconciles(lines, ledger(spark, **rows)), "raw_amount", "fact_amount", "difference") == [(Decimal(10), Decimal(20), Decimal(10))]


def test_all_null_share(spark):
    rows = spark.createDataFrame([(A, "T", None, None), (A, "T", 1, None)], "_source_folder string, _source_table string, x int, y int")
    assert listed(quality.all_null_check(rows), "all_null_rows", "all_null_share") == [(1, 0.5)]


def test_sample_keeps_the_first_rows_per_folder(spark):
    rows = spark.createDataFrame([(f, i, str(i), None) for f in (A, B) for i in range(20)], "_source_folder string, _seq long, x string, y int")
    got = profile.sample_rows(rows, rows=3, fields=2).collect()
    assert sorted((r.source_folder, r.row_no, r.x, r.y) for r in got) == [(f, i + 1, str(i), "") for f in (A, B) for i in range(3)]
