"""Reports on skewed random ledgers against a plain Python computation.

One customer, one item and one invoice number each hold about a third of the lines.
"""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from ledgerspark.plans import quality, queries, views
from ledgerspark.values import INTERNAL_LEDGER_CODES
from tests.ledgers import SCHEMAS, ledger

FOLDERS = ("ZF2526", "ZF2627")
CODES = ["1", "2", "3", "4", "26", "CSTK", "gone"]
ITEMS = ["a", "b", "c", "d", "lost"]


def pick(rng, hot, others):
    return hot if rng.random() < 1 / 3 else rng.choice(others)


def random_ledger(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    start = date(2025, 1, 1)
    cents = lambda: rng.choice([None, Decimal(rng.randint(-5000, 5000)) / 100])
    master = [
        (f, i, c, f"name {c}", None, cents(), rng.choice([None, Decimal(0), Decimal(10)]))
        for f in FOLDERS
        for i, c in enumerate(CODES[:-1] + ["1", "3"])
    ]
    item = [(f, i, c, f"item {c}", "g", None, None) for f in FOLDERS for i, c in enumerate(ITEMS[:-1] + ["never"])]
    sales1 = [
        (f, i, rng.choice([None, *map(Decimal, range(1, 30))]), rng.choice([None, start + timedelta(rng.randint(0, 120))]), rng.choice(["SI", "CN", None]), rng.choice(CODES), cents(), None)
        for f in FOLDERS
        for i in range(30)
    ]
    sales2 = [
        (rng.choice(FOLDERS), pick(rng, Decimal(7), [None, *map(Decimal, range(1, 40))]), "SI", pick(rng, "2", [None, *CODES]), pick(rng, "c", ITEMS), Decimal(rng.randint(1, 9)), cents())
        for _ in range(400)
    ]
    return {"MASTER": master, "ITEM": item, "SALES1": sales1, "SALES2": sales2}


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


class Expected:
    """The star schema by nested loops."""

    def __init__(self, raw):
        self.customers, self.products = {}, {}
        for f, _, code, name, _, balance, limit in sorted(raw["MASTER"], key=lambda r: r[1]):
            self.customers.setdefault((f, code), (name, balance, limit))
        for f, _, code, name, *_ in sorted(raw["ITEM"], key=lambda r: r[1]):
            self.products.setdefault((f, code), name)
        self.lines = []
        for f, no, _, cust, item, qty, amount in raw["SALES2"]:
            dates = [h[3] for h in raw["SALES1"] if h[0] == f and h[2] is not None and h[2] == no] or [None]
            for day in dates:
                self.lines.append((f, no, day, cust if (f, cust) in self.customers else None, item if (f, item) in self.products else None, qty, amount))
        self.external = [x for x in self.lines if x[3] is not None and x[3] not in INTERNAL_LEDGER_CODES]

    def grouped(self, lines, key):
        groups = defaultdict(list)
        for x in lines:
            groups[key(x)].append(x)
        return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_equal_nested_loops(spark, seed):
    raw = random_ledger(seed)
    wh, want = ledger(spark, **raw), Expected(raw)
    invoices = lambda g: len({x[1] for x in g if x[1] is not None})

    by_customer = want.grouped(want.external, lambda x: (x[0], x[3]))
    got = {(r.source_folder, r.ledger_code): (r.invoice_count, r.total_purchases, r.outstanding_balance, r.last_purchase_date) for r in views.top_customers(wh).collect()}
    assert got == {k: (invoices(g), total(x[6] for x in g), want.customers[k][1], max((x[2] for x in g if x[2]), default=None)) for k, g in by_customer.items()}

    best = [(r.source_folder, r.ledger_code) for r in queries.top_customers(wh, limit=3).collect()]
    order = sorted(by_customer, key=lambda k: ((t := total(x[6] for x in by_customer[k])) is not None, -(t or 0), k))
    assert best == order[:3]

    by_item = want.grouped([x for x in want.lines if x[4]], lambda x: (x[0], x[4]))
    got = {(r.source_folder, r.item_code): (r.total_qty_sold, r.total_revenue, r.times_ordered) for r in views.top_products(wh).collect()}
    assert got == {k: (total(x[5] for x in g), total(x[6] for x in g), invoices(g)) for k, g in by_item.items()}

    by_day = want.grouped([x for x in want.external if x[2]], lambda x: (x[0], x[2]))
    got = {(r.source_folder, r.invoice_date): (r.invoice_count, r.total_sales, r.total_qty) for r in views.sales_summary(wh).collect()}
    assert got == {k: (invoices(g), total(x[6] for x in g), total(x[5] for x in g)) for k, g in by_day.items()}

    as_of = date(2025, 5, 15)
    got = {(r.source_folder, r.item_code): r.days_since_last_sale for r in views.slow_moving(wh, as_of).collect()}
    last = {k: max((x[2] for x in by_item.get(k, []) if x[2]), default=None) for k in want.products}
    assert got == {k: d and (as_of - d).days for k, d in last.items() if d is None or (as_of - d).days > 90}

    by_folder = want.grouped(want.external, lambda x: x[0])
    owed = lambda f: total(b for (g, c), (_, b, _) in want.customers.items() if g == f and b is not None and b > 0 and c not in INTERNAL_LEDGER_CODES)
    got = {r.source_folder: (r.total_invoices, r.total_revenue, r.active_customers, r.total_receivables) for r in views.company_overview(wh).collect()}
    assert got == {f: (invoices(g), total(x[6] for x in g), len({x[3] for x in g}), owed(f)) for f, g in by_folder.items()}


@pytest.mark.parametrize("seed", [3])
def test_fact_amount_is_raw_amount_times_matching_headers(spark, seed):
    raw = random_ledger(seed)
    wh = ledger(spark, **raw)
    copies = lambda f, no: max(1, sum(h[0] == f and h[2] == no for h in raw["SALES1"])) if no is not None else 1
    want = {f: sum(a * copies(f, no) for g, no, _, _, _, _, a in raw["SALES2"] if g == f and a is not None) for f in FOLDERS}
    lines = spark.createDataFrame(raw["SALES2"], SCHEMAS["SALES2"])
    assert {r.source_folder: r.fact_amount for r in quality.revenue_reconciles(lines, wh).collect()} == want
