"""Incremental loads, rebuilds and the nightly run on small xBase files."""

import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest

from ledgerspark.jobs import load, nightly
from ledgerspark.jobs.store import Store
from ledgerspark.plans import quality, queries, views
from tests.dbf_files import write

A, B = "ZF2526", "ZF2627"
MASTER = [("CODECbG", "C", 6, 0), ("DESCCbG", "C", 20, 0), ("GROUPCDbG", "C", 6, 0), ("STATECODE", "C", 2, 0), ("PLACE_CDbG", "C", 4, 0), ("MOBILENO", "C", 10, 0), ("OPBALCbG", "N", 12, 2), ("BALANCEbG", "N", 12, 2), ("CRELIMITbG", "N", 12, 2), ("APGSTTbG", "C", 15, 0)]
ITEM = [("ITEMCODE", "C", 6, 0), ("DESC", "C", 20, 0), ("ITEMGROUP", "C", 6, 0), ("UOM", "C", 4, 0), ("HSNCODE", "C", 8, 0), ("VALUATION", "C", 4, 0), ("ITEMRATE", "N", 10, 2), ("OPBALQTY", "N", 10, 3), ("OPBALVAL", "N", 12, 2), ("IS_SERVICE", "L", 1, 0)]
SALES1 = [("INVNOEbG", "N", 8, 0), ("INVDATEbG", "D", 8, 0), ("INVTYPEbG", "C", 2, 0), ("CUSCODEbG", "C", 6, 0), ("BILLAMTG", "N", 12, 2), ("TAXAMTNG", "N", 12, 2), ("ROUNDOFFG", "N", 8, 2), ("TOTALIONG", "N", 12, 2), ("TRANSPORTG", "C", 10, 0), ("DUEDAYSG", "N", 5, 1)]
SALES2 = [("INVNO", "N", 8, 0), ("INVTYPE", "C", 2, 0), ("CUSCODE", "C", 6, 0), ("ITEMCODE", "C", 6, 0), ("REPCODE", "C", 4, 0), ("QTY", "N", 10, 3), ("ITEMRATE", "N", 10, 2), ("DISCOUNT", "N", 6, 2), ("DISAMT", "N", 10, 2), ("AMOUNT", "N", 12, 2), ("BATCHNO", "C", 8, 0)]
TRANS = [("VOUNOE", "N", 8, 0), ("VOUDATE", "D", 8, 0), ("CODEE", "C", 6, 0), ("NARATION", "C", 20, 0), ("DRCRATE", "C", 1, 0), ("VOU_AMT", "N", 12, 2), ("REPCODE", "C", 4, 0)]
BILLADJ = [("VOUNO", "N", 8, 0), ("VOUDATE", "D", 8, 0), ("CUSCODE", "C", 6, 0), ("VOU_AMT", "N", 12, 2), ("BILLADJ", "N", 12, 2), ("BILLAMT", "N", 12, 2), ("INVNO", "N", 8, 0)]


def line(no="7", cust="11", item="i1", amount="30.00"):
    return (" ", no, "SI", cust, item, "r", "2.000", "15.00", "0.00", "0.00", amount, "b")


def write_folder(path, lines=None):
    write(path / "MASTER.DBF", MASTER, [(" ", "11", "Acme", "AS1", "29", "BLR", "99", "0.00", "80.00", "50.00", "GST"), (" ", "26", "Cash", "AS1", "", "", "", "0.00", "9.00", "", "")])
    write(path / "ITEM.DBF", ITEM, [(" ", "i1", "Bolt", "hw", "PCS", "7318", "FIFO", "15.00", "5.000", "75.00", "F"), (" ", "i2", "Fitting", "sv", "HR", "", "", "1.00", "", "", "T")])
    write(path / "SALES1.DBF", SALES1, [(" ", "7", "20250410", "SI", "11", "27.00", "3.00", "0.00", "30.00", "road", "30.5")])
    write(path / "SALES2.DBF", SALES2, lines or [line(), line(), line(amount="12.00"), line(cust="26", amount="5.00")])
    write(path / "TRANS.DBF", TRANS, [(" ", "1", "20250411", "11", "paid", "C", "10.00", "r"), (" ", "2", "20250411", "26", "cash", "D", "4.00", "r")])
    write(path / "BILLADJ.DBF", BILLADJ, [(" ", "1", "20250411", "11", "10.00", "10.00", "30.00", "7")])


@pytest.fixture
def places(tmp_path):
    sources = {f: str(tmp_path / "in" / f) for f in (A, B)}
    for folder in sources:
        write_folder(tmp_path / "in" / folder)
    return str(tmp_path / "lake"), sources, tmp_path / "in"


def statuses(results):
    return sorted((r.source_folder, r.table_name, r.status) for r in results)


def test_only_changed_files_are_loaded_again(spark, places):
    root, sources, base = places
    first = load.load_sources(spark, root, sources)
    assert {r.status for r in first} == {"success"} and len(first) == 12
    assert {(r.rows, r.duplicates) for r in first if r.table_name == "SALES2"} == {(3, 1)}
    assert [tuple(r) for r in load.summary(spark, first).collect()] == [(12, 0, 0, sum(r.rows for r in first))]

    assert {r.status for r in load.load_sources(spark, root, sources)} == {"skipped"}

    write_folder(base / A, [line(amount="99.00")])
    again = load.load_sources(spark, root, sources)
    assert [(r.source_folder, r.table_name) for r in again if r.status == "success"] == [(A, "SALES2")]
    store = Store(spark, root)
    amounts = sorted((r._source_folder, r.amount) for r in store.raw("SALES2").collect())
    assert amounts == [(A, Decimal("99.00")), (B, Decimal("5.00")), (B, Decimal("12.00")), (B, Decimal("30.00"))]
    assert {r.row_count for r in store.file_state().filter("table_name = 'SALES2'").collect()} == {1, 3}
    log = quality.sync_history(store.sync_log()).collect()
    assert len(log) == 13 and {r.status for r in log} == {"success"} and log[0].table_name == "SALES2"


def test_full_mode_and_single_table(spark, places):
    root, sources, _ = places
    load.load_sources(spark, root, sources, only_table="item")
    assert statuses(load.load_sources(spark, root, sources, mode="full", only_table="ITEM")) == [(A, "ITEM", "success"), (B, "ITEM", "success")]
    with pytest.raises(LookupError):
        load.load_sources(spark, root, sources, only_table="nope")


def test_a_failing_file_is_logged_and_leaves_its_old_data(spark, places):
    root, sources, base = places
    load.load_sources(spark, root, sources, only_table="ITEM")
    (base / A / "ITEM.DBF").write_bytes(b"broken")
    results = load.load_sources(spark, root, sources, only_table="ITEM")
    assert statuses(results) == [(A, "ITEM", "error"), (B, "ITEM", "skipped")]
    store = Store(spark, root)
    assert store.raw("ITEM").count() == 4
    assert [r.error_msg for r in store.sync_log().filter("status = 'error'").collect()][0].endswith("declares no fields")
    # the state still holds the old hash, so the next run tries again
    assert statuses(load.load_sources(spark, root, sources, only_table="ITEM"))[0] == (A, "ITEM", "error")


def test_columns_are_added_and_never_removed(spark, places):
    root, sources, base = places
    load.load_sources(spark, root, sources, only_table="ITEM")
    write(base / A / "ITEM.DBF", [f for f in ITEM if f[0] != "UOM"] + [("COLOUR", "C", 5, 0)], [(" ", "i1", "Bolt", "hw", "7318", "FIFO", "15.00", "5.000", "75.00", "F", "red")])
    load.load_sources(spark, root, sources, only_table="ITEM")
    items = Store(spark, root).raw("ITEM")
    assert {(r._source_folder, r.uom, r.colour) for r in items.filter("itemcode = 'i1'").collect()} == {(A, None, "red"), (B, "PCS", None)}


def test_an_emptied_file_empties_its_slice(spark, places):
    root, sources, base = places
    load.load_sources(spark, root, sources, only_table="ITEM")
    write(base / A / "ITEM.DBF", ITEM, [])
    load.load_sources(spark, root, sources, only_table="ITEM")
    assert {r._source_folder for r in Store(spark, root).raw("ITEM").collect()} == {B}


def test_nightly_builds_a_warehouse_that_reports_read(spark, places):
    root, sources, base = places
    stages = nightly.run_nightly(spark, root, sources).collect()
    assert [(s.stage, s.status) for s in stages] == [(s, "ok") for s in ("load", "dimensions", "facts", "reports")]
    wh = Store(spark, root).warehouse()
    assert {r.source_folder: r.total_revenue for r in views.company_overview(wh).collect()} == {A: Decimal("42.00"), B: Decimal("42.00")}
    assert queries.sales_summary(wh, A, "2025-04-10", "2025-04-10").count() == 1
    assert queries.sales_summary(wh, A, "2025-05-01").count() == 0
    assert queries.inventory_items(wh, A).filter("is_service").count() == 1
    assert [r.due_days for r in queries.invoice_header(wh, "7", A).collect()] == [31]
    assert {r.table_name: r.rows for r in quality.row_counts(wh).collect()}["dim_date"] == 4018
    assert "_month" not in wh.fact_sales.columns

    before = Store(spark, root).versions().count()
    (base / B / "TRANS.DBF").write_bytes(b"broken")
    stages = nightly.run_nightly(spark, root, sources).collect()
    assert [(s.stage, s.status) for s in stages] == [("load", "failed")] + [(s, "not run") for s in ("dimensions", "facts", "reports")]
    assert Store(spark, root).versions().count() == before


def test_folder_and_month_prune_stored_partitions(spark, places):
    root, sources, _ = places
    nightly.run_nightly(spark, root, sources)
    wh = Store(spark, root).warehouse()
    plan = queries.sales_summary(wh, A, "2025-04-01", "2025-04-30")._jdf.queryExecution().executedPlan().toString()
    fact = next(part for part in plan.splitlines() if "invoice_date" in part and "FileScan" in part)
    filters = fact[fact.index("PartitionFilters") : fact.index("PushedFilters")]
    assert f"= {A}" in filters and "_month" in filters
    raw = Store(spark, root).raw("SALES2").filter(f"_source_folder = '{A}'")
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_numbers_are_stored_as_they_are(spark, places):
    root, sources, base = places
    wide = [(n, c, 16, 4) if n in ("AMOUNT", "ITEMRATE") else (n, c, w, d) for n, c, w, d in SALES2]
    one = list(line())
    one[7], one[10] = "1.2345", "10.005"
    write(base / A / "SALES2.DBF", wide, [tuple(one)])
    assert {s.status for s in nightly.run_nightly(spark, root, sources).collect()} == {"ok"}
    wh = Store(spark, root).warehouse()
    stored = wh.fact_sales.filter(f"source_folder = '{A}'").first()
    assert (stored.rate, stored.line_amount) == (Decimal("1.2345"), Decimal("10.005"))
    checked = quality.revenue_reconciles(Store(spark, root).raw("SALES2"), wh).collect()
    assert {r.difference for r in checked} == {0}


def test_rows_without_a_code_are_written_as_rejects(spark, places):
    root, sources, base = places
    write(base / A / "ITEM.DBF", ITEM, [(" ", "", "Nameless", "hw", "PCS", "7318", "FIFO", "15.00", "5.000", "75.00", "F")])
    stages = {s.stage: s.detail for s in nightly.run_nightly(spark, root, sources).collect()}
    assert "dim_customer 0" in stages["dimensions"] and "dim_product 1" in stages["dimensions"]
    version = stages["facts"].split(",")[0]
    rejected = spark.read.parquet(f"{root}/warehouse/dim_product_rejects/_version={version}").collect()
    assert [(r._source_folder, r.desc) for r in rejected] == [(A, "Nameless")]


def test_repeats_can_be_kept(spark, places):
    root, sources, _ = places
    kept = nightly.run_nightly(spark, root, sources, dedup=False).collect()[0].detail
    assert kept.endswith("repeats left out 0") and Store(spark, root).raw("SALES2").count() == 8


def test_dropped_repeats_are_logged(spark, places):
    root, sources, _ = places
    load.load_sources(spark, root, sources, only_table="SALES2")
    log = Store(spark, root).sync_log().filter("status = 'success'").collect()
    assert [r.duplicates_skipped for r in log] == [1, 1]


def test_the_start_script_works_from_anywhere(places, tmp_path):
    root, sources, base = places
    script = Path(__file__).parents[1] / "bin" / "nightly.py"
    command = [sys.executable, str(script), "--root", root, "--match-type", "--internal-code", "26"]
    command += [x for f, p in sources.items() for x in ("--folder", f"{f.lower()}={p}")]
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = lambda: subprocess.run(command, cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    done = run()
    assert done.returncode == 0, done.stderr[-3000:]
    (base / B / "TRANS.DBF").write_bytes(b"broken")
    assert run().returncode == 2
