"""Times headline queries from raw tables, a warehouse build, and every report on the
stored warehouse, which is how reports run in production.

Prints one JSON line. A query's time is the median of BENCH_REPEATS runs (3) after one
warm-up run, whole result computed and discarded. BENCH_QUERIES names other registered
queries to time instead, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.jobs.rebuild import Rebuild  # noqa: E402
from ledgerspark.jobs.store import Store, new_run  # noqa: E402
from ledgerspark.session import local_session  # noqa: E402
from verification.ledger_data import LedgerData  # noqa: E402
from verification.registry import OVER_WAREHOUSE, queries_by_name  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
CHOSEN = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

HEADLINES = (
    "dbf_scan clean_text exact_dedup row_hash changed_files dim_customer dim_product fact_sales fact_sales_header "
    "fact_finance fact_receivables sales_summary today_sales monthly_sales top_customers top_products slow_moving "
    "outstanding_receivables cash_flow customer_ltv company_overview kpi_totals table_summary check_revenue_reconciles"
).split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, repeats: int = REPEATS) -> float:
    action()
    spent = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent), 4)


def main() -> None:
    spark = local_session(CPUS, "bench")
    times: dict[str, float] = {}
    registered = queries_by_name()
    for name in list(registered) if CHOSEN == ["all"] else CHOSEN or HEADLINES:
        times[name] = timed(lambda: run(registered[name](spark, SF_DIR)))

    if not CHOSEN or CHOSEN == ["all"]:
        data, store = LedgerData(spark, SF_DIR), Store(spark, tempfile.mkdtemp(prefix="run-"))
        version = new_run()
        start = time.perf_counter()
        built = data.warehouse()
        rebuild = Rebuild(store, version, raw=data)
        rebuild.dimensions(built)
        rebuild.facts()
        rebuild.record()
        times["build_warehouse"] = round(time.perf_counter() - start, 4)
        stored = store.warehouse(version)
        for name, query in OVER_WAREHOUSE.items():
            if not name.startswith(("dim_", "fact_")):
                times[f"stored.{name}"] = timed(lambda: run(query(stored)))

    print(
        json.dumps(
            {
                "metric": "total seconds of all queries, median of runs after a warm-up",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "repeats": REPEATS,
            }
        )
    )


if __name__ == "__main__":
    main()
