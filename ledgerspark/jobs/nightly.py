"""Load, rebuild, check, publish: the stages of a nightly run, stopping at the first failure.

    spark-submit bin/nightly.py --root /lake/ledger --folder ZF2526=/data/ZF2526
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.jobs.load import LoadResult, load_sources
from ledgerspark.jobs.rebuild import Rebuild
from ledgerspark.jobs.store import Store, new_run
from ledgerspark.plans import views
from ledgerspark.plans.warehouse import Warehouse
from ledgerspark.session import recommended, ship_package
from ledgerspark.values import FOLDERS, INTERNAL_LEDGER_CODES

log = logging.getLogger(__name__)


class LoadFailed(RuntimeError):
    def __init__(self, results: list[LoadResult]):
        failed = [f"{r.source_folder}/{r.table_name}" for r in results if r.status == "error"]
        super().__init__(f"{len(failed)} table(s) failed to load: {', '.join(failed)}")
        self.results = results


def run_nightly(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, str],
    mode: str = "incremental",
    folders: tuple[str, ...] = FOLDERS,
    internal_codes: tuple[str, ...] = INTERNAL_LEDGER_CODES,
    match_type: bool = False,
    dedup: bool = True,
) -> DataFrame:
    """Run the stages in order; one row per stage with status and detail.

    A new warehouse version is published only after all of its tables are written and
    its reports resolve, so readers never see part of a rebuild. Partitions whose inputs
    are as in the version before are taken over; ``mode="full"`` loads and builds all.
    """
    store, version = Store(spark, root), new_run()
    rebuild: list[Rebuild] = []

    def load() -> str:
        results = load_sources(spark, root, sources, mode, dedup=dedup)
        if any(r.status == "error" for r in results):
            raise LoadFailed(results)
        counts = {s: sum(r.status == s for r in results) for s in ("success", "skipped")}
        repeats = sum(r.duplicates for r in results)
        return f"synced {counts['success']}, skipped {counts['skipped']}, rows {sum(r.rows for r in results)}, repeats left out {repeats}"

    def dimensions() -> str:
        made = Rebuild(store, version, store.slices(), None if mode == "full" else store.newest_version())
        made.dimensions(Warehouse.from_raw(spark, made.raw, folders, internal_codes), internal_codes)
        rejected = made.rejects()
        rebuild.append(made)
        return f"{version}, rows without a code: " + ", ".join(f"{name} {n}" for name, n in rejected.items())

    def facts() -> str:
        (made,) = rebuild
        made.facts(match_type=match_type)
        made.record()
        return f"{version}, partitions written {made.written}, taken over {made.kept}"

    def reports() -> str:
        built = store.warehouse(version, folders)
        ready = [view(built).columns for view in REPORTS]
        store.publish(version)
        store.compact_records()
        return f"{len(ready)} reports"

    stages = (("load", load), ("dimensions", dimensions), ("facts", facts), ("reports", reports))
    done, failed = [], False
    for name, stage in stages:
        if failed:
            done.append((name, "not run", None))
            continue
        try:
            done.append((name, "ok", stage()))
        except Exception as problem:
            log.exception("stage %s failed", name)
            done.append((name, "failed", str(problem)))
            failed = True
    return spark.createDataFrame(done, "stage string, status string, detail string")


REPORTS = (
    views.sales_summary,
    views.today_sales,
    views.monthly_sales,
    views.top_customers,
    views.top_products,
    views.slow_moving,
    views.outstanding_receivables,
    views.cash_flow,
    views.customer_ltv,
    views.company_overview,
)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="directory for raw tables, warehouse and load records")
    parser.add_argument("--folder", action="append", required=True, metavar="CODE=PATH")
    parser.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    parser.add_argument("--internal-code", action="append", metavar="CODE", help="ledger code of an internal account; replaces the built-in ones")
    parser.add_argument("--match-type", action="store_true", help="lines meet headers of their own type only")
    parser.add_argument("--keep-repeats", action="store_true", help="load records that repeat another one, too")
    given = parser.parse_args(args)
    pairs = (pair.split("=", 1) for pair in given.folder)
    sources = {code.upper(): path for code, path in pairs}
    spark = recommended(SparkSession.builder.appName("ledger nightly")).getOrCreate()
    ship_package(spark)
    codes = tuple(given.internal_code or INTERNAL_LEDGER_CODES)
    outcome = run_nightly(spark, given.root, sources, given.mode, tuple(sources), codes, given.match_type, not given.keep_repeats)
    outcome.show(truncate=False)
    return 2 if outcome.filter("status = 'failed'").count() else 0


if __name__ == "__main__":
    raise SystemExit(main())
