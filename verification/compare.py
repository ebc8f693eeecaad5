"""Run registered queries next to their SQL in DuckDB and compare whole results.

    python -m verification.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracle import oracle_sql
from verification.registry import queries_by_name

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "to_pydatetime"):
        value = value.to_pydatetime()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None if the results agree, else what differs; queries without SQL only have to run."""
    df = queries_by_name()[name](spark, sf_dir)
    mine = df.collect()
    sql = oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = result.fetchall()
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, wanted: list[str]) -> int:
    from ledgerspark.session import local_session

    spark, con, failed = local_session(), connect(sf_dir), 0
    for name in wanted or queries_by_name():
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
