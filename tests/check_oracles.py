"""Compare registered queries with their SQL: python tests/check_oracles.py SF_DIR [name …]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from catalog.fixtures import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when rows and columns agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=_key)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows"
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    if sorted(theirs_columns) != columns:
        return f"columns {columns} vs {sorted(theirs_columns)}"
    pick = [theirs_columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in pick) for r in result.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(columns, a))} vs {b}"
    return None


def main(sf_dir: str, wanted: list[str]) -> int:
    from latentspark.session import build_session

    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in wanted or list(contract.queries()):
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "oracle" if name in contract.oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {kind:6} {name} {problem or ''}",
              flush=True)
    print(f"{bad} of {len(wanted or contract.queries())} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
