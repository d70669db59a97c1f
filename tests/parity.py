"""Run catalogue queries in Spark and their check SQL in DuckDB and compare the rows.

``python tests/parity.py [sf] [name …]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normalized(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def compare(spark, con, sf_dir: str, query, sql: str | None) -> tuple[bool, str]:
    started = time.time()
    frame = query(spark, sf_dir)
    spark_rows = [tuple(r) for r in frame.collect()]
    if sql is None:
        return len(spark_rows) > 0, f"spark {time.time() - started:.1f}s {len(spark_rows)} rows, no check SQL"
    middle = time.time()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    spent = f"spark {middle - started:.1f}s sql {time.time() - middle:.1f}s"
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    left, right = normalized(frame.columns, spark_rows), normalized(columns, sql_rows)
    if left == right:
        return True, f"{spent} {len(left)} rows equal"
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return False, f"{len(left)} vs {len(right)} rows\n    spark {only_left}\n    sql   {only_right}"


def main() -> int:
    from corpuslens.session import local_session

    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"{DATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    checks, failures = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        try:
            good, note = compare(spark, con, sf_dir, query, checks.get(name))
        except Exception as problem:  # report and go on with the next query
            good, note = False, f"{type(problem).__name__}: {str(problem)[:1200]}"
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {note}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    raise SystemExit(main())
