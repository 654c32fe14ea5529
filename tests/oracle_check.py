"""Compare queries with their SQL twins: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    """Differences between both results, empty when equal."""
    df = query(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    theirs_columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(theirs_columns):
        return [f"columns {sorted(df.columns)} != {sorted(theirs_columns)}"]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = _rows(df.columns, ours), _rows(theirs_columns, theirs)
    if a != b:
        only_a, only_b = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        problems.append(f"values differ in {sorted(df.columns)}: ours {only_a} theirs {only_b}")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidebook.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "check",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, name, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(("FAIL" if problems else "ok  "), name, f"{time.time() - start:.2f}s", *[p[:1500] for p in problems], flush=True)
    print("failed", failed, "of", len(names))
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
