"""Run queries and their DuckDB counterparts side by side: python tests/compare.py [sf] [names…]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    db.execute("set timezone='UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return db


def cell(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return "∅" if value is None else str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, db, name, query, sql, folder):
    """(same, message)"""
    start = time.time()
    frame = query(spark, folder)
    got = bag(frame.columns, frame.collect())
    middle = time.time()
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    want = bag(columns, result.fetchall())
    times = f"spark {middle - start:.1f}s duckdb {time.time() - middle:.1f}s"
    if sorted(frame.columns) != sorted(columns):
        return False, f"{name}: columns {sorted(frame.columns)} / {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return False, f"{name}: rows {len(got)}/{len(want)} {times}\n  only spark {extra}\n  only duckdb {missing}"
    return True, f"{name}: {len(got)} rows equal, {times}"


def main():
    import __spark_entry__ as driver
    from cadenza.session import build_session

    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    oracles = driver.oracle_sql()
    names = sys.argv[2:] or list(driver.queries())
    bad = 0
    for name in names:
        query = driver.queries()[name]
        if name not in oracles:
            start = time.time()
            print(f"{name}: rows only, {len(query(spark, folder).collect())} rows, {time.time() - start:.1f}s")
            continue
        try:
            same, message = compare(spark, db, name, query, oracles[name], folder)
        except Exception as error:  # noqa: BLE001
            same, message = False, f"{name}: {type(error).__name__} {str(error)[:1500]}"
        bad += not same
        print(("ok   " if same else "FAIL ") + message, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
