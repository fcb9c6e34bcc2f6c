"""Runs registered queries beside their SQL and compares whole results. Usage: check.py [sf] [key ...]"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

ROOT = "/root/testdata"


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, queries, oracles, key, sf):
    folder = f"{ROOT}/sf{sf}"
    started = time.time()
    frame = queries[key](spark, folder)
    columns, left = rows_of(frame.columns, frame.collect())
    took = time.time() - started
    total = sum(left.values())
    if key not in oracles:
        return total, took, None
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(oracles[key])
    names = [d[0] for d in result.description]
    other_columns, right = rows_of(names, result.fetchall())
    if columns != other_columns:
        return total, took, f"columns {columns} != {other_columns}"
    if left != right:
        extra, lacking = left - right, right - left
        return total, took, f"rows {total} vs {sum(right.values())}\n   only spark: {list(extra)[:3]}\n   only sql:   {list(lacking)[:3]}"
    return total, took, ""


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries

    from folioframe.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    q, o = queries(), oracle_sql()
    keys = sys.argv[2:] or list(q)
    bad = 0
    for key in keys:
        try:
            total, took, problem = compare(spark, q, o, key, sf)
        except Exception as error:
            total, took, problem = 0, 0.0, "".join(traceback.format_exception_only(error))[:1500]
        bad += bool(problem)
        state = "rows-only" if problem is None else ("FAIL " + problem if problem else "ok")
        print(f"{key:28} {total:8} {took:6.2f}s {state}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
