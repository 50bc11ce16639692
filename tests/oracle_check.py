"""Compare registered queries with their SQL in DuckDB.

``python tests/oracle_check.py sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for t in TABLES.split():
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def kinds_of(rows):
    """Python type per column, where a value shows it."""
    out = {}
    for r in rows:
        for i, v in enumerate(r):
            if v is not None:
                out.setdefault(i, type(v).__name__)
        if rows and len(out) == len(rows[0]):
            break
    return out


def compare(df, db, sql):
    """(ok, message) for a Spark frame against a DuckDB query."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.sql(sql)
    right = rows_of(result.columns, result.fetchall())
    if sorted(df.columns) != sorted(result.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    if left == right:
        a, b = kinds_of(left), kinds_of(right)
        if a != b:
            return False, f"types differ {a} {b}"
        return True, f"{len(left)} rows"
    extra = [r for r in left if r not in set(right)][:2]
    lacking = [r for r in right if r not in set(left)][:2]
    return False, f"{len(left)} vs {len(right)} rows; only spark {extra}; only duckdb {lacking}"


def main():
    from aerocast.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            ok, note = compare(df, db, sql[name]) if name in sql else (df.count() > 0, "no SQL")
        except Exception as problem:
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failures:", bad, "| SQL without query:", sorted(set(sql) - set(queries())))


if __name__ == "__main__":
    main()
