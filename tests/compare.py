"""Run registered queries against their DuckDB SQL: python tests/compare.py SF_DIR [names...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return int(value) if float(value) == int(value) else float(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(db, sql):
    done = db.execute(sql)
    return canonical([c[0] for c in done.description], done.fetchall())


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from turnmill.session import local_session

    spark, db = local_session(), connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        got = spark_result(build(spark, sf_dir))
        took = time.time() - start
        if name not in oracle:
            print(f"{name:32s} {len(got[1]):6d} rows  {took:5.1f}s  no oracle")
            continue
        want = duckdb_result(db, oracle[name])
        same = got == want
        bad += not same
        print(f"{name:32s} {len(got[1]):6d} rows  {took:5.1f}s  {'ok' if same else 'DIFFERS'}")
        if not same:
            print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            print("   spark only ", [r for r in got[1] if r not in set(want[1])][:3])
            print("   duckdb only", [r for r in want[1] if r not in set(got[1])][:3])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
