"""Compare registered Spark queries with their oracle SQL: python tests/check_oracle.py [sf] [prefix ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def normal(value):
    if isinstance(value, float):
        if value != value:
            return None
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    from acrewise.fixtures import TABLES

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str:
    """Empty text when both sides give the same rows, else the first difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = sorted((tuple(normal(row[i]) for i in at) for row in cur.fetchall()), key=repr)
    have = sorted((tuple(normal(v) for v in row) for row in df.select(*[f"`{n}`" for n in order]).collect()), key=repr)
    if len(want) != len(have):
        return f"rows {len(have)} != {len(want)}"
    bad = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
    return f"{len(bad)} rows differ, first spark={bad[0][0]} oracle={bad[0][1]}" if bad else ""


def main(argv: list[str]) -> int:
    from acrewise.queries import ORACLES, QUERIES
    from acrewise.session import build_session

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.001'}"
    prefixes = tuple(argv[1:])
    spark = build_session()
    con = connect(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
                status = "ok" if not problem else f"DIFF {problem}"
            else:
                status = f"rows-only {df.count()}"
        except Exception as exc:
            status = f"FAIL {type(exc).__name__} {str(exc)[:900]}"
        failed += status.startswith(("DIFF", "FAIL"))
        print(f"{name:34s} {time.time() - start:6.1f}s {status}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
