"""Run a registered query and its oracle side by side."""

from __future__ import annotations

import math
import os
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


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs. Values must match exactly."""
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle has {len(want)}"
    for g, w in zip(got, want):
        for name, a, b in zip(sorted(names), g, w):
            if type(a) is not type(b) and a is not None and b is not None:
                return f"{name}: type {type(a).__name__} {a!r} != {type(b).__name__} {b!r}"
            if a != b:
                return f"{name}: {a!r} != {b!r} in {g} / {w}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from kpiloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    # COMPARE_CONF="key=value ..." tries other settings, such as no broadcasts.
    extra = dict(pair.split("=", 1) for pair in os.environ.get("COMPARE_CONF", "").split())
    spark = local_session("compare", 8, **extra)
    connection = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if argv and not any(a in name for a in argv):
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in oracle:
                outcome = compare(frame, connection, oracle[name])
                rows = len(connection.execute(oracle[name]).fetchall())
            else:
                rows, outcome = frame.count(), None
        except Exception as error:  # noqa: BLE001
            rows, outcome = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += outcome is not None
        mark = "ok  " if outcome is None else "FAIL"
        print(f"{mark} {name} rows={rows} {time.time() - start:.2f}s {outcome or ''}{'' if name in oracle else ' (no oracle)'}", flush=True)
    missing = set(oracle) - set(queries)
    if missing:
        print("oracle without query:", sorted(missing))
    print("failures:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
