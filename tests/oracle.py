"""Spark-vs-DuckDB comparison used by the tests and runnable as a script.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values with columns sorted by name.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(rows), names, hashlib.sha256("\n".join(lines).encode()).hexdigest()


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _types(names, types) -> str:
    return ",".join(f"{n}:{t}" for n, t in sorted(zip(names, types)))


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
    return digest(df.columns, rows) + (_types(df.columns, types),)


def duck_digest(con, sql: str):
    rel = con.sql(sql)
    return digest(list(rel.columns), rel.fetchall()) + (_types(rel.columns, [str(t) for t in rel.types]),)


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as entry

    queries = entry.queries()
    oracle = entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or queries:
        t0 = time.time()
        try:
            s = spark_digest(queries[name](spark, sf_dir))
            err = None
        except Exception as exc:  # noqa: BLE001 - report and continue
            s, err = None, f"{type(exc).__name__}: {exc}"[:400]
        secs = time.time() - t0
        o = duck_digest(con, oracle[name]) if name in oracle else None
        ok = s is not None and (o is None or s == o)
        results[name] = {"ok": ok, "spark": s, "oracle": o, "error": err, "sec": round(secs, 2)}
        if verbose:
            status = "OK " if ok else "BAD"
            detail = err or ("" if ok else f"spark={s[:2] if s else None} oracle={o[:2] if o else None}")
            print(f"{status} {name:32s} {secs:6.2f}s rows={s[0] if s else '-'} {detail}", flush=True)
    return results


if __name__ == "__main__":
    from faceoff.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v["ok"]]
    print(f"{len(res) - len(bad)}/{len(res)} match; bad: {bad}")
