"""Side-by-side check of ``queries()`` against ``oracle_sql()``.

Same idea as the driver's gate: row count, column names and types, and an
order-insensitive hash of the exact values (columns sorted by name).  Usable as a
script: ``python tests/compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from joblens.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


# Names of one type in both systems.
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def types_differ(spark_types: dict[str, str], duck_types: dict[str, str]) -> dict[str, tuple[str, str]]:
    """Columns whose types differ, as (Spark's, DuckDB's)."""
    return {c: (t, duck_types.get(c)) for c, t in spark_types.items() if DUCK_TYPES.get(t, t) != duck_types.get(c)}


def compare(spark, sf_dir: str, name: str, query, sql: str | None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_cols = df.columns
    t1 = time.time()
    out = {"name": name, "rows": len(rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = duck(sf_dir)
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rel.fetchall()
    out["oracle_rows"] = len(o_rows)
    out["cols_match"] = sorted(spark_cols) == sorted(o_cols)
    out["hash_match"] = digest(spark_cols, rows) == digest(o_cols, o_rows)
    out["types_differ"] = types_differ(dict(df.dtypes), dict(zip(o_cols, map(str, rel.types))))
    out["status"] = "ok" if (out["cols_match"] and not out["types_differ"] and out["hash_match"] and len(rows) == len(o_rows)) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"], out["oracle_cols"] = spark_cols, o_cols
    return out


def main(argv: list[str]) -> int:
    from joblens.session import build_session
    import __spark_entry__ as E

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(E.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    sqls = E.oracle_sql()
    bad = 0
    for n in names:
        try:
            res = compare(spark, sf_dir, n, E.queries()[n], sqls.get(n))
        except Exception as exc:  # report and continue
            res = {"name": n, "status": "ERROR", "error": str(exc)[:800]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
