"""SNK4 against a database: keyed upsert of report rows over JDBC.

Spark does the per-key work (latest version per key, DOM10) and bulk-writes
the result into a staging table; the database then applies it with one
set-based statement, newest version winning, so a replayed or late batch
cannot overwrite newer rows.  Connection details come from the caller.

Not exercised in this environment (no database may be started here); the
statement text is unit-tested.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..operators.upsert import latest_per_key


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def merge_sql(table: str, staging: str, keys: list[str], columns: list[str], version: str) -> str:
    """Standard ``MERGE`` (SQL:2003; PostgreSQL 15+, Derby, SQL Server...)."""
    on = " AND ".join(f"t.{_q(k)} IS NOT DISTINCT FROM s.{_q(k)}" for k in keys)
    updates = ", ".join(f"{_q(c)} = s.{_q(c)}" for c in columns if c not in keys)
    cols = ", ".join(_q(c) for c in columns)
    vals = ", ".join(f"s.{_q(c)}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {staging} s ON ({on}) "
        f"WHEN MATCHED AND t.{_q(version)} <= s.{_q(version)} THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    )


def on_conflict_sql(table: str, staging: str, keys: list[str], columns: list[str], version: str) -> str:
    """PostgreSQL ``INSERT ... ON CONFLICT`` form (needs a unique key on ``keys``)."""
    cols = ", ".join(_q(c) for c in columns)
    updates = ", ".join(f"{_q(c)} = EXCLUDED.{_q(c)}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} "
        f"ON CONFLICT ({', '.join(_q(k) for k in keys)}) DO UPDATE SET {updates} "
        f"WHERE {table}.{_q(version)} <= EXCLUDED.{_q(version)}"
    )


def upsert_jdbc(
    updates: DataFrame,
    url: str,
    table: str,
    keys: list[str],
    version: str,
    properties: dict | None = None,
    staging: str | None = None,
    dialect: str = "merge",
) -> None:
    """Latest row per key -> staging table (overwrite) -> one MERGE."""
    props = dict(properties or {})
    staging = staging or f"{table}_staging_{uuid.uuid4().hex[:8]}"  # writers never share one
    rows = latest_per_key(updates, keys, version)
    rows.write.mode("overwrite").jdbc(url, staging, properties=props)
    sql = (merge_sql if dialect == "merge" else on_conflict_sql)(table, staging, keys, rows.columns, version)
    jvm = updates.sparkSession.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        stmt.executeUpdate(sql)
        conn.commit()
        stmt.close()
    finally:
        conn.close()
