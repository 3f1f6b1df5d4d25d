"""Keyed report tables with an ordered, idempotent upsert (SNK4).

Layout: ``<path>/snap=<seq>-v<version>[-w<writer>]/`` holds a complete copy
of the table after applying update batch ``version`` of ``writer`` (a
streaming query's id, so a stream restarted on a new checkpoint, whose batch
ids start again at 0, is not mistaken for a replay); a snapshot counts once
Spark's commit wrote its ``_SUCCESS`` marker.  An upsert reads the newest
complete snapshot, merges the update batch with DOM10 (latest row version
per key wins) and writes snapshot ``seq + 1``.  Hence

* a crash mid-write leaves no marker, so readers keep the previous snapshot;
* replaying a micro-batch whose snapshot exists is a no-op (exactly once);
* an older version arriving late cannot overwrite a newer row;
* only the newest ``KEEP`` snapshots of a series stay: a reader that opened
  one keeps its files for that many further updates, and listing a table
  stays as cheap after a year as on the first day.

With ``partition_col`` (report tables use ``query_date``) every value has
its own snapshot series under ``<path>/<col>=<value>/``: a micro-batch
rewrites only the dates it carries (one per run), so the cost of an update
is bounded by a day's keys, not by the table's history.  Listing uses the
Hadoop FileSystem of the path, so this works on any cluster filesystem.
Each table has one writer (one maintenance query); readers need no lock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import upsert

SNAP = "snap="
KEEP = 5


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def snapshots(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """Committed snapshots as (seq, batch version, writer), by seq."""
    fs, root, jvm = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(SNAP):
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if fs.exists(marker):
                seq, _, rest = name[len(SNAP):].partition("-v")
                version, _, writer = rest.partition("-w")
                out.append((int(seq), int(version), writer))
    return sorted(out)


def snapshot_path(path: str, seq: int, version: int, writer: str = "") -> str:
    suffix = f"-w{writer}" if writer else ""
    return f"{path.rstrip('/')}/{SNAP}{seq:012d}-v{version}{suffix}"


def _partition_dirs(spark: SparkSession, path: str, col: str) -> list[str]:
    fs, root, _ = _fs(spark, path)
    if not fs.exists(root):
        return []
    prefix = f"{col}="
    return sorted(
        st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory() and st.getPath().getName().startswith(prefix)
    )


def read_report_table(spark: SparkSession, path: str, schema: StructType, partition_col: str | None = None) -> DataFrame:
    """The newest committed snapshot (of every partition value, with
    ``partition_col``); an empty frame with ``schema`` if there is none."""
    if partition_col is None:
        done = snapshots(spark, path)
        paths = [snapshot_path(path, *done[-1])] if done else []
    else:
        paths = []
        for name in _partition_dirs(spark, path, partition_col):
            sub = f"{path.rstrip('/')}/{name}"
            done = snapshots(spark, sub)
            if done:
                paths.append(snapshot_path(sub, *done[-1]))
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _upsert_snapshot(spark, path, updates, keys, version_col, version, schema, writer) -> bool:
    done = snapshots(spark, path)
    if any(v == version and w == writer for _, v, w in done):
        return False
    seq = done[-1][0] + 1 if done else 0
    current = read_report_table(spark, path, schema)
    merged = upsert(current, updates.select(*schema.fieldNames()), keys, version_col)
    merged.write.mode("overwrite").parquet(snapshot_path(path, seq, version, writer))
    fs, _, jvm = _fs(spark, path)
    for old in done[: max(0, len(done) + 1 - KEEP)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(snapshot_path(path, *old)), True)
    return True


def upsert_report_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    version_col: str | list[str],
    version: int,
    schema: StructType,
    writer: str = "",
    partition_col: str | None = None,
    partition_values: list | None = None,
) -> bool:
    """Merge update batch ``version`` (of ``writer``) into the table.

    Returns False (and writes nothing) when that batch was applied before,
    which makes a replayed micro-batch harmless.  Batches may arrive in any
    order: rows carry ``version_col`` (one or several columns) and the
    newest row per key wins.
    With ``partition_col``, only the partition values present in
    ``updates`` are rewritten: ``partition_values`` when the caller knows
    them, else their distinct values are collected (a report batch carries
    one run date).
    """
    if partition_col is None:
        return _upsert_snapshot(spark, path, updates, keys, version_col, version, schema, writer)
    if partition_values is None:
        partition_values = [r[0] for r in updates.select(partition_col).distinct().collect()]
    applied = False
    for value in partition_values:
        sub = f"{path.rstrip('/')}/{partition_col}={value}"
        part = updates.filter(F.col(partition_col) == F.lit(value))
        applied |= _upsert_snapshot(spark, sub, part, keys, version_col, version, schema, writer)
    return applied
