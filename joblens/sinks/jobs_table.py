"""The jobs table (SNK1, SNK5, SRC5, FLT1).

Parquet, partitioned by ``query_day``: the digest's day filter becomes a
partition filter and reads one directory.  Appends never dedupe: running a
day twice stores it twice, as the reference did.  A run with an id writes its
own folder inside the day, so repeating the run's write changes nothing; a
table is written in one of the two forms, runs or plain files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import JOBS_TABLE
from ..session import temporary_conf


def to_table_rows(jobs: DataFrame) -> DataFrame:
    """PRJ5 + types of the table: ``final_exp`` -> ``experience``, float salaries."""
    renamed = jobs.withColumnRenamed("final_exp", "experience")
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOBS_TABLE])


RUN = "run"


def write_jobs(jobs: DataFrame, path: str, replace_days: bool = False, run: str | None = None) -> None:
    """SNK1: one directory per day.

    Rows are rebalanced on ``query_day`` first: every day goes to one
    writer (one file per day) unless it is big, in which case AQE splits it
    over several writers.  Coalescing small shuffle partitions would not
    save a single file here (each day sits in one partition anyway), it
    would only serialise the writers, so it is off for this write.

    Default: append, as the reference did (a rerun stores the day twice).
    ``replace_days=True`` overwrites only the days present in ``jobs``
    (dynamic partition overwrite), so a rerun after a failure is idempotent.
    ``run`` overwrites that run's part of its days only.
    """
    rows = to_table_rows(jobs).hint("rebalance", "query_day")
    if run:
        rows = rows.withColumn(RUN, F.lit(run))
    writer = rows.write.partitionBy("query_day", *([RUN] if run else []))
    if replace_days or run:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    with temporary_conf(jobs.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        writer.parquet(path)


def keep_only_run(spark: SparkSession, path: str, day, run: str) -> None:
    """Take everything but ``run`` out of a day (a metadata operation)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/query_day={day}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName() != f"{RUN}={run}":
            fs.delete(status.getPath(), True)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: the table with its declared schema (no inference pass)."""
    return spark.read.schema(JOBS_TABLE).parquet(path).select(*JOBS_TABLE.fieldNames())


def day_partitions(spark: SparkSession, path: str) -> list[str]:
    """Committed ``query_day`` partitions, from directory names only.

    Metadata, not data: one listing of the table root (one entry per day),
    so finding the newest day never scans the rows.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    prefix = "query_day="
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    days = (n[len(prefix):] for n in names if n.startswith(prefix))
    # rows without a day land in Hive's default partition, which is no day
    return sorted(d for d in days if re.fullmatch(r"\d{4}-\d{2}-\d{2}", d))


def read_jobs_day(spark: SparkSession, path: str, day) -> DataFrame:
    """FLT1 at the file level: list and read only that day's directory
    with all its runs; a day without postings is an empty frame, so its
    count is 0."""
    if str(day) not in day_partitions(spark, path):
        return spark.createDataFrame([], JOBS_TABLE)
    inside = StructType([f for f in JOBS_TABLE if f.name != "query_day"])
    rows = spark.read.schema(inside).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/query_day={day}")
    return rows.withColumn("query_day", F.lit(str(day)).cast("date")).select(*JOBS_TABLE.fieldNames())


def write_jobs_jdbc(jobs: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """SNK1 against a database, for deployments that keep the table there.

    Connection details come from the caller.  Not exercised here: no
    database may run in this environment.
    """
    to_table_rows(jobs).write.mode("append").jdbc(url, table, properties=properties or {})


def read_jobs_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    num_partitions: int | None = None,
    column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
) -> DataFrame:
    """SRC5 over JDBC; equality filters on ``query_day`` are pushed to the
    database.  A read in several tasks needs all of ``num_partitions``,
    ``column``, ``lower`` and ``upper``."""
    bounds = (num_partitions, column, lower, upper)
    if any(b is not None for b in bounds):
        if any(b is None for b in bounds):
            raise ValueError("a partitioned JDBC read needs num_partitions, column, lower and upper")
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=num_partitions, properties=dict(properties or {}))
    return spark.read.jdbc(url, table, properties=dict(properties or {}))
