"""Scans of the driver's parquet tables (column-pruned, filter-pushable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` here makes the ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


SPREAD_CONF = "joblens.spread.partitions"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over ``joblens.spread.partitions`` partitions.

    Off unless the session sets that number: file splits belong to the session
    and the data layout.  ``bench.py`` sets it for test files that hold a
    single row group and so scan as one task.
    """
    n = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(n)) if n else df
