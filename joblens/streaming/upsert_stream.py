"""Stream -> keyed table maintenance for any keyed feed (STM5 + DOM10).

The table is Parquet, partitioned by a hash bucket of the keys.  A micro-batch
reads the buckets its keys fall in (partition pruning), merges the newest row
per key and puts those buckets back in one dynamic partition overwrite, so
its cost is that of the touched buckets, not of the table.

Putting a bucket back first takes the old one out, so a merge is written
beside the table before (its redo copy, one per batch id): a batch that dies
on the way is repeated from that copy and never from a half-written table.
``_batch`` tells which batch brought a row.  A table has one writer.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.upsert import upsert

BUCKET, BATCH = "_bucket", "_batch"
BUCKETS = 16


def _stored(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BATCH, LongType(), True), StructField(BUCKET, IntegerType(), True)])


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, path)
    return fs.exists(folder)


def _read(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    if not _exists(spark, table):
        return spark.createDataFrame([], _stored(schema))
    return spark.read.schema(_stored(schema)).parquet(table)


def read_keyed_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The newest rows of a table kept by ``start_keyed_upsert``."""
    return _read(spark, table, schema).select(*schema.fieldNames())


def query_token(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns ``checkpoint`` (from the
    checkpoint's metadata file, written when the query first started)."""
    text = "\n".join(r.value for r in spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect())
    return json.loads(text)["id"].replace("-", "")


class QueryToken:
    """Lazily read once per started query, inside its first micro-batch."""

    def __init__(self, checkpoint: str) -> None:
        self.checkpoint = checkpoint
        self.value: str | None = None

    def get(self, spark: SparkSession) -> str:
        if self.value is None:
            self.value = query_token(spark, self.checkpoint)
        return self.value


def merge_batch(
    batch: DataFrame, table: str, keys: list[str], version_col: str | list[str], schema: StructType, batch_id: int, writer: str = "", buckets: int = BUCKETS
) -> None:
    """Merge one batch into ``table``; repeating it changes nothing."""
    spark, root = batch.sparkSession, f"{table.rstrip('/')}_redo"
    redo = f"{root}/{writer}-{batch_id}"
    if not _exists(spark, f"{redo}/_SUCCESS"):
        dealt = batch.select(*schema.fieldNames(), F.lit(batch_id).cast("long").alias(BATCH), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)).persist()
        try:
            touched = [r[0] for r in dealt.select(BUCKET).distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            held = _read(spark, table, schema).where(F.col(BUCKET).isin(touched))
            upsert(held, dealt, keys, version_col).write.mode("overwrite").parquet(redo)
        finally:
            dealt.unpersist()
    merged = spark.read.schema(_stored(schema)).parquet(redo).hint("rebalance", BUCKET)
    merged.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table)
    folder, fs = _folder(spark, root)
    for status in fs.listStatus(folder):  # only the last copy can be asked for again
        if status.getPath().getName() != f"{writer}-{batch_id}":
            fs.delete(status.getPath(), True)


def start_keyed_upsert(
    stream: DataFrame,
    table: str,
    keys: list[str],
    version_col: str | list[str],
    schema: StructType,
    checkpoint: str,
    trigger: dict | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep ``table`` at the newest row per key of ``stream``; read it with
    ``read_keyed_table``.  ``buckets`` stays the same for a table's life."""
    token = QueryToken(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, table, keys, version_col, schema, batch_id, token.get(batch.sparkSession), buckets)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
