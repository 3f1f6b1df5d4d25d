"""Structured Streaming wiring of the reports (SRC1-SRC4, SNK3, SNK4, STM1-STM6).

Two queries, as in the reference's deployment, but each one a single query:

1. ``start_market_stream``: job messages -> parse (5 of 8 fields) -> places
   -> AGG7 grouping sets in *update* mode (one scan, one state store, one
   checkpoint instead of three) -> keyed report messages carrying the batch
   id as ``version`` (SNK3).
2. ``start_report_maintenance``: report messages -> route by topic (DOM9)
   -> typed rows -> latest-wins upsert into three report tables (SNK4),
   one snapshot per micro-batch, replay-safe.

State is per report key over all history (STM1): places x sites x years,
small at any input size.  The aggregation's input is combined map-side
before the state shuffle, so the shuffle carries one partial row per key
per task, not the jobs.
"""

from __future__ import annotations

import datetime as dt
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.jsonwire import parse_json
from ..operators.reports import job_places, market_reports
from ..operators.routing import REPORT_DEFAULT, REPORT_ROUTES, split_routes
from ..schemas import JOB_WIRE_SIGNED, REPORT_DIMENSIONS, ROW_ORDER, report_table_schema
from ..session import run_date, temporary_conf
from ..sinks.report_table import read_report_table, upsert_report_table
from ..sinks.topic import TOPIC_SCHEMA, report_messages, write_topic
from .retractions import retractable_reports
from .upsert_stream import QueryToken


def read_topic_stream(
    spark: SparkSession,
    source: str,
    topics: list[str],
    fmt: str = "folder",
    max_files_per_trigger: int | None = None,
    options: dict | None = None,
) -> DataFrame:
    """SRC1 / SRC4: a stream of (key, value, topic) messages.

    ``fmt='kafka'``: ``source`` = bootstrap servers; earliest offsets, no
    failure on data loss (the reference's options).  ``fmt='folder'``: a
    topic folder written by ``write_topic`` (same columns).  ``fmt='text'``:
    JSON lines, each line a value of the first topic (no key).
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
            .options(**(options or {}))
        )
        return reader.load().select("key", "value", "topic")
    reader = spark.readStream.options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        return reader.text(source).select(
            F.lit(None).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(topics[0]).alias("topic"),
        )
    # a run's messages lie in a folder of their own
    reader = reader.option("recursiveFileLookup", "true")
    return reader.schema(TOPIC_SCHEMA).parquet(source).filter(F.col("topic").isin(*topics))


def market_stream(messages: DataFrame, append_only: bool = True) -> DataFrame:
    """STM1 + STM6: the batch report function applied to a stream.

    Only the fields the reports read are parsed (column pruning cannot
    narrow ``from_json`` on its own).  The aggregates of the append-only form
    cannot take a posting back: a retraction fails the query there, and
    ``append_only=False`` counts salaries instead (``streaming.retractions``).
    """
    jobs = parse_json(messages, JOB_WIRE_SIGNED)
    if not append_only:
        return retractable_reports(job_places(jobs, "sign"))
    refused = F.raise_error(F.lit("the topic takes postings back: run the reports with append_only=False"))
    return market_reports(job_places(jobs.where(F.when(F.col("sign").isNull(), F.lit(True)).otherwise(refused.cast("boolean")))))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_market_stream(
    messages: DataFrame,
    report_topic_target: str,
    checkpoint: str,
    fmt: str = "folder",
    trigger: dict | None = None,
    state_partitions: int | None = 8,
    state_store: str | None = None,
    options: dict | None = None,
    append_only: bool = True,
    changes: str | None = None,
) -> StreamingQuery:
    """Query 1: reports in update mode, published as keyed messages.

    ``changes`` also writes each batch's emitted rows to ``batch=<id>``
    below that folder (STM2 as a table: ``read_changes``).

    Each micro-batch emits only the keys it changed (STM2).  The start of
    this query and the batch id ride along as ``started`` and ``version``, so
    consumers can order updates (Q6), also those of a query that was started
    again on a new checkpoint, whose batch ids begin at 0.
    The state shuffle carries partial aggregates only (one row per report
    key per input task), so a few state partitions serve any input size;
    raise ``state_partitions`` only if the place cardinality explodes, and
    pass ``state_store="rocksdb"`` to keep state off the JVM heap.
    """

    started = int(time.time() * 1000)

    def publish(batch: DataFrame, batch_id: int) -> None:
        versioned = batch.withColumns({"started": F.lit(started).cast("long"), "version": F.lit(batch_id).cast("long")})
        if changes:  # a replayed batch overwrites its own folder
            versioned.drop("version").write.mode("overwrite").parquet(f"{changes.rstrip('/')}/batch={batch_id}")
            versioned = batch.sparkSession.read.parquet(f"{changes.rstrip('/')}/batch={batch_id}").withColumn("version", F.lit(batch_id).cast("long"))
        write_topic(report_messages(versioned), report_topic_target, fmt, options)

    writer = (
        market_stream(messages, append_only)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
        .trigger(**(trigger or {"availableNow": True}))
    )
    settings = {}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store == "rocksdb" or not append_only:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    with temporary_conf(messages.sparkSession, settings):  # read once, at start
        return writer.start()


def read_changes(spark: SparkSession, changes: str) -> DataFrame:
    """STM2: what each micro-batch emitted: batch, dimension, key, measures
    (a null ``total_jobs``: the key has gone)."""
    rows = spark.read.parquet(changes)
    return rows.select(F.col("batch").cast("long").alias("batch"), "dimension", "key", F.col("min_salary").cast("double"), F.col("max_salary").cast("double"), "avg_salary", "total_jobs")


# Payload schemas of the three report topics (measures, start, version).
def _report_payload(dim: str, dtype) -> StructType:
    return StructType(
        [
            StructField(dim, dtype, True),
            StructField("min_salary", FloatType(), True),
            StructField("max_salary", FloatType(), True),
            StructField("avg_salary", DoubleType(), True),
            StructField("total_jobs", LongType(), True),
            StructField("started", LongType(), True),
            StructField("version", LongType(), True),
        ]
    )


REPORT_PAYLOADS = {
    "address": ("address_cleaned", _report_payload("address_cleaned", StringType())),
    "source": ("source", _report_payload("source", StringType())),
    "exp": ("final_exp", _report_payload("final_exp", IntegerType())),
}


def report_rows(messages: DataFrame, kind: str, report_date, arrived: int = 0, batch: int = 0) -> DataFrame:
    """Typed report-table rows from one route's messages (absent JSON fields
    become NULL, as ``.get(k, None)`` did).

    A message without ``started`` and ``version`` (the plain wire form) is
    ordered by its arrival: the consumer's clock, batch and place in it.
    """
    field, payload = REPORT_PAYLOADS[kind]
    dim, _ = REPORT_DIMENSIONS[kind]
    schema = report_table_schema(kind)
    parsed = parse_json(messages.withColumn("place", F.monotonically_increasing_id()), payload, keep=("place",))
    day = F.current_date() if report_date is None else F.lit(str(report_date)).cast("date")
    order = {
        "started": F.coalesce("started", F.lit(arrived)),
        "version": F.when(F.col("started").isNull(), F.lit(batch)).otherwise(F.col("version")),
        "place": F.col("place"),
    }
    measures = [f for f in schema.fields if f.name in ("min_salary", "max_salary", "avg_salary", "total_jobs")]
    return parsed.select(
        day.alias("query_date"),
        F.col(field).alias(dim),
        *[F.col(f.name).cast(f.dataType) for f in measures],
        *[order[c].cast("long").alias(c) for c in ROW_ORDER],
    )


def table_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{kind}_report"


def start_report_maintenance(
    messages: DataFrame,
    table_root: str,
    checkpoint: str,
    report_date: dt.date | str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Query 2 (STM5): route each micro-batch by topic and upsert each part
    into its report table, keyed by (query_date, dimension).  Without a
    ``report_date`` (endless queries) a batch has the date it began on."""

    token = QueryToken(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = token.get(spark)
        # the one run date every row of this batch is stamped with
        day = run_date(spark, report_date)
        arrived = int(time.time() * 1000)
        batch = batch.persist()

        def upsert_one(kind_part) -> None:
            kind, part = kind_part
            dim, _ = REPORT_DIMENSIONS[kind]
            upsert_report_table(
                spark,
                table_path(table_root, kind),
                report_rows(part, kind, day, arrived, batch_id),
                keys=["query_date", dim],
                version_col=list(ROW_ORDER),
                version=batch_id,
                schema=report_table_schema(kind),
                writer=writer,
                partition_col="query_date",
                partition_values=[day],
            )

        try:
            # three independent small jobs: submitted together, Spark runs them side by side
            with ThreadPoolExecutor(max_workers=3) as pool:
                list(pool.map(upsert_one, split_routes(batch, REPORT_ROUTES, REPORT_DEFAULT).items()))
        finally:
            batch.unpersist()

    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_report_tables(spark: SparkSession, table_root: str) -> DataFrame:
    """All three report tables as (query_date, dimension, key, measures):
    one row per day and key.  A key without ``total_jobs`` has gone."""
    frames = []
    for kind in ("address", "source", "exp"):
        dim, _ = REPORT_DIMENSIONS[kind]
        t = read_report_table(spark, table_path(table_root, kind), report_table_schema(kind), "query_date")
        frames.append(
            t.where(F.col("total_jobs").isNotNull()).select(
                "query_date",
                F.lit(kind).alias("dimension"),
                F.col(dim).cast("string").alias("key"),
                "min_salary",
                "max_salary",
                "avg_salary",
                "total_jobs",
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
