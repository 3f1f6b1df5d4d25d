"""Topic messages (SNK2, SNK3) and where they go.

A message frame has Kafka's shape: ``key`` and ``value`` (binary) plus an
optional ``topic`` column.  ``write_topic`` sends it to Kafka when the
connector is on the classpath, or to a *topic folder* (parquet files with the
same columns) that the stream readers accept in its place.  The Kafka
connector is not installed here, so only the folder form is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..functions.jsonwire import row_json
from ..functions.text import fold_ascii

# The topic names of the reference.
JOBS_TOPIC = "jobs-topic"
REPORT_TOPICS = {"address": "address_report", "source": "source_report", "exp": "exp_report"}

TOPIC_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
    ]
)

FOLDED = ("position", "company", "address")


def job_messages(jobs: DataFrame, topic: str = JOBS_TOPIC, retract: bool = False) -> DataFrame:
    """SNK2: key = folded position (UTF-8), value = the row as JSON with the
    three text fields ASCII-folded and nulls written as ``null``.

    Only the wire copy is folded; the jobs table keeps the original text.
    ``retract`` takes published rows back: the same messages with ``sign`` -1.
    """
    folded = jobs.withColumns({c: fold_ascii(c) for c in FOLDED if c in jobs.columns})
    if retract:
        folded = folded.withColumn("sign", F.lit(-1))
    value = row_json(folded, keep_nulls=True)
    return folded.select(
        F.col("position").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def report_messages(market: DataFrame) -> DataFrame:
    """SNK3: one message per changed report row, to the report's own topic.

    Unlike the reference, the message carries a key (the group value), so
    all updates of one key land in one partition, in order.  Null fields
    are omitted from the JSON, as ``to_json`` does by default.
    """
    topic = F.element_at(F.create_map(*[x for kv in REPORT_TOPICS.items() for x in map(F.lit, kv)]), F.col("dimension"))
    key_col = {"address": "address_cleaned", "source": "source", "exp": "final_exp"}
    extra = [c for c in ("started", "version") if c in market.columns]
    measures = ["min_salary", "max_salary", "avg_salary", "total_jobs", *extra]
    dim = F.col("dimension")
    value = (
        F.when(dim == "address", F.to_json(F.struct("address_cleaned", *measures)))
        .when(dim == "source", F.to_json(F.struct("source", *measures)))
        .otherwise(F.to_json(F.struct("final_exp", *measures)))
    )
    key = (
        F.when(dim == "address", F.col(key_col["address"]))
        .when(dim == "source", F.col(key_col["source"]))
        .otherwise(F.col(key_col["exp"]).cast("string"))
    )
    return market.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"), topic.alias("topic"))


def write_topic(messages: DataFrame, target: str, fmt: str = "folder", options: dict | None = None) -> None:
    """Batch write of messages (appended):

    * ``kafka``: ``target`` = bootstrap servers, the ``topic`` column routes;
    * ``folder``: parquet with Kafka's columns (key, value, topic);
    * ``text``: JSON lines, one value per line (keys and topics dropped).
    """
    if fmt == "kafka":
        messages.write.format("kafka").option("kafka.bootstrap.servers", target).options(**(options or {})).save()
    elif fmt == "text":
        messages.select(F.col("value").cast("string").alias("value")).write.mode("append").text(target)
    else:
        messages.select("key", "value", "topic").write.mode("append").parquet(target)
