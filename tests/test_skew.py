"""Hot keys: one key holds a third of the rows.  The shuffle must carry
partial results (bounded by tasks x keys), not the rows themselves."""

from pyspark.sql import functions as F

from joblens.operators import reports as R
from joblens.operators.upsert import upsert

ROWS = 90_000
SLICES = 8


def _exchange_records(df) -> list[int]:
    """shuffleRecordsWritten of every exchange in the executed plan."""
    out = []

    def walk(node):
        if node.nodeName() in ("Exchange", "ShuffleExchange"):
            out.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def _skewed_jobs(spark):
    i = F.col("id")
    return spark.range(0, ROWS, 1, SLICES).select(
        F.when(i % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("P"), (i % 50).cast("string"), F.lit(", Q"))).alias("address"),
        F.when(i % 3 == 0, F.lit("topcv")).otherwise(F.lit("itviec")).alias("source"),
        (i % 7).cast("double").alias("min_salary"),
        (i % 11).cast("double").alias("max_salary"),
        (i % 5).cast("int").alias("final_exp"),
    )


def test_report_shuffle_carries_partial_aggregates(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        market = R.market_reports(R.job_places(_skewed_jobs(spark)))
        rows = market.collect()
        written = _exchange_records(market)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = [r for r in rows if r.dimension == "address" and r.key == "Hot"][0]
    assert hot.total_jobs == ROWS // 3
    keys = len(rows)
    assert written and max(written) <= SLICES * keys  # not ~1.6 x ROWS exploded rows


def test_latest_per_key_shuffle_is_limited_before_the_exchange(spark):
    i = F.col("id")
    events = spark.range(0, ROWS, 1, SLICES).select(
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 1000).alias("user_id"), i.alias("event_id")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        latest = upsert(None, events, ["user_id"], "event_id")
        rows = latest.collect()
        written = _exchange_records(latest)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(rows) == len({r.user_id for r in rows}) == 1000
    assert [r.event_id for r in rows if r.user_id == 0] == [ROWS - 3]
    assert written and max(written) <= SLICES * 1000  # one row per key per task, not 30,000 for the hot key


def test_per_day_top_k_with_a_hot_day(spark):
    from joblens.operators.digest import digest_by_day

    i = F.col("id")
    jobs = spark.range(0, ROWS, 1, SLICES).select(
        i.alias("listing_id"),
        F.when(i % 3 == 0, F.lit("2025-01-01")).otherwise(F.date_format(F.date_add(F.lit("2024-01-01"), (i % 100).cast("int")), "yyyy-MM-dd")).cast("date").alias("query_day"),
        F.lit("topcv").alias("source"), F.lit("p").alias("position"), F.lit("c").alias("company"), F.lit("a").alias("address"),
        (i % 997).cast("double").alias("max_salary"), F.lit(0).alias("final_exp"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        digest = digest_by_day(jobs, k=3, tie_break=("listing_id",))
        rows = digest.collect()
        written = _exchange_records(digest)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    days = {r.query_day for r in rows}
    hot = sorted((r for r in rows if str(r.query_day) == "2025-01-01"), key=lambda r: r.rank)
    assert len(hot) == 3 and hot[0].total_jobs == ROWS // 3 and hot[0].max_salary == 996.0
    # the window's exchange carries at most k rows per day per task (the counts' exchange one per day per task)
    assert max(written) <= SLICES * len(days) * 3


def test_table_write_splits_a_hot_day(spark, workdir):
    import os

    from joblens.schemas import JOB
    from joblens.session import temporary_conf
    from joblens.sinks.jobs_table import write_jobs

    i = F.col("id")
    jobs = spark.range(0, ROWS, 1, SLICES).select(
        F.concat(F.lit("position "), i.cast("string")).alias("position"), F.lit("c").alias("company"),
        F.lit("a").alias("address"), F.lit("topcv").alias("source"),
        F.when(i % 3 == 0, F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("date").alias("query_day"),
        F.lit(0.0).alias("min_salary"), (i % 97).cast("double").alias("max_salary"), F.lit(0).alias("final_exp"),
    ).select(*JOB.fieldNames())
    with temporary_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536"}):
        write_jobs(jobs, f"{workdir}/jobs")
    files = lambda d: [f for f in os.listdir(f"{workdir}/jobs/query_day={d}") if f.endswith(".parquet")]
    assert len(files("2025-01-01")) > 1 and len(files("2025-01-02")) > 1  # both days exceed 64 KB: split
    assert spark.read.parquet(f"{workdir}/jobs").count() == ROWS
