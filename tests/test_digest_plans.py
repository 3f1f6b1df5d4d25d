"""Digest semantics and physical-plan checks."""

import datetime as dt
import re

from pyspark.sql import functions as F

from joblens.operators import digest as D
from joblens.operators.upsert import upsert
from joblens.plans import catalogue
from joblens.schemas import JOB
from joblens.sinks.jobs_table import read_jobs, write_jobs
from joblens.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_digest_count_and_top(spark):
    day = dt.date(2024, 5, 1)
    rows = [(f"p{i}", "c", "a", "topcv", day, 0.0, float(i % 13), 0) for i in range(40)]
    rows += [("old", "c", "a", "topcv", dt.date(2024, 4, 30), 0.0, 999.0, 0), ("none", "c", "a", "topcv", day, 0.0, None, 0)]
    jobs = spark.createDataFrame(rows, JOB)
    count, top = D.daily_digest(jobs, day)
    assert count.collect()[0].total_jobs == 41
    got = top.collect()
    assert len(got) == 10 and [r.max_salary for r in got][:3] == [12.0, 12.0, 12.0]
    assert "old" not in {r.position for r in got} and got[-1].max_salary is not None  # nulls last
    assert top.columns == list(D.DIGEST_COLUMNS)


def test_empty_day_counts_zero(spark):
    jobs = spark.createDataFrame([], JOB)
    assert D.day_count(jobs, "2024-01-01").collect()[0].total_jobs == 0


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(catalogue.q_top_paid(spark, SF))


def test_per_key_limits_are_partial_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p1 = plan(catalogue.q_digest_by_day(spark, SF))
        ev = read_table(spark, SF, "events")
        p2 = plan(upsert(None, ev, ["user_id"], "event_id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for p in (p1, p2):
        assert "WindowGroupLimit" in p and "Partial" in p


def test_reports_aggregate_partially(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(catalogue.q_market_reports(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("HashAggregate") >= 2 and "Expand" in p


def test_no_python_in_column_plans(spark):
    """No registered query of the column code leaves the JVM."""
    for name, q in catalogue.queries().items():
        if name.startswith(("stream_", "jobs_table_", "ingest_")):
            continue
        p = plan(q(spark, SF))
        assert "Python" not in p and "Pandas" not in p and "ArrowEval" not in p, name


def test_scan_is_pruned(spark):
    p = plan(catalogue.q_address_report(spark, SF))
    (read,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", p))
    assert {c.split(":")[0] for c in read.split(",")} <= {"o_orderkey", "o_totalprice", "o_orderdate"}


def test_day_filter_prunes_partitions(spark, workdir):
    jobs = catalogue.jobs(spark, SF)
    write_jobs(jobs, f"{workdir}/jobs")
    table = read_jobs(spark, f"{workdir}/jobs")
    q = D.day_count(table, "1996-01-02")
    q.collect()
    assert re.search(r"PartitionFilters: \[isnotnull\(query_day#\d+\), \(query_day#\d+ = 1996-01-02\)\]", plan(q))
    assert "ReadSchema: struct<>" in plan(q)  # a count reads no column data
    # same answer as the unpartitioned frame
    want = jobs.filter(F.col("query_day") == "1996-01-02").count()
    assert q.collect()[0].total_jobs == want


def test_no_row_caps_or_sampling(spark):
    """Only the top-k queries limit rows; nothing samples.  (Streaming and
    table queries are checked through their final reads.)"""
    top_k = {"top_paid", "jobs_table_top"}
    for name, q in catalogue.queries().items():
        if name.startswith(("stream_", "jobs_table_")) and name not in top_k:
            continue
        p = plan(q(spark, SF))
        assert "Sample" not in p, name
        has_limit = "TakeOrderedAndProject" in p or "Limit" in p.replace("WindowGroupLimit", "")
        assert has_limit == (name in top_k), name


def test_postings_without_a_day_are_a_day_of_their_own(spark):
    rows = [("a", "c", "x", "topcv", None, 0.0, 1.0, 0), ("b", "c", "x", "topcv", dt.date(2024, 1, 1), 0.0, 2.0, 0)]
    got = D.digest_by_day(spark.createDataFrame(rows, JOB)).collect()
    assert sorted((str(r.query_day), r.position, r.total_jobs) for r in got) == [("2024-01-01", "b", 1), ("None", "a", 1)]


def test_no_plan_depends_on_the_partition_count(spark):
    """The same plan, whatever the scan's splits; the setting adds the spread."""
    from joblens.sources.tables import SPREAD_CONF

    assert "RoundRobin" not in plan(catalogue.q_clean_jobs(spark, SF))
    spark.conf.set(SPREAD_CONF, "4")
    try:
        assert "RoundRobinPartitioning(4)" in plan(catalogue.q_clean_jobs(spark, SF))
    finally:
        spark.conf.unset(SPREAD_CONF)
