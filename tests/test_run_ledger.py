"""Ingest runs that die at any step, replaced days, and the two streams as one."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from joblens.operators import reports as R
from joblens.plans.daily_run import RunPaths, ingest_day, recover_runs, run_reports
from joblens.plans.run_ledger import STEPS, RunLedger
from joblens.schemas import RAW_LISTING
from joblens.session import run_date
from joblens.sinks.jobs_table import read_jobs
from joblens.sinks.topic import job_messages
from joblens.streaming import retractions
from joblens.streaming.reports import market_stream, read_topic_stream

DAY = dt.date(2025, 3, 14)
ROWS = [
    ("Dev", "Cty A", "Tới 30 triệu", "Hà Nội", "3 năm", "topcv"), ("Ops", "Cty B", "15 triệu", "Huế & Đà Nẵng", None, "careerlink"),
    ("Dev", "Cty A", "Tới 30 triệu", "Hà Nội", "3 năm", "topcv"), ("QA", "Cty C", "10 - 20 triệu", "Hà Nội", "1 năm", "topcv"),
]


class Died(RuntimeError):
    pass


def dying(step):
    def at(now):
        if now == step:
            raise Died(now)

    return at


def raw(spark, rows=ROWS):
    return spark.createDataFrame(rows, RAW_LISTING)


def topic(spark, paths):
    return spark.read.option("recursiveFileLookup", "true").schema("key binary, value binary, topic string").parquet(paths.jobs_topic)


def report_of(df):
    rows = R.market_reports(R.job_places(df.withColumnRenamed("experience", "final_exp"))).collect()
    return {(r.dimension, r.key): (r.min_salary, r.max_salary, r.avg_salary, r.total_jobs) for r in rows if r.dimension != "address"}


def kept(df):
    return {(r.dimension, r.key): (r.min_salary, r.max_salary, r.avg_salary, r.total_jobs) for r in df.collect() if r.dimension != "address"}


@pytest.mark.parametrize("step", ["stage", "staged", "table", "table written", "publish", "published"])
def test_rerun_after_a_lost_run(spark, workdir, step):
    paths = RunPaths(workdir)
    with pytest.raises(Died):
        ingest_day(spark, raw(spark), workdir, DAY, at=dying(step))
    got = ingest_day(spark, raw(spark), workdir, DAY)  # the rerun
    assert got.count() == read_jobs(spark, paths.jobs).count() == topic(spark, paths).count() == len(ROWS)
    assert RunLedger(spark, paths.runs).unfinished(DAY) == []
    if step in ("table written", "published"):
        assert kept(run_reports(spark, paths, DAY)) == report_of(got)


def test_a_second_crash_and_recovery_without_listings(spark, workdir):
    paths = RunPaths(workdir)
    for step in ("staged", "table written", "published"):
        with pytest.raises(Died):
            ingest_day(spark, raw(spark), workdir, DAY, at=dying(step))
    (run,) = recover_runs(spark, workdir)
    assert run.day == str(DAY) and recover_runs(spark, workdir) == []
    assert read_jobs(spark, paths.jobs).count() == topic(spark, paths).count() == len(ROWS)


def test_named_runs_are_repeated_once_and_finish_the_others(spark, workdir):
    paths = RunPaths(workdir)
    with pytest.raises(Died):
        ingest_day(spark, raw(spark, ROWS[:1]), workdir, DAY, run_id="a", at=dying("table"))
    for _ in range(2):
        ingest_day(spark, raw(spark, ROWS[1:2]), workdir, DAY, run_id="b")
    assert read_jobs(spark, paths.jobs).count() == topic(spark, paths).count() == 2
    marks = [RunLedger(spark, paths.runs).run(DAY, r).marks for r in "ab"]
    assert all(set(STEPS) <= m for m in marks)


@pytest.mark.parametrize("step", [None, "table written"])
def test_replaced_day(spark, workdir, step):
    """One posting is replaced by five others; the reports count five."""
    paths = RunPaths(workdir)
    ingest_day(spark, raw(spark, ROWS[1:2]), workdir, DAY)
    run_reports(spark, paths, DAY)
    if step:
        with pytest.raises(Died):
            ingest_day(spark, raw(spark, ROWS + ROWS[:1]), workdir, DAY, replace_day=True, at=dying(step))
    got = ingest_day(spark, raw(spark, ROWS + ROWS[:1]), workdir, DAY, replace_day=True)
    assert read_jobs(spark, paths.jobs).count() == 5
    assert topic(spark, paths).where(F.col("value").cast("string").contains('"sign":-1')).count() == 0  # it stayed
    reports = kept(run_reports(spark, paths, DAY))
    assert reports == report_of(got) and sum(v[3] for k, v in reports.items() if k[0] == "exp") == 6  # one of five has two places
    # and back to a day without topcv: its keys go, minimum and maximum fall back
    again = ingest_day(spark, raw(spark, ROWS[1:2]), workdir, DAY, replace_day=True)
    assert kept(run_reports(spark, paths, DAY)) == report_of(again)
    ingest_day(spark, raw(spark, []), workdir, DAY, replace_day=True)
    assert read_jobs(spark, paths.jobs).count() == 0 and run_reports(spark, paths, DAY).count() == 0


def test_append_only_reports_refuse_retractions(spark, workdir):
    paths = RunPaths(workdir)
    ingest_day(spark, raw(spark), workdir, DAY)
    ingest_day(spark, raw(spark, ROWS[:1]), workdir, DAY, replace_day=True)
    with pytest.raises(Exception, match="append_only=False"):
        run_reports(spark, paths, DAY, append_only=True)
    assert not spark.streams.active


def test_counts_before_the_shuffle(spark):
    """A hot key moves as its distinct salaries."""
    import pyarrow as pa

    n = 10_000
    rows = {"address_cleaned": ["Ha Noi"] * n, "source": ["topcv", None] * (n // 2), "final_exp": ["1"] * n, "min_salary": [1.0, 2.0] * (n // 2), "max_salary": [None, 3.0] * (n // 2), "sign": [1] * n}
    schema = pa.schema([*((c, pa.string()) for c in ("address_cleaned", "source", "final_exp")), ("min_salary", pa.float32()), ("max_salary", pa.float32()), ("sign", pa.int64())])
    out = pa.Table.from_batches(retractions.counted(iter(pa.table(rows, schema=schema).to_batches(max_chunksize=100)))).to_pylist()
    assert len(out) == 6 and {r["n"] for r in out} == {n // 2} and {r["key"] for r in out if r["dimension"] == "source"} == {"topcv", None}


def test_measures_of_a_multiset():
    bins = {(10.0, 20.0): 2, (0.0, 30.0): 1, (None, 8.0): 1, (5.0, None): 3, (1.0, 99.0): -1}
    assert retractions.measures("source", "s", bins) == (5.0, 30.0, (15 * 2 + 15 + 4) / 4, 7)
    assert retractions.measures("source", None, bins)[3] == 0 and retractions.measures("exp", "1", {(1.0, 2.0): 0}) == (None,) * 4


def test_a_retraction_may_come_first(spark, workdir):
    paths, jobs = RunPaths(workdir), raw(spark, ROWS[:1]).selectExpr("position", "company", "address", "source", "1.0D min_salary", "2.0D max_salary", "3 final_exp")
    for message in (job_messages(jobs, retract=True), job_messages(jobs), job_messages(jobs)):
        message.write.mode("append").parquet(paths.jobs_topic)
        reports = run_reports(spark, paths, DAY)
    assert {(r.dimension, r.total_jobs) for r in reports.collect()} == {("address", 1), ("source", 1), ("exp", 1)}


def test_a_failing_stream_stops_its_partner(spark, workdir):
    paths = RunPaths(workdir)
    ingest_day(spark, raw(spark), workdir, DAY)
    run_reports(spark, RunPaths(f"{workdir}/other"), DAY)  # ended streams of this session have no say
    spark.range(1).selectExpr("cast(id as string) value").coalesce(1).write.text(f"{paths.tables}/query")
    jvm = spark.sparkContext._jvm
    blocked = jvm.org.apache.hadoop.fs.Path(f"{paths.tables}/address_report")
    blocked.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(blocked, True).close()  # a file where the table belongs
    with pytest.raises(Exception):
        run_reports(spark, paths, DAY, trigger={"processingTime": "1 second"}, append_only=True)
    assert not spark.streams.active


def test_endless_streams_run_until_one_is_stopped(spark, workdir):
    paths = RunPaths(workdir)
    ingest_day(spark, raw(spark), workdir, DAY)
    run_reports(spark, RunPaths(f"{workdir}/other"), DAY, append_only=True)
    out = []
    worker = threading.Thread(target=lambda: out.append(run_reports(spark, paths, DAY, trigger={"processingTime": "1 second"}, append_only=True)))
    worker.start()
    end = time.time() + 90
    while time.time() < end and not (len(spark.streams.active) == 2 and all(q.lastProgress for q in spark.streams.active)):
        time.sleep(0.5)
    assert worker.is_alive() and len(spark.streams.active) == 2
    spark.streams.active[0].stop()
    worker.join(60)
    assert not worker.is_alive() and len(out) == 1 and not spark.streams.active


def test_run_date_is_the_sessions(spark):
    late = dt.datetime(2025, 3, 14, 23, 30, tzinfo=dt.timezone.utc)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name, day in (("UTC", 14), ("Asia/Ho_Chi_Minh", 15), ("America/New_York", 14)):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert run_date(spark, now=late) == dt.date(2025, 3, day)
            assert run_date(spark) == spark.range(1).select(F.current_date()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert run_date(spark, "2025-03-14") == run_date(spark, DAY) == DAY


def test_batch_stream_emits_the_same_rows(spark, workdir):
    """Both forms of the report stream agree on an append-only topic."""
    paths = RunPaths(workdir)
    ingest_day(spark, raw(spark), workdir, DAY)
    plain = kept(run_reports(spark, paths, DAY, append_only=True))
    counted = run_reports(spark, RunPaths(workdir), DAY)
    assert kept(counted) == plain
    assert market_stream(read_topic_stream(spark, paths.jobs_topic, ["jobs-topic"])).isStreaming
