"""End-to-end run: pages or raw listings -> jobs table + topic -> reports ->
report tables -> digest.  The reference chained these as separate services;
here every step is a Spark job and the streaming steps run with
``availableNow`` so a run ends.

All paths live under ``root``, which callers take from the shared folder
(``joblens.session.shared_dir``), never from a machine-local temp dir.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_listings
from ..operators.digest import daily_digest
from ..schemas import JOBS_TABLE
from ..session import make_folder, run_date
from ..sinks.jobs_table import keep_only_run, read_jobs_day, to_table_rows, write_jobs
from ..sinks.topic import JOBS_TOPIC, REPORT_TOPICS, TOPIC_SCHEMA, job_messages, write_topic
from ..streaming.reports import (
    read_report_tables,
    read_topic_stream,
    start_market_stream,
    start_report_maintenance,
)
from ..streaming.supervise import await_together
from .run_ledger import IN_TABLE, PUBLISHED, REPLACES, STAGED, Run, RunLedger


@dataclass(frozen=True)
class Topics:
    """Where messages travel: topic folders below the run's root, or Kafka.

    ``Topics("kafka", "host:9092", {...})`` sends and reads through the
    Kafka connector (the caller puts its package on the classpath; it is not
    installed here, so that form stays untested).
    """

    fmt: str = "folder"
    servers: str | None = None
    options: dict = field(default_factory=dict)

    def target(self, folder: str) -> str:
        return self.servers if self.fmt == "kafka" else folder


@dataclass(frozen=True)
class RunPaths:
    root: str

    @property
    def jobs(self) -> str:
        return f"{self.root}/jobs"

    @property
    def jobs_topic(self) -> str:
        return f"{self.root}/topics/{JOBS_TOPIC}"

    @property
    def report_topics(self) -> str:
        return f"{self.root}/topics/reports"

    @property
    def tables(self) -> str:
        return f"{self.root}/tables"

    @property
    def runs(self) -> str:
        return f"{self.root}/_runs"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def publish_jobs(jobs: DataFrame, paths: RunPaths, files: int | None = None, topics: Topics = Topics()) -> None:
    """SNK2 into the job topic.  ``files`` deals the messages over that many
    files (a replay in several micro-batches reads them one by one)."""
    messages = job_messages(jobs)
    if files:
        messages = messages.repartition(files)
    write_topic(messages, topics.target(paths.jobs_topic), topics.fmt, topics.options)


def data_files(spark: SparkSession, path: str) -> int:
    """Number of data files under a topic folder (one metadata listing)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    files = fs.listFiles(root, True)
    n = 0
    while files.hasNext():
        name = files.next().getPath().getName()
        n += not name.startswith(("_", "."))
    return n


def run_reports(
    spark: SparkSession,
    paths: RunPaths,
    report_date=None,
    batches: int | None = None,
    state_store: str | None = None,
    topics: Topics = Topics(),
    trigger: dict | None = None,
    checkpoint: str | None = None,
    append_only: bool = False,
    changes: str | None = None,
) -> DataFrame:
    """Both streaming queries, started together; returns the report tables.

    By default they run to the end of their input (``availableNow``): when
    both have ended, the second runs once more for what was published
    after it looked.  With a ``trigger`` such as ``{"processingTime": "1
    minute"}`` both keep running until one of them ends.  Either way the
    first failure stops both and is raised here (STM4).

    ``batches`` replays the job topic in about that many micro-batches (by
    files per trigger); default: all new files at once.
    ``append_only=True`` keeps plain aggregates (native, smallest state) for
    a topic whose days are never replaced.
    ``state_store="rocksdb"`` applies when the report stream first starts;
    ``checkpoint`` names the report stream's checkpoint; ``changes`` is a
    folder for what each batch emitted.
    """
    endless = bool(trigger) and "availableNow" not in trigger
    if not endless:
        report_date = run_date(spark, report_date)
    per_trigger = None
    if topics.fmt == "folder":
        for folder in (paths.jobs_topic, paths.report_topics):
            make_folder(spark, folder)
        if batches:
            per_trigger = max(1, -(-data_files(spark, paths.jobs_topic) // batches))

    def maintenance():
        return start_report_maintenance(
            read_topic_stream(spark, topics.target(paths.report_topics), list(REPORT_TOPICS.values()), topics.fmt, options=topics.options),
            paths.tables,
            paths.checkpoint("maintenance"),
            report_date,
            trigger,
        )

    market = start_market_stream(
        read_topic_stream(spark, topics.target(paths.jobs_topic), [JOBS_TOPIC], topics.fmt, per_trigger, topics.options),
        topics.target(paths.report_topics),
        paths.checkpoint(checkpoint or ("market" if append_only else "market-signed")),
        topics.fmt,
        trigger,
        state_store=state_store,
        options=topics.options,
        append_only=append_only,
        changes=changes,
    )
    try:
        tables = maintenance()
    except BaseException:
        market.stop()
        raise
    await_together(spark, [market, tables], endless)
    if not endless:
        await_together(spark, [maintenance()])
    return read_report_tables(spark, paths.tables)


Step = Callable[[str], None]


def _stage(spark: SparkSession, run: Run, raw: DataFrame, paths: RunPaths, files: int | None) -> None:
    """The run's rows, and its outbox: a message per new row; for a replaced
    day only the difference, rows that went as retractions."""
    to_table_rows(clean_listings(raw, run.day)).write.mode("overwrite").parquet(run.rows)
    rows = spark.read.schema(JOBS_TABLE).parquet(run.rows)
    as_jobs = lambda df: df.withColumnRenamed("experience", "final_exp")
    if REPLACES in run.marks:
        held = read_jobs_day(spark, paths.jobs, run.day)
        gone = job_messages(as_jobs(held.exceptAll(rows)), retract=True)
        messages = job_messages(as_jobs(rows.exceptAll(held))).unionByName(gone)
    else:
        messages = job_messages(as_jobs(rows))
    messages = messages.repartition(files) if files else messages
    messages.select("key", "value", "topic").write.mode("overwrite").parquet(run.outbox)


def _finish(spark: SparkSession, ledger: RunLedger, run: Run, paths: RunPaths, topics: Topics, at: Step) -> None:
    """The steps of a staged run that have no marker yet."""
    if IN_TABLE not in run.marks:
        at("table")
        rows = spark.read.schema(JOBS_TABLE).parquet(run.rows)
        write_jobs(rows.withColumnRenamed("experience", "final_exp"), paths.jobs, run=run.run_id)
        if REPLACES in run.marks:
            keep_only_run(spark, paths.jobs, run.day, run.run_id)
        at("table written")
        run = ledger.mark(run, IN_TABLE)
    at("publish")
    if topics.fmt == "folder":
        # staged messages become visible in one step, once
        ledger.move(run.outbox, f"{paths.jobs_topic}/run={run.run_id}")
    else:
        # a crash between send and marker sends a second time
        write_topic(spark.read.schema(TOPIC_SCHEMA).parquet(run.outbox), topics.target(paths.jobs_topic), topics.fmt, topics.options)
    at("published")
    ledger.mark(run, PUBLISHED)


def recover_runs(spark: SparkSession, root: str, topics: Topics = Topics(), day=None) -> list[Run]:
    """Finish every staged run that did not publish (of ``day``, or of all
    days), oldest first; returns them.  A run that died before its rows were
    staged left nothing and needs its raw listings: ``ingest_day`` again."""
    paths = RunPaths(root)
    ledger = RunLedger(spark, paths.runs)
    found = [run for d in ([str(day)] if day else ledger.days()) for run in ledger.unfinished(d) if STAGED in run.marks]
    for run in found:
        _finish(spark, ledger, run, paths, topics, lambda step: None)
    return found


def ingest_day(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    report_date=None,
    files: int | None = None,
    replace_day: bool = False,
    topics: Topics = Topics(),
    run_id: str | None = None,
    at: Step = lambda step: None,
) -> DataFrame:
    """The scrape job's sinks as one run of the ledger: clean the raw
    listings and stage them with their messages, put them into the jobs
    table, publish the messages.  Each step is committed by a marker and
    repeats without effect, so the table and the topic get the same rows,
    once, wherever a run died.  Returns the day's rows.

    A call after a failure is the rerun of the day's last unfinished run: it
    goes on from the last marker (``raw`` counts only if nothing was staged).
    ``run_id`` names the run instead; a finished one is not repeated.  Other
    unfinished runs of the day are finished first.

    ``replace_day=True`` gives the day these listings instead of what it
    had: the table drops the day's other runs, and the topic gets the
    difference, vanished postings as retractions.
    ``at`` is called before and after each step's work.
    """
    paths = RunPaths(root)
    day = run_date(spark, report_date)
    ledger = RunLedger(spark, paths.runs)
    pending = ledger.unfinished(day)
    if run_id is None and pending:
        run_id = pending[-1].run_id
    for other in pending:
        if other.run_id != run_id and STAGED in other.marks:
            _finish(spark, ledger, other, paths, topics, lambda step: None)
    run = ledger.begin(day, run_id, replace_day)
    if not run.finished:
        if STAGED not in run.marks:
            at("stage")
            _stage(spark, run, raw, paths, files)
            at("staged")
            run = ledger.mark(run, STAGED)
        _finish(spark, ledger, run, paths, topics, at)
    return read_jobs_day(spark, paths.jobs, day)


def run_day(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    report_date=None,
    files: int | None = None,
    replace_day: bool = False,
    state_store: str | None = None,
    topics: Topics = Topics(),
):
    """One day's run: ingest, maintain reports (both streams to the end of
    their input), digest.  Returns (the day's report rows, day count, top paid)."""
    paths = RunPaths(root)
    report_date = run_date(spark, report_date)
    day_rows = ingest_day(spark, raw, root, report_date, files, replace_day, topics)
    reports = run_reports(spark, paths, report_date, state_store=state_store, topics=topics)
    count, top = daily_digest(day_rows, report_date)
    return reports.where(F.col("query_date") == F.lit(str(report_date)).cast("date")), count, top
