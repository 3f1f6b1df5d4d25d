"""The query catalogue: every operator of the inventory as a runnable query.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's tables (or data Spark derives from them), never a fixed input.
Column names equal those of the matching oracle SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonwire import decode_value
from ..functions.places import explode_places
from ..functions.text import fold_ascii
from ..operators import digest as D
from ..operators import reports as R
from ..operators.clean import clean_listings, name_fields, parse_listings, union_sources, with_missing_as_na
from ..operators.routing import with_route
from ..operators.upsert import upsert
from ..schemas import JOB_WIRE
from ..session import HUGE_METHODS, shared_dir
from ..sinks.jobs_table import day_partitions, read_jobs_day, write_jobs
from ..sinks.topic import job_messages
from ..sources import html as H
from ..sources import markup
from ..sources.listings import read_listings
from ..sources.site_pages import site_pages
from ..sources.tables import read_table, spread
from ..streaming.reports import read_changes
from ..streaming.upsert_stream import read_keyed_table, start_keyed_upsert
from .daily_run import RunPaths, ingest_day, publish_jobs, run_reports

REPORT_DATE = "2025-03-14"  # the run date that the report queries are given

Query = Callable[[SparkSession, str], DataFrame]


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean listings with their id (the jobs table, before writing)."""
    return clean_listings(read_listings(spark, sf_dir), keep=("listing_id",))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.job_places(jobs(spark, sf_dir))


def q_address_report(spark, sf_dir):
    return R.report(places(spark, sf_dir), "address")


def q_source_report(spark, sf_dir):
    return R.report(places(spark, sf_dir), "source")


def q_exp_report(spark, sf_dir):
    return R.report(places(spark, sf_dir), "exp")


def q_market_reports(spark, sf_dir):
    return R.market_reports(places(spark, sf_dir))


def _salary(site: str | None):
    def q(spark, sf_dir):
        listings = read_listings(spark, sf_dir)
        if site:
            listings = listings.filter(F.col("source") == site)
        df = parse_listings(listings, site=site)
        return df.select("listing_id", "source", "variant", "salary", "min_salary", "max_salary", "salary_ok")

    q.__name__ = f"q_salary_{site or 'all'}"
    return q


def q_exp_years(spark, sf_dir):
    return parse_listings(read_listings(spark, sf_dir)).select("listing_id", "source", "exp", "final_exp", "exp_ok")


def q_clean_jobs(spark, sf_dir):
    return jobs(spark, sf_dir)


def q_place_rows(spark, sf_dir):
    return explode_places(jobs(spark, sf_dir).select("listing_id", "address"), out="place")


# --- wire format, fold ------------------------------------------------------

def q_fold_text(spark, sf_dir):
    """STR9 over whole conversation texts."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return conv.select("conv_id", "turn", "role", fold_ascii("text").alias("text_ascii"))


def q_fold_listings(spark, sf_dir):
    """STR9 on the three text fields of the wire branch, with a quoted name, a
    full-width one and places behind an en dash, a minus sign and a small hyphen."""
    return _symbols(jobs(spark, sf_dir)).select(
        "listing_id",
        *[fold_ascii(c).alias(c) for c in ("position", "company", "address")],
    )


def _symbols(df):
    return df.withColumns(
        {
            "position": F.concat(F.lit("\u201c"), "position", F.lit("\u201d \u2026 \u00bd")),
            "company": F.concat("company", F.lit("\u3000\uff21\uff22\uff11 \u00d7 \u2022")),
            "address": F.concat("address", F.lit(" \u2013 V\u0169ng T\u00e0u \u2212 C\u00f4n \u0110\u1ea3o\ufe63\u2460")),
        }
    )


def q_fold_places(spark, sf_dir):
    """STR9 then DOM8: a dash of any kind separates places once folded."""
    folded = _symbols(jobs(spark, sf_dir)).select("listing_id", fold_ascii("address").alias("address"))
    return explode_places(folded, out="place")


def q_json_roundtrip(spark, sf_dir):
    """SNK2 message (key + JSON value, binary) -> SRC2 -> SRC3 typed row."""
    messages = job_messages(jobs(spark, sf_dir).drop("listing_id"))
    parsed = messages.select(
        decode_value("key").alias("key"),
        F.from_json(decode_value("value"), JOB_WIRE).alias("data"),
    )
    return parsed.select("key", "data.*")


def q_json_props(spark, sf_dir):
    """from_json on the events' ``props`` payloads."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "props"])
    return ev.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


# --- digest -----------------------------------------------------------------

def q_daily_count(spark, sf_dir):
    j = jobs(spark, sf_dir)
    return D.day_count(j, D.latest_day(j))


def q_top_paid(spark, sf_dir):
    j = jobs(spark, sf_dir)
    return D.top_paid(j, D.latest_day(j), tie_break=("listing_id",), extra=("listing_id",))


def q_digest_by_day(spark, sf_dir):
    return D.digest_by_day(jobs(spark, sf_dir), k=3, tie_break=("listing_id",))


# --- upsert, routing --------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def q_upsert_latest(spark, sf_dir):
    """DOM10: history (views, signups) merged with the other events; the
    latest event per user wins wherever it sits."""
    ev = read_table(spark, sf_dir, "events", EVENT_COLUMNS)
    history = ev.filter(F.col("event_type").isin("view", "signup"))
    updates = ev.filter(~F.col("event_type").isin("view", "signup"))
    return upsert(history, updates, keys=["user_id"], version="event_id")


EVENT_ROUTES = {"view": "views", "click": "clicks"}


def q_route_topics(spark, sf_dir):
    """DOM9: messages routed by topic; the last handler takes all others."""
    ev = read_table(spark, sf_dir, "events", ["event_type", "value"])
    routed = with_route(ev, "event_type", EVENT_ROUTES, "other")
    return routed.groupBy("route", "event_type").agg(
        F.count(F.lit(1)).alias("messages"), F.round(F.sum("value"), 2).alias("total_value")
    )


# --- streaming, tables -------------------------------------------------------

def q_stream_reports(spark, sf_dir):
    """SNK2 -> SRC1-3 -> AGG7 (update mode, >= 4 micro-batches) -> SNK3 ->
    SRC4 -> DOM9 -> SNK4: the report tables after both streams finish."""
    paths = RunPaths(shared_dir(spark, "stream_reports", unique=True))
    publish_jobs(jobs(spark, sf_dir).drop("listing_id"), paths, files=4)
    return run_reports(spark, paths, REPORT_DATE, batches=4, append_only=True)


def _halves(spark, sf_dir):
    listings = read_listings(spark, sf_dir)
    return [listings.filter(F.col("listing_id") % 2 == k) for k in (0, 1)]


def q_ingest_twice(spark, sf_dir):
    """Two ingests of one day (each listing in one of them): the reports
    count every posting once, stamped with the run's date (DTE1)."""
    root = shared_dir(spark, "ingest_twice", unique=True)
    for half in _halves(spark, sf_dir):
        ingest_day(spark, half, root, REPORT_DATE)
        reports = run_reports(spark, RunPaths(root), REPORT_DATE)
    return reports


def q_stream_restart(spark, sf_dir):
    """STM3: half the postings, then the report stream starts over on a new
    checkpoint (batch ids from 0 again) and replays all of them."""
    paths = RunPaths(shared_dir(spark, "stream_restart", unique=True))
    for k, half in enumerate(_halves(spark, sf_dir)):
        publish_jobs(clean_listings(half), paths)
        reports = run_reports(spark, paths, REPORT_DATE, checkpoint=f"market-{k}", append_only=True)
    return reports


class _Died(RuntimeError):
    """Stands for a driver that is lost at a step of a run."""


def _ingest_dying(spark, raw, root, last, **options):
    """An ingest that dies at ``last`` (before or after a step's work) and is run again."""

    def at(step):
        if step == last:
            raise _Died(step)

    try:
        ingest_day(spark, raw, root, REPORT_DATE, at=at, **options)
    except _Died:
        ingest_day(spark, raw, root, REPORT_DATE, **options)


def q_ingest_recovered(spark, sf_dir):
    """SNK1 + SNK2 after lost runs: three ingests of one day, each killed at
    another step (rows staged, rows in the table, messages out but not yet
    marked) and run again: every posting once in table, topic and reports."""
    root = shared_dir(spark, "ingest_recovered", unique=True)
    listings = read_listings(spark, sf_dir)
    for k, last in enumerate(("staged", "table written", "published")):
        _ingest_dying(spark, listings.filter(F.col("listing_id") % 3 == k), root, last)
    return run_reports(spark, RunPaths(root), REPORT_DATE)


def q_replaced_day(spark, sf_dir):
    """STM1 + SNK1: the day is ingested with three of five sites and reported,
    then replaced by a set that shares two of them (and dies on the way): the
    reports take back what went, whole keys with it."""
    root = shared_dir(spark, "replaced_day", unique=True)
    listings = read_listings(spark, sf_dir)
    ingest_day(spark, listings.filter((F.col("listing_id") % 5).isin(0, 1, 2)), root, REPORT_DATE)
    run_reports(spark, RunPaths(root), REPORT_DATE)
    _ingest_dying(spark, listings.filter((F.col("listing_id") % 5).isin(1, 2, 4)), root, "table written", replace_day=True)
    return run_reports(spark, RunPaths(root), REPORT_DATE)


def q_report_changes(spark, sf_dir):
    """STM2: the changelog of update mode; each batch brings other sites."""
    root = shared_dir(spark, "report_changes", unique=True)
    paths, listings = RunPaths(root), read_listings(spark, sf_dir)
    for k in range(4):
        publish_jobs(clean_listings(listings.filter(F.least(F.col("listing_id") % 5, F.lit(3)) == k)), paths)
        run_reports(spark, paths, REPORT_DATE, append_only=True, changes=f"{root}/changes")
    return read_changes(spark, f"{root}/changes")


SITES = ("topcv", "careerlink", "careerviet", "itviec", "vietnamworks")


def q_clean_union(spark, sf_dir):
    """PRJ3 + PRJ1 + SET1 + DTE1: per-site frames with positional columns
    (only topcv has a fifth), some fields missing, named, filled, united and
    cleaned for one run date."""
    listings = read_listings(spark, sf_dir)
    frames = []
    for site in SITES:
        fields = ["position", "company", "salary", "address", *(["exp"] if site == "topcv" else [])]
        lost = F.when(F.col("listing_id") % 7 != 0, F.col("company")).alias("company")
        rows = listings.filter(F.col("source") == site).select("listing_id", *[lost if f == "company" else F.col(f) for f in fields])
        named = name_fields(rows.drop("listing_id").toDF(*[f"_{k + 1}" for k in range(len(fields))]))
        frames.append(with_missing_as_na(named, tuple(fields)).withColumn("source", F.lit(site)))
    return clean_listings(union_sources(frames), REPORT_DATE)


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def q_stream_upsert(spark, sf_dir):
    """Events replayed as a file stream (4 files, one per micro-batch) into a
    keyed table (latest event per user)."""
    root = shared_dir(spark, "stream_upsert", unique=True)
    read_table(spark, sf_dir, "events", EVENT_COLUMNS).repartition(4).write.parquet(f"{root}/feed")
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{root}/feed")
    schema = spark.read.parquet(f"{root}/feed").schema
    q = start_keyed_upsert(stream, f"{root}/table", ["user_id"], "event_id", schema, f"{root}/_checkpoint")
    q.awaitTermination()
    return read_keyed_table(spark, f"{root}/table", schema)


TABLE_TIE_BREAK = ("source", "position", "company", "address", "experience")


def _jobs_table_day(spark, sf_dir):
    """Write the cleaned jobs into a day-partitioned table, then open only
    the newest day (found from the partition names, not by a scan)."""
    path = shared_dir(spark, "jobs_table", unique=True)
    write_jobs(jobs(spark, sf_dir), path)
    day = day_partitions(spark, path)[-1]
    return read_jobs_day(spark, path, day), day


def q_jobs_table_count(spark, sf_dir):
    """SNK1 + SRC5 + FLT1 + AGG6: the newest day's count through the table."""
    table, day = _jobs_table_day(spark, sf_dir)
    return D.day_count(table, day)


def q_jobs_table_top(spark, sf_dir):
    """TOP1 through the table (float salaries, ``experience`` column)."""
    table, day = _jobs_table_day(spark, sf_dir)
    return D.top_paid(table, day, tie_break=TABLE_TIE_BREAK)


# --- pages ---------------------------------------------------------------------

def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", ["page_id", "html"])


def q_extract_nav(spark, sf_dir):
    """SRC6 + flat-markup SRC7 with JVM regex functions only."""
    return H.nav_links(_pages(spark, sf_dir))


def q_page_titles(spark, sf_dir):
    return H.page_titles(_pages(spark, sf_dir))


def _rendered_pages(spark, sf_dir):
    """The listings as pages of the five sites; some without a company, and
    every tenth page of a site without its list."""
    lost = F.when(F.col("listing_id") % 7 != 0, F.col("company"))
    pages = site_pages(read_listings(spark, sf_dir).withColumn("company", lost))
    broken = F.regexp_replace("html", "job-list-search-result|list-group|jobs-side-list|card-jobs-list|block-job-list", "redesigned")
    return spread(pages.withColumn("html", F.when(F.col("page_no") % 10 == 3, broken).otherwise(F.col("html"))))


def q_listing_pages(spark, sf_dir):
    """SRC6 -> SRC7 -> PRJ1 over the five sites' markup, in the JVM."""
    return markup.extract_listings(_rendered_pages(spark, sf_dir))


def q_unread_pages(spark, sf_dir):
    """The extractor's second output: pages without their list."""
    return markup.unread_pages(_rendered_pages(spark, sf_dir))


def _tuned(query: Query) -> Query:
    """The listing plans fuse into methods the JIT compiler would refuse:
    every query sets the limit beyond which Spark falls back to small
    methods, so a session not built by ``build_session`` has it too."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set(*HUGE_METHODS)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "address_report": q_address_report,
        "source_report": q_source_report,
        "exp_report": q_exp_report,
        "market_reports": q_market_reports,
        "salary_all": _salary(None),
        "exp_years": q_exp_years,
        "clean_jobs": q_clean_jobs,
        "place_rows": q_place_rows,
    }
    for site in ("topcv", "careerlink", "careerviet", "vietnamworks"):
        out[f"salary_{site}"] = _salary(site)
    out.update(
        {
            "fold_text": q_fold_text,
            "fold_listings": q_fold_listings,
            "fold_places": q_fold_places,
            "json_roundtrip": q_json_roundtrip,
            "json_props": q_json_props,
            "daily_count": q_daily_count,
            "top_paid": q_top_paid,
            "digest_by_day": q_digest_by_day,
            "upsert_latest": q_upsert_latest,
            "route_topics": q_route_topics,
            "stream_reports": q_stream_reports,
            "ingest_twice": q_ingest_twice,
            "stream_restart": q_stream_restart,
            "ingest_recovered": q_ingest_recovered,
            "replaced_day": q_replaced_day,
            "report_changes": q_report_changes,
            "clean_union": q_clean_union,
            "stream_upsert": q_stream_upsert,
            "jobs_table_count": q_jobs_table_count,
            "jobs_table_top": q_jobs_table_top,
            "extract_nav": q_extract_nav,
            "page_titles": q_page_titles,
            "listing_pages": q_listing_pages,
            "unread_pages": q_unread_pages,
        }
    )
    return {name: _tuned(q) for name, q in out.items()}
