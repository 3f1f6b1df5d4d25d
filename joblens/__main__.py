"""Command line: the daily job-market runs as Spark jobs.

    python -m joblens ingest --pages PAGES --root ROOT [--date D]
        pages (parquet: source, page_no, html) -> listings -> jobs table + topic;
        pages without listings -> ROOT/unread_pages/DATE
    python -m joblens run --pages PAGES --root ROOT [--date D]
        ingest, then both report streams, then the digest
    python -m joblens reports --root ROOT [--date D]
        run both report streams to the end of their input (availableNow)
    python -m joblens recover --root ROOT [--date D]
        finish the ingest runs (of one day, or all) that died after staging
    python -m joblens digest --table JOBS_TABLE [--date D] [--top 10]
        the day's job count and best-paid postings

``ROOT`` should sit in the cluster's shared storage; streams keep their
checkpoints below it, so a rerun continues where the last one stopped.
"""

from __future__ import annotations

import argparse

from .operators.digest import daily_digest
from .plans.daily_run import RunPaths, Topics, ingest_day, recover_runs, run_day, run_reports
from .schemas import PAGE
from .session import build_session, run_date
from .sinks.jobs_table import read_jobs_day
from .sources.markup import extract_listings, unread_pages


def _report(reports, out: str | None) -> None:
    """All report rows to ``out``; a line that says how many there are."""
    if out:
        reports.write.mode("overwrite").parquet(out)
        reports = reports.sparkSession.read.parquet(out)
    reports.groupBy("query_date", "dimension").count().orderBy("query_date", "dimension").show(reports.count() + 1, truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(
        prog="joblens", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    sub = parser.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("run")
    p.add_argument("--pages", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--date")
    i = sub.add_parser("ingest")
    i.add_argument("--pages", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--date")
    r = sub.add_parser("reports")
    r.add_argument("--root", required=True)
    r.add_argument("--date")
    r.add_argument("--append-only", action="store_true", help="plain aggregates, for a topic whose days are never replaced")
    v = sub.add_parser("recover")
    v.add_argument("--root", required=True)
    v.add_argument("--date")
    d = sub.add_parser("digest")
    d.add_argument("--table", required=True)
    d.add_argument("--date")
    d.add_argument("--top", type=int, default=10)
    for s in (p, i):
        s.add_argument("--replace-day", action="store_true", help="the day gets these postings instead of what it had")
    for s in (p, r):
        s.add_argument("--out", help="folder (parquet) for all report rows")
        s.add_argument("--state-store", choices=["rocksdb"], help="report stream state off the heap")
    for s in (p, i, r, v):
        s.add_argument("--kafka", metavar="SERVERS", help="send and read messages through Kafka instead of topic folders")
        s.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE")
    r.add_argument("--every", metavar="INTERVAL", help="keep both streams running with this trigger, e.g. '1 minute'")
    for s in (p, i, r, v, d):
        s.add_argument("--master")
    args = parser.parse_args(argv)

    spark = build_session("joblens-" + args.cmd, master=args.master)
    day = run_date(spark, args.date)
    topics = Topics()
    if getattr(args, "kafka", None):
        topics = Topics("kafka", args.kafka, dict(o.split("=", 1) for o in args.kafka_option))
    if args.cmd in ("run", "ingest"):
        pages = spark.read.schema(PAGE).parquet(args.pages)
        raw = extract_listings(pages).drop("page_no", "item")
        lost = f"{args.root.rstrip('/')}/unread_pages/{day}"
        unread_pages(pages).write.mode("overwrite").parquet(lost)
        for reason, n in spark.read.schema("source string, page_no int, reason string").parquet(lost).groupBy("reason").count().collect():
            print(f"{n} pages not read ({reason}): {lost}")
        if args.cmd == "ingest":
            rows = ingest_day(spark, raw, args.root, day, replace_day=args.replace_day, topics=topics)
            print(f"{rows.count()} postings of {day} in the table")
            return 0
        reports, count, top = run_day(spark, raw, args.root, day, replace_day=args.replace_day, state_store=args.state_store, topics=topics)
        _report(reports, args.out)
    elif args.cmd == "recover":
        for run in recover_runs(spark, args.root, topics, args.date):
            print(f"finished run {run.run_id} of {run.day}")
        return 0
    elif args.cmd == "reports":
        trigger = {"processingTime": args.every} if args.every else None
        _report(run_reports(spark, RunPaths(args.root), day, state_store=args.state_store, topics=topics, trigger=trigger, append_only=args.append_only), args.out)
        return 0
    else:
        count, top = daily_digest(read_jobs_day(spark, args.table, day), day, args.top)
    count.show()
    top.show(args.top if args.cmd == "digest" else 10, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
