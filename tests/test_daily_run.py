"""End to end: site pages -> listings -> jobs table + topic -> reports ->
report tables -> digest (SURVEY section 3), and the per-site union (SET1)."""

import datetime as dt

from pyspark.sql import functions as F

from joblens.operators import reports as R
from joblens.operators.clean import clean_listings, union_sources
from joblens.plans.daily_run import RunPaths, run_day, run_reports
from joblens.sources.html import extract_listings
from test_extract import CAREERLINK, CAREERVIET, ITVIEC, TOPCV, VNW

DAY = dt.date(2025, 3, 14)


def pages(spark):
    return spark.createDataFrame(
        [("topcv", 1, TOPCV), ("careerlink", 1, CAREERLINK), ("careerviet", 1, CAREERVIET), ("itviec", 1, ITVIEC), ("vietnamworks", 1, VNW)],
        "source string, page_no int, html string",
    )


def test_union_sources_keeps_topcv_exp(spark):
    a = spark.createDataFrame([("p", "c", "Tới 30 triệu", "Hà Nội", "3 năm", "topcv")], "position string, company string, salary string, address string, exp string, source string")
    b = spark.createDataFrame([("q", "d", "15 triệu", "Huế", "careerlink")], "position string, company string, salary string, address string, source string")
    rows = {r.source: r for r in clean_listings(union_sources([a, b]), DAY).collect()}
    assert (rows["topcv"].final_exp, rows["topcv"].max_salary) == (3, 30.0)
    assert (rows["careerlink"].final_exp, rows["careerlink"].max_salary) == (0, 15.0)
    assert rows["topcv"].query_day == DAY


def test_daily_run_end_to_end(spark, workdir):
    raw = extract_listings(pages(spark)).drop("page_no", "item")
    reports, count, top = run_day(spark, raw, workdir, DAY, files=2)
    assert count.collect()[0].total_jobs == 7
    best = top.collect()
    assert best[0].max_salary == 50.0 and best[0].source == "vietnamworks"
    assert [r.max_salary for r in best] == sorted([r.max_salary for r in best], reverse=True)
    got = {(r.dimension, r.key): r for r in reports.collect()}
    # the wire copy is folded, so report keys are ASCII
    assert ("address", "Ha Noi") in got and ("address", "Da Nang") in got
    batch = R.market_reports(R.job_places(clean_listings(raw, DAY).withColumn("address", F.expr("address"))))
    assert got[("source", "topcv")].total_jobs == {r.key: r for r in batch.collect()}["topcv"].total_jobs
    assert got[("source", "careerviet")].total_jobs == 2  # one job, two places (Q1)


def test_positional_fields_are_named(spark):
    from joblens.operators.clean import name_fields

    four = spark.createDataFrame([("Dev", "Cty", "15 triệu", "Huế")])
    assert name_fields(four).columns == ["position", "company", "salary", "address"]
    five = spark.createDataFrame([("Dev", "Cty", "Tới 5 triệu", "Huế", "2 năm")])
    assert name_fields(five).columns == ["position", "company", "salary", "address", "exp"]


def test_ingest_rerun_with_replace_is_idempotent(spark, workdir):
    from joblens.plans.daily_run import ingest_day
    from joblens.sinks.jobs_table import read_jobs

    raw = extract_listings(pages(spark)).drop("page_no", "item")
    ingest_day(spark, raw, workdir, DAY)
    ingest_day(spark, raw, workdir, DAY, replace_day=True)  # rerun after a failure
    assert read_jobs(spark, f"{workdir}/jobs").count() == 7
    paths = RunPaths(workdir)
    assert spark.read.parquet(paths.jobs_topic).count() == 7  # not published again
    total = lambda: sum(r.total_jobs for r in run_reports(spark, paths, DAY).where("dimension = 'source'").collect())
    once = total()
    ingest_day(spark, raw, workdir, DAY, replace_day=True)
    assert total() == once


def test_second_ingest_publishes_only_its_own_rows(spark, workdir):
    from joblens.plans.daily_run import ingest_day
    from joblens.sinks.jobs_table import read_jobs

    raw = extract_listings(pages(spark)).drop("page_no", "item")
    first, second = (raw.where(F.col("source").isin(*s)) for s in (["topcv", "itviec"], ["careerlink", "careerviet", "vietnamworks"]))
    paths = RunPaths(workdir)
    for part in (first, second):
        ingest_day(spark, part, workdir, DAY)
        got = run_reports(spark, paths, DAY)
    assert read_jobs(spark, paths.jobs).count() == spark.read.parquet(paths.jobs_topic).count() == 7
    want = R.market_reports(R.job_places(clean_listings(raw, DAY))).where("dimension = 'source'")
    assert {r.key: r.total_jobs for r in got.where("dimension = 'source'").collect()} == {r.key: r.total_jobs for r in want.collect()}


def test_reports_of_two_days_stay_apart(spark, workdir):
    raw = extract_listings(pages(spark)).drop("page_no", "item")
    run_day(spark, raw, workdir, DAY)
    reports, _, _ = run_day(spark, raw, workdir, dt.date(2025, 3, 15))
    assert {r.query_date for r in reports.collect()} == {dt.date(2025, 3, 15)}
    both = run_reports(spark, RunPaths(workdir), DAY)
    keys = [(r.query_date, r.dimension, r.key) for r in both.collect()]
    assert len(keys) == len(set(keys)) and len({k[0] for k in keys}) == 2


def test_command_line_writes_every_report_row(spark, workdir):
    from joblens.__main__ import main

    html = "<ul class='list-group mt-4'>" + "".join(
        f"<div class='media-body overflow-hidden'><h5 class='job-name'>Dev</h5><a class='text-dark'>C</a>"
        f"<span class='job-salary'>15 triệu</span><div class='job-location'><div><a>Place {i}</a></div></div></div>" for i in range(230)) + "</ul>"
    spark.createDataFrame([("careerlink", 1, html)], "source string, page_no int, html string").write.parquet(f"{workdir}/pages")
    assert main(["run", "--pages", f"{workdir}/pages", "--root", f"{workdir}/run", "--date", str(DAY), "--out", f"{workdir}/out"]) == 0
    out = spark.read.parquet(f"{workdir}/out")
    assert out.where("dimension = 'address'").count() == 230 and out.count() == 232


def test_command_line_ingest_then_digest(spark, workdir, capsys):
    from joblens.__main__ import main

    pages(spark).write.parquet(f"{workdir}/pages")
    assert main(["ingest", "--pages", f"{workdir}/pages", "--root", f"{workdir}/run", "--date", str(DAY)]) == 0
    assert main(["digest", "--table", f"{workdir}/run/jobs", "--date", str(DAY), "--top", "2"]) == 0
    out = capsys.readouterr().out
    assert "7 postings of 2025-03-14" in out and "|         7|" in out and "vietnamworks" in out


def test_command_line_run_with_rocksdb(spark, workdir, capsys):
    from joblens.__main__ import main

    pages(spark).write.parquet(f"{workdir}/pages")
    args = ["run", "--pages", f"{workdir}/pages", "--root", f"{workdir}/run", "--date", str(DAY), "--state-store", "rocksdb"]
    assert main(args) == 0
    out = capsys.readouterr().out
    assert "|         7|" in out and "|source   |" in out  # the day's count, the site report
