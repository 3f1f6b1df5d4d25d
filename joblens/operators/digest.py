"""Daily digest (FLT1, AGG6, TOP1, TOP2).

``daily_digest(jobs, day)`` gives the day's job count and its ten best-paid
postings.  The day filter is an equality on ``query_day``; on the jobs table
(partitioned by ``query_day``) it prunes to one partition directory.  The
top-k is ``orderBy(...).limit(k)``, planned as TakeOrderedAndProject: each
task keeps its own k best, only k rows per task reach the final merge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the digest: columns shown and how many postings.
DIGEST_COLUMNS = ("source", "position", "company", "address", "max_salary", "experience")
TOP_K = 10


def _day(day) -> Column:
    if isinstance(day, Column):
        return day
    return F.lit(str(day) if isinstance(day, dt.date) else day).cast("date")


def latest_day(jobs: DataFrame) -> Column:
    """Scalar subquery ``(select max(query_day) from jobs)``; evaluated once,
    before the scan that filters on it."""
    return jobs.select(F.max("query_day")).scalar()


def with_experience(jobs: DataFrame) -> DataFrame:
    """PRJ5: the table calls ``final_exp`` ``experience``."""
    return jobs.withColumnRenamed("final_exp", "experience") if "final_exp" in jobs.columns else jobs


def day_count(jobs: DataFrame, day) -> DataFrame:
    """FLT1 + AGG6: ``select count(*) from jobs where query_day = day``."""
    d = _day(day)
    counted = jobs.filter(F.col("query_day") == d).agg(F.count(F.lit(1)).alias("total_jobs"))
    return counted.select(d.alias("query_day"), "total_jobs")


def top_paid(jobs: DataFrame, day, k: int = TOP_K, tie_break: tuple[str, ...] = (), extra: tuple[str, ...] = ()) -> DataFrame:
    """TOP1: the k highest ``max_salary`` of the day (nulls last).

    The reference left ties in arbitrary order; ``tie_break`` columns make
    the choice deterministic.
    """
    jobs = with_experience(jobs)
    order = [F.col("max_salary").desc_nulls_last()] + [F.col(c).asc() for c in tie_break]
    cols = [*extra, *DIGEST_COLUMNS]
    return jobs.filter(F.col("query_day") == _day(day)).orderBy(*order).limit(k).select(*cols)


def daily_digest(jobs: DataFrame, day, k: int = TOP_K, tie_break: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """TOP2: (count frame, top-k frame) over one filtered input."""
    return day_count(jobs, day), top_paid(jobs, day, k, tie_break)


def digest_by_day(jobs: DataFrame, k: int = 3, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Per-day digest for every day at once: the day's count and its k
    best-paid postings.

    ``row_number() <= k`` over a window partitioned by day is planned with a
    partial WindowGroupLimit before the shuffle, so a day holding a third of
    all rows still sends at most k rows per task through the exchange.  The
    per-day counts come from a hash aggregate with map-side combine.
    """
    jobs = with_experience(jobs)
    order = [F.col("max_salary").desc_nulls_last()] + [F.col(c).asc() for c in tie_break]
    w = Window.partitionBy("query_day").orderBy(*order)
    top = (
        jobs.select("query_day", *tie_break, *DIGEST_COLUMNS)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )
    counts = jobs.groupBy(F.col("query_day").alias("_day")).agg(F.count(F.lit(1)).alias("total_jobs"))
    # Postings without a day are a day of their own.
    return top.join(counts, F.col("query_day").eqNullSafe(F.col("_day"))).drop("_day")
