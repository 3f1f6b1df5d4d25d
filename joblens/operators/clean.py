"""Cleaning of raw listings (PRJ1-PRJ5, SET1, DTE1, DOM1-DOM7).

Input: raw listings (``position, company, salary, address, source`` and, for
topcv, ``exp``), optionally with ``query_day`` and an id column.
Output: the clean listing in the fixed JOB column order.  Everything is a
narrow projection, so it pipelines with the scan in one codegen stage.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.salary import with_experience, with_salary
from ..schemas import JOB, JOB_COLUMNS, RAW_FIELDS

NOT_AVAILABLE = "Not Available"  # fixed value: text of a missing field


def name_fields(df: DataFrame, names: tuple[str, ...] = RAW_FIELDS) -> DataFrame:
    """PRJ3: name positional fields (``_1, _2, ...`` from rows built as
    lists) in the raw listing order; sites without ``exp`` pass four names."""
    return df.toDF(*names[: len(df.columns)])


def with_missing_as_na(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """PRJ1: a field the page did not have becomes ``Not Available``.
    (An element with empty text stays ``""``.)"""
    return df.withColumns({f: F.coalesce(F.col(f), F.lit(NOT_AVAILABLE)) for f in fields if f in df.columns})


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """SET1: bag union of per-site frames; topcv carries ``exp``, others not."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _report_day(df: DataFrame, report_date: dt.date | str | Column | None) -> Column:
    """DTE1: the run date is an explicit argument; without one, a frame that
    already has ``query_day`` keeps it and otherwise today is used."""
    if report_date is None:
        return F.col("query_day").cast("date") if "query_day" in df.columns else F.current_date()
    if isinstance(report_date, Column):
        return report_date.cast("date")
    return F.lit(str(report_date)).cast("date")


def parse_listings(df: DataFrame, report_date=None, site: str | None = None) -> DataFrame:
    """Raw listings + parsed salary/experience, with the row-level
    ``salary_ok`` / ``exp_ok`` flags; raw ``salary`` and ``exp`` kept.
    ``site`` evaluates one site's rules only, for a frame that holds no other."""
    if "exp" not in df.columns:
        df = df.withColumn("exp", F.lit(None).cast("string"))
    df = df.withColumn("query_day", _report_day(df, report_date))
    return with_experience(with_salary(df, site=site))


def clean_listings(df: DataFrame, report_date=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ2-PRJ4: raw -> clean listing (JOB columns, in order).

    ``keep`` names extra columns to carry in front (e.g. an id).
    Text fields pass through as extracted (extraction already stripped them).
    """
    parsed = parse_listings(df, report_date)
    cols = [F.col(c) for c in keep]
    cols += [F.col(name).cast(JOB[name].dataType).alias(name) for name in JOB_COLUMNS]
    return parsed.select(*cols)
