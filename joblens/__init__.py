"""joblens: job-posting analytics expressed as Spark DataFrame plans.

Layers
------
``functions``  Column -> Column expressions (text, salary, places, JSON).
``sources``    DataFrame producers (driver tables, listings, pages, streams).
``operators``  DataFrame -> DataFrame compositions (clean, reports, digest, upsert).
``sinks``      writers (partitioned jobs table, topic files, report tables, JDBC).
``streaming``  Structured Streaming wiring of the same operators.
``plans``      the query catalogue, the end-to-end daily run.
"""

__version__ = "0.1.0"

# The main entry points, importable from the package root.
from .operators.clean import clean_listings, parse_listings  # noqa: E402
from .operators.digest import daily_digest, digest_by_day  # noqa: E402
from .operators.reports import job_places, market_reports, report  # noqa: E402
from .operators.upsert import upsert  # noqa: E402
from .plans.daily_run import ingest_day, run_day, run_reports  # noqa: E402
from .session import build_session  # noqa: E402
from .sources.html import extract_listings  # noqa: E402

__all__ = [
    "build_session",
    "extract_listings",
    "clean_listings",
    "parse_listings",
    "job_places",
    "report",
    "market_reports",
    "daily_digest",
    "digest_by_day",
    "upsert",
    "ingest_day",
    "run_reports",
    "run_day",
]
