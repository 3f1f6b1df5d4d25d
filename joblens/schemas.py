"""Fixed schemas of the data the pipeline handles (SNK5, PRJ3, PRJ5).

Column order matters where the reference matched by position: the clean
listing keeps ``final_exp`` which becomes ``experience`` in the jobs table.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Raw listing as extracted from a page: all text, plus the site it came from.
RAW_FIELDS = ("position", "company", "salary", "address", "exp")
RAW_LISTING = _struct(*((f, StringType()) for f in RAW_FIELDS), ("source", StringType()))

# Clean listing, batch form (salaries are double, as pandas float64 was).
JOB_COLUMNS = (
    "position",
    "company",
    "address",
    "source",
    "query_day",
    "min_salary",
    "max_salary",
    "final_exp",
)
JOB = _struct(
    ("position", StringType()),
    ("company", StringType()),
    ("address", StringType()),
    ("source", StringType()),
    ("query_day", DateType()),
    ("min_salary", DoubleType()),
    ("max_salary", DoubleType()),
    ("final_exp", IntegerType()),
)

# Wire form of a job message: salaries travel as 32-bit floats.
JOB_WIRE = _struct(
    ("position", StringType()),
    ("company", StringType()),
    ("address", StringType()),
    ("source", StringType()),
    ("query_day", DateType()),
    ("min_salary", FloatType()),
    ("max_salary", FloatType()),
    ("final_exp", IntegerType()),
)

# The report path only needs five of the eight wire fields; parsing a
# narrower schema keeps from_json from materialising unused strings.
JOB_WIRE_REPORT = _struct(
    ("address", StringType()),
    ("source", StringType()),
    ("min_salary", FloatType()),
    ("max_salary", FloatType()),
    ("final_exp", IntegerType()),
)

# ``sign`` -1 takes a posting back; messages without it add one.
JOB_WIRE_SIGNED = _struct(*((f.name, f.dataType) for f in JOB_WIRE_REPORT), ("sign", IntegerType()))

# Jobs table: the clean listing with final_exp stored as ``experience``.
JOBS_TABLE = _struct(
    ("position", StringType()),
    ("company", StringType()),
    ("address", StringType()),
    ("source", StringType()),
    ("query_day", DateType()),
    ("min_salary", FloatType()),
    ("max_salary", FloatType()),
    ("experience", IntegerType()),
)

MEASURES = (
    ("min_salary", DoubleType()),
    ("max_salary", DoubleType()),
    ("avg_salary", DoubleType()),
    ("total_jobs", LongType()),
)

# Report tables: key (query_date, dimension), measures, and the order of the
# update that produced the row: start of its producer (milliseconds), the
# producer's micro-batch id, the message's place in the consumer's batch.
ROW_ORDER = ("started", "version", "place")
REPORT_DIMENSIONS = {
    "address": ("address", StringType()),
    "source": ("source", StringType()),
    "exp": ("exp", IntegerType()),
}


def report_table_schema(kind: str) -> StructType:
    dim = REPORT_DIMENSIONS[kind]
    return _struct(("query_date", DateType()), dim, *MEASURES, *((c, LongType()) for c in ROW_ORDER))


# Re-aimed page scan: one row per fetched page.
PAGE = _struct(("source", StringType()), ("page_no", IntegerType()), ("html", StringType()))
