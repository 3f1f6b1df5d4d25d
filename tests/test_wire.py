"""Wire format: job messages, PERMISSIVE parsing, report messages."""

import datetime as dt
import json

from pyspark.sql import functions as F

from joblens.functions.jsonwire import parse_json
from joblens.operators import reports as R
from joblens.schemas import JOB, JOB_WIRE
from joblens.sinks.topic import job_messages, report_messages


def test_job_message_is_folded_and_keeps_nulls(spark):
    jobs = spark.createDataFrame([("Kỹ sư", "Công ty", "Hà Nội", "topcv", dt.date(2025, 1, 2), 0.0, None, 3)], JOB)
    m = job_messages(jobs).collect()[0]
    assert bytes(m.key).decode() == "Ky su" and m.topic == "jobs-topic"
    value = json.loads(bytes(m.value).decode())
    assert value == {"position": "Ky su", "company": "Cong ty", "address": "Ha Noi", "source": "topcv",
                     "query_day": "2025-01-02", "min_salary": 0.0, "max_salary": None, "final_exp": 3}


def test_permissive_parsing(spark):
    payloads = [
        '{"position":"a","query_day":"2025-01-02","min_salary":1.5,"final_exp":2}',
        '{"position":"b","final_exp":1.5}',
        '{"position":"c","final_exp":3.0}',
        '{"position":"d","query_day":"not a date","max_salary":"x"}',
        "garbage",
        None,
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    rows = parse_json(df, JOB_WIRE).collect()
    assert rows[0].final_exp == 2 and rows[0].min_salary == 1.5 and rows[0].query_day == dt.date(2025, 1, 2)
    assert rows[1].position == "b" and rows[1].final_exp is None  # bad field -> only that field null
    assert rows[2].position == "c" and rows[2].final_exp is None
    assert rows[3].position == "d" and rows[3].query_day is None and rows[3].max_salary is None
    assert all(v is None for v in rows[4]) and all(v is None for v in rows[5])  # garbage/null -> all-null row


def test_report_messages_are_keyed_and_omit_nulls(spark):
    jobs = spark.createDataFrame([("p", "c", "Ha Noi", "itviec", None, 0.0, 0.0, 0)], JOB)
    market = R.market_reports(R.job_places(jobs)).withColumn("version", F.lit(7).cast("long"))
    got = {r.topic: (bytes(r.key).decode(), json.loads(bytes(r.value).decode())) for r in report_messages(market).collect()}
    assert got["address_report"] == ("Ha Noi", {"address_cleaned": "Ha Noi", "max_salary": 0.0, "avg_salary": 0.0, "total_jobs": 1, "version": 7})
    assert got["source_report"][0] == "itviec" and "min_salary" not in got["source_report"][1]
    assert got["exp_report"] == ("0", {"final_exp": 0, "max_salary": 0.0, "avg_salary": 0.0, "total_jobs": 1, "version": 7})
