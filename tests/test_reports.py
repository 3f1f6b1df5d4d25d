"""Reports: golden vector (FIXTURES.md section 5), grouping sets = three
reports, streaming update mode, stream = batch, restart from checkpoint."""

import os

from pyspark.sql import functions as F

from joblens.operators import reports as R
from joblens.plans.daily_run import RunPaths, publish_jobs, run_reports
from joblens.schemas import JOB
from joblens.sinks.topic import JOBS_TOPIC
from joblens.streaming.reports import market_stream, read_report_tables, read_topic_stream, start_report_maintenance

JOBS = [
    ("p1", "c", "Ha Noi & Ho Chi Minh", "topcv", None, 10.0, 20.0, 2),
    ("p2", "c", "Ha Noi", "topcv", None, 0.0, 30.0, 0),
    ("p3", "c", "Da Nang, ", "itviec", None, 0.0, 0.0, 0),
]

GOLDEN = {
    ("address", "Ha Noi"): (10, 30, 15, 2),
    ("address", "Ho Chi Minh"): (10, 20, 15, 1),
    ("address", "Da Nang"): (None, 0, 0, 1),
    ("address", ""): (None, 0, 0, 1),
    ("source", "topcv"): (10, 30, 15, 3),
    ("source", "itviec"): (None, 0, 0, 2),
    ("exp", "2"): (10, 20, 15, 2),
    ("exp", "0"): (None, 30, 5, 3),
}


def jobs_df(spark, rows=JOBS):
    return spark.createDataFrame(rows, JOB)


def _as_dict(rows):
    return {(r.dimension, r.key): (r.min_salary, r.max_salary, r.avg_salary, r.total_jobs) for r in rows}


def test_golden_three_reports(spark):
    places = R.job_places(jobs_df(spark))
    got = {}
    for kind, (key, _) in R.REPORTS.items():
        for r in R.report(places, kind).collect():
            got[(kind, str(r[key]))] = tuple(r[1:])
    assert got == GOLDEN


def test_grouping_sets_equal_three_reports(spark):
    assert _as_dict(R.market_reports(R.job_places(jobs_df(spark))).collect()) == GOLDEN


def test_null_experience_key_counts_zero(spark):
    rows = JOBS + [("p4", "c", "Hue", "topcv", None, 5.0, 6.0, None)]
    got = _as_dict(R.market_reports(R.job_places(jobs_df(spark, rows))).collect())
    assert got[("exp", None)][3] == 0  # count(final_exp) skips the null key


def _write_jobs_topic(spark, paths, rows):
    from joblens.sinks.topic import job_messages, write_topic

    write_topic(job_messages(jobs_df(spark, rows)).coalesce(1), f"{paths.jobs_topic}")


def test_update_mode_emits_only_changed_keys(spark, workdir):
    """J1 in batch 0, J2+J3 in batch 1: batch 1 must not re-emit Ho Chi Minh or exp 2."""
    paths = RunPaths(workdir)
    _write_jobs_topic(spark, paths, JOBS[:1])
    emitted = []

    def keep(batch, batch_id):
        emitted.append((batch_id, {(r.dimension, r.key) for r in batch.collect()}))

    def run():
        stream = read_topic_stream(spark, paths.jobs_topic, [JOBS_TOPIC], max_files_per_trigger=1)
        q = (
            market_stream(stream)
            .writeStream.outputMode("update")
            .option("checkpointLocation", paths.checkpoint("u"))
            .foreachBatch(keep)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()

    run()
    _write_jobs_topic(spark, paths, JOBS[1:])
    run()  # restart from the checkpoint: only the new file is read
    assert len(emitted) == 2
    second = emitted[1][1]
    assert ("address", "Ho Chi Minh") not in second and ("exp", "2") not in second
    assert ("address", "Ha Noi") in second and ("source", "itviec") in second


def test_stream_equals_batch_with_restart(spark, workdir):
    """Reports maintained by the two streams equal the batch reports, also
    when the run is cut in two and resumed from the checkpoints."""
    from joblens.plans.catalogue import jobs as catalogue_jobs

    sf = "/root/testdata/sf0.001"
    jobs = catalogue_jobs(spark, sf).drop("listing_id")
    paths = RunPaths(workdir)
    half_a = jobs.filter(F.col("query_day") < "1996-06-01")
    half_b = jobs.filter(F.col("query_day") >= "1996-06-01")
    publish_jobs(half_a, paths, files=2)
    run_reports(spark, paths)
    publish_jobs(half_b, paths, files=2)
    streamed = run_reports(spark, paths)

    from joblens.sinks.topic import job_messages
    from joblens.functions.jsonwire import parse_json
    from joblens.schemas import JOB_WIRE_REPORT

    batch = R.market_reports(R.job_places(parse_json(job_messages(jobs), JOB_WIRE_REPORT)))
    want = _as_dict(batch.collect())
    got = _as_dict(streamed.collect())
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == (None if want[k][0] is None else float(want[k][0]))
        assert abs(got[k][2] - want[k][2]) < 1e-9 and got[k][3] == want[k][3]
    # every snapshot folder is complete
    tables = os.listdir(paths.tables)
    assert sorted(tables) == ["address_report", "exp_report", "source_report"]


def test_rocksdb_state_store(spark, workdir):
    """Same update-mode output on the RocksDB state store."""
    from joblens.streaming.reports import start_market_stream

    paths = RunPaths(workdir)
    _write_jobs_topic(spark, paths, JOBS)
    q = start_market_stream(
        read_topic_stream(spark, paths.jobs_topic, [JOBS_TOPIC]),
        paths.report_topics,
        paths.checkpoint("rocks"),
        state_store="rocksdb",
    )
    q.awaitTermination()
    assert os.path.isdir(paths.checkpoint("rocks") + "/state")
    from joblens.functions.jsonwire import parse_json
    from joblens.streaming.reports import REPORT_PAYLOADS

    msgs = spark.read.parquet(paths.report_topics)
    got = {}
    for kind, (field, payload) in REPORT_PAYLOADS.items():
        topic = {"address": "address_report", "source": "source_report", "exp": "exp_report"}[kind]
        for r in parse_json(msgs.filter(F.col("topic") == topic), payload).collect():
            got[(kind, None if r[field] is None else str(r[field]))] = (r.min_salary, r.max_salary, r.avg_salary, r.total_jobs)
    assert got == GOLDEN
    from joblens.streaming.reports import ROCKSDB

    # the session setting is restored once the query has started
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB


def test_json_lines_stream_equals_folder(spark, workdir):
    """SRC1 over plain JSON-lines files gives the same reports (bad lines
    become all-null rows, which the place split drops)."""
    from joblens.sinks.topic import job_messages, write_topic

    path = f"{workdir}/lines"
    write_topic(job_messages(jobs_df(spark)), path, fmt="text")
    with open(f"{path}/garbage.txt", "w") as fh:
        fh.write("not json\n")
    rows = []

    def keep(batch, batch_id):
        rows.extend(batch.collect())

    q = (
        market_stream(read_topic_stream(spark, path, [JOBS_TOPIC], fmt="text"))
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{workdir}/ck")
        .foreachBatch(keep)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert _as_dict(rows) == GOLDEN


def test_replay_in_a_fixed_number_of_batches(spark, workdir):
    from joblens.plans.daily_run import data_files
    from joblens.sinks.topic import job_messages, write_topic

    paths = RunPaths(workdir)
    write_topic(job_messages(jobs_df(spark, JOBS * 4)).repartition(6), paths.jobs_topic)
    assert data_files(spark, paths.jobs_topic) == 6
    run_reports(spark, paths, batches=3)
    offsets = os.listdir(paths.checkpoint("market") + "/offsets")
    assert len([o for o in offsets if o.isdigit()]) == 3


def _message(key, value, topic="source_report"):
    import json

    return bytearray(key, "utf8"), bytearray(json.dumps(value), "utf8"), topic


def test_plain_messages_are_ordered_by_arrival(spark, workdir):
    """Messages in the plain wire form (no start, no version, also a null key)
    replace what is older and are replaced by what comes later."""
    import time

    from joblens.sinks.topic import TOPIC_SCHEMA

    def feed(rows):
        spark.createDataFrame(rows, TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(f"{workdir}/topic")
        stream = read_topic_stream(spark, f"{workdir}/topic", ["source_report"])
        start_report_maintenance(stream, f"{workdir}/tables", f"{workdir}/ck", "2025-03-14").awaitTermination()
        return {r.key: r.total_jobs for r in read_report_tables(spark, f"{workdir}/tables").collect()}

    row = lambda source, n, **order: _message(source or "", {"source": source, "min_salary": 1.0, "max_salary": 2.0, "avg_salary": 1.5, "total_jobs": n, **order})
    before = int(time.time() * 1000)
    assert feed([row("a", 3, started=before, version=5), row("b", 1), row(None, 4)]) == {"a": 3, "b": 1, None: 4}
    assert feed([row("a", 77), row("b", 2), row("b", 9), row(None, 5)]) == {"a": 77, "b": 9, None: 5}
    later = int(time.time() * 1000) + 60_000
    assert feed([row("a", 80, started=later, version=0)])["a"] == 80
    assert feed([row("a", 1, started=later, version=-1)])["a"] == 80  # older batch of the same producer


def test_new_report_checkpoint_replaces_stale_rows(spark, workdir):
    """Three runs over growing input, then the report stream starts over on a
    new checkpoint: its batch 0 is newer than the old batch 2."""
    from joblens.plans.daily_run import RunPaths, publish_jobs, run_reports

    paths = RunPaths(workdir)
    job = lambda n: spark.createDataFrame([("p", "c", "Hue", "topcv", None, 0.0, float(n), 0)], JOB)
    for n in (10, 20, 30):
        publish_jobs(job(n), paths)
        run_reports(spark, paths, "2025-03-14")
    publish_jobs(job(99), paths)
    got = run_reports(spark, paths, "2025-03-14", checkpoint="market-2").where("dimension = 'source'").collect()
    assert [(r.key, r.total_jobs, r.max_salary) for r in got] == [("topcv", 4, 99.0)]
