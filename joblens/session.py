"""Session construction and the shared working folder.

Every job that cuts lineage or keeps streaming state writes below the folder
the cluster names in ``spark.checkpoint.dir``.  Only a local master may go
without that setting; elsewhere a missing one is an error.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from contextlib import contextmanager
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a fused
# stage beyond that would run interpreted, so let Spark fall back to
# per-expression code (small methods) for such stages.
HUGE_METHODS = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(
    app: str = "joblens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the plans are written for.

    AQE stays on (the reference turned it off): it coalesces the tiny
    shuffles of low-cardinality reports and splits skewed partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        HUGE_METHODS[0]: HUGE_METHODS[1],
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder; a local master may go without one (tests, a
    laptop) and gets a temporary folder, a cluster may not."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF, None
    )
    if not path:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="joblens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_date(spark: SparkSession, given: dt.date | str | None = None, now: dt.datetime | None = None) -> dt.date:
    """DTE1: the one date of a run, ``given`` or today in the session's time
    zone (the clock of ``current_date()``, not the driver machine's).  Resolve
    it once and pass it on: every step of a run then agrees, also at midnight."""
    if given is not None:
        return given if type(given) is dt.date else dt.date.fromisoformat(str(given)[:10])
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return (now or dt.datetime.now(dt.timezone.utc)).astimezone(zone).date()


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder in the file system that ``path`` belongs to."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder.

    ``unique=True`` appends a fresh id so concurrent or repeated runs never
    reuse (and never need to delete) each other's files.
    """
    root = ensure_checkpoint_dir(spark)
    pieces = [root.rstrip("/"), "joblens", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    path = "/".join(pieces)
    make_folder(spark, path)
    return path


@contextmanager
def temporary_conf(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the jobs started inside the block, restored
    afterwards (run such blocks from one thread per session)."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
