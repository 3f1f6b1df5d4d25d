"""The shared working folder comes from the session's spark.checkpoint.dir."""

import os

from joblens.session import CHECKPOINT_CONF, ensure_checkpoint_dir, shared_dir, temporary_conf


def test_shared_dir_under_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root == spark.conf.get(CHECKPOINT_CONF)
    a = shared_dir(spark, "x", unique=True)
    b = shared_dir(spark, "x", unique=True)
    assert a != b and a.startswith(root.rstrip("/") + "/joblens/x/") and os.path.isdir(a)


def test_temporary_conf_restores(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with temporary_conf(spark, {key: "3", "spark.joblens.test.unset": "1"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.joblens.test.unset", None) is None


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    bare = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        session = SimpleNamespace(conf=bare, sparkContext=SimpleNamespace(master=master, getConf=lambda: bare))
        with pytest.raises(RuntimeError, match=CHECKPOINT_CONF):
            ensure_checkpoint_dir(session)
