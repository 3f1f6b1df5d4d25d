"""Every registered query against its DuckDB oracle (the driver's gate, at
sf0.001 unless JOBLENS_GATE_SF names another scale), plus the contract
shape of ``__spark_entry__``."""

import os

import pytest

import __spark_entry__ as E
from joblens.plans import catalogue, oracle
from compare import compare

NAMES = sorted(catalogue.queries())
# JOBLENS_GATE_SF=/root/testdata/sf0.01 runs the driver's scale
GATE_SF = os.environ.get("JOBLENS_GATE_SF", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_queries()) == set(catalogue.queries())
    assert set(NAMES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_jobs" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, GATE_SF, name, E.queries()[name], E.oracle_sql()[name])
    assert res["status"] == "ok", res
