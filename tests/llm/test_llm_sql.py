"""Queries that SQL expresses, against DuckDB at sf0.001."""

import pytest
from compare import compare

from joblens.llm import queries as corpus


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_matches_sql(spark, name):
    res = compare(spark, "/root/testdata/sf0.001", name, corpus.queries()[name], corpus.oracle_sql()[name])
    assert res["status"] == "ok", res


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_sql_is_text():
    import __spark_entry__ as entry

    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())
