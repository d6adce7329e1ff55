"""Registered queries against their SQL on the smallest scale."""

import pytest

from clickflow.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want.fetchall()))


def test_one_query_for_each_operator():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
