"""Every registered query against its DuckDB oracle on the smallest shipped scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from clickflow.plans.oracle import oracle_sql as plans_oracle

from .conftest import SF_SMALL

OWN = set(plans_oracle())      # the training-data queries have tests of their own
SQL = {k: v for k, v in E.oracle_sql().items() if k in OWN}
BATCH = [k for k in SQL if not k.endswith("_stream") and not k.startswith("sink_")]
IO = [k for k in SQL if k not in BATCH]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in ("events", "nation", "region"):
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", BATCH + IO)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["rank", "category_id", "click_count", "order_count", "pay_count"]
