"""Registered queries vs their DuckDB reference SQL on the sf0.001 tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from shoplane.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
CHECKED = ["fct_sales", "product_conversion", "dim_products", "refunds_by_item", "mart_product_daily_returns", "pageviews_ranked",
           "fct_sessions", "mart_product_daily_sales", "mart_product_daily_sales_slug_collision",
           "mart_channel_daily_sessions", "mart_customer_daily_value",
           "incremental_mart_customer_daily_value", "dq_not_null", "dq_grain"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
    cur = con.execute(ORACLE[name]())
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    stypes = {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields}
    assert stypes == {d[0]: str(d[1]) for d in cur.description}
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in idx) for r in cur.fetchall()), key=_key)
    assert len(got) == len(want) and got == want


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 36
