from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too, from whatever folder the tests are started in
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

from shoplane.schemas import SOURCE_SCHEMAS  # noqa: E402
from shoplane.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="shoplane-tests")
    yield s
    s.stop()


@pytest.fixture()
def few_partitions(spark):
    """For tests of many small jobs, where most of the time would go to empty tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


class Sources(dict):
    """Source tables for hand fixtures; absent tables are empty."""

    def __init__(self, spark, **tables):
        super().__init__()
        for name, schema in SOURCE_SCHEMAS.items():
            rows = tables.get(name, [])
            full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
            self[name] = spark.createDataFrame(full, schema)


@pytest.fixture()
def make_sources(spark):
    return lambda **t: Sources(spark, **t)
