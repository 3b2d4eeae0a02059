"""Randomized checks against straightforward reference formulations."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shoplane.functions import seconds_between
from shoplane.operators.sequence import number_within_groups

SETTINGS = settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)

rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([1, 2, 3, 7])),   # few keys, NULL
                          st.one_of(st.none(), st.integers(0, 5)),               # many ties
                          st.integers(0, 10_000)),
                min_size=1, max_size=300, unique_by=lambda r: r[2])


@SETTINGS
@given(data=rows, parts=st.integers(1, 9))
def test_numbering_equals_window(spark, data, parts):
    df = spark.createDataFrame(data, "k int, t int, id long")
    order = [F.col("t").asc_nulls_last(), F.col("id").desc()]
    got = number_within_groups(df, ["k"], order, "rn", num_partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))
                         .cast("long"))
    assert sorted(got.collect(), key=_key) == sorted(want.collect(), key=_key)


stamps = st.datetimes(min_value=dt.datetime(2020, 1, 1), max_value=dt.datetime(2030, 1, 1))


@SETTINGS
@given(pairs=st.lists(st.tuples(stamps, stamps), min_size=1, max_size=50))
def test_seconds_between_counts_boundaries(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(seconds_between("a", "b")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    want = [int((b - epoch).total_seconds() // 1) - int((a - epoch).total_seconds() // 1)
            for a, b in pairs]
    assert got == want
