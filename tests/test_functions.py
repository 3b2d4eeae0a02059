from __future__ import annotations

from pyspark.sql import functions as F

from conftest import ts
from shoplane.functions import flag, product_page_url, safe_ratio, seconds_between


def test_product_page_url_slug(spark):
    df = spark.createDataFrame([("The Brown Bear!",), ("---",), (None,), ("A  b--C9",)], "n string")
    got = [r[0] for r in df.select(product_page_url("n")).collect()]
    assert got == ["/the-brown-bear", "/", None, "/a-b-c9"]          # E13, E14


def test_safe_ratio_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2), (3, None)], "n long, d long")
    got = [r[0] for r in df.select(safe_ratio("n", "d")).collect()]
    assert got == [None, 0.25, None, None]


def test_flag_is_false_on_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "x long")
    assert [r[0] for r in df.select(flag(F.col("x") == 1)).collect()] == [True, False, False]


def test_seconds_between_counts_boundaries(spark):
    rows = [(ts("2024-01-01 00:00:00.900000"), ts("2024-01-01 00:00:01.100000")),   # E11 -> 1
            (ts("2024-01-01 00:00:01.100000"), ts("2024-01-01 00:00:01.900000")),   # -> 0
            (ts("2024-01-01 23:59:59.999999"), ts("2024-01-02 00:00:00"))]          # -> 1
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(seconds_between("a", "b")).collect()] == [1, 0, 1]
