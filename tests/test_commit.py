"""Table replacement survives a run that dies at any point; intermediates go away."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.operators import commit, incremental
from shoplane.plans import pipeline
from shoplane.session import ensure_checkpoint_dir, scratch_path, scratch_scope
from shoplane.sources import fixtures

D = dt.date
SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()), T.StructField("d", T.DateType())])
OLD = [(1, 10, D(2024, 1, 1)), (2, 20, D(2024, 1, 20)), (3, 30, None)]
NEW = [(2, 21, D(2024, 1, 20)), (4, 40, D(2024, 1, 21))]


def build(spark, rows):
    def make(cutoff):
        df = spark.createDataFrame(rows, SCHEMA)
        return df if cutoff is None else df.filter(F.col("d") >= F.lit(cutoff))
    return make


def refresh(spark, path, rows, **kw):
    return incremental.refresh_mart(spark, path, build(spark, rows), SCHEMA, ("k", "d"), "d", **kw)


def rows_of(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names).collect()), key=str)


MERGED = sorted([OLD[0], (2, 21, D(2024, 1, 20)), OLD[2], (4, 40, D(2024, 1, 21))], key=str)


class Died(Exception):
    pass


def test_death_between_the_two_renames(spark, tmp, monkeypatch):
    path = f"{tmp}/m"
    refresh(spark, path, OLD)
    real, calls = commit.hadoop_path, []

    def second_rename_dies(s, p):
        fs, hp = real(s, p)
        if ".new-" in p and "*" not in p:
            calls.append(p)
            raise Died
        return fs, hp
    monkeypatch.setattr(commit, "hadoop_path", second_rename_dies)
    with pytest.raises(Died):
        refresh(spark, path, NEW, full_refresh=True)
    monkeypatch.undo()
    assert calls and not os.path.exists(path)           # the old table is set aside, the new one not yet in place
    assert refresh(spark, path, NEW)["mode"] == "incremental"
    assert rows_of(spark, path) == MERGED
    assert [x for x in os.listdir(tmp) if not x.startswith(".")] == ["m"]


def test_uncommitted_folder_is_no_target(spark, tmp):
    path = f"{tmp}/m"
    os.makedirs(f"{path}/_temporary/0")
    assert refresh(spark, path, OLD)["mode"] == "full"
    assert rows_of(spark, path) == sorted(OLD, key=str)


def test_other_read_errors_are_raised(spark, tmp):
    path = f"{tmp}/m"
    refresh(spark, path, OLD)
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{d}/{n}", "wb") as f:
                    f.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        refresh(spark, path, NEW)


def test_merge_that_died_while_copying_is_finished(spark, tmp, monkeypatch):
    path = f"{tmp}/m"
    refresh(spark, path, OLD)
    real = incremental._copy_partitions

    def dies_half_way(s, staged, target, schema, date_col):
        real(s, staged, target, schema, date_col)
        for part in os.listdir(target):
            if part.startswith("d=2024-01-20"):
                for n in os.listdir(f"{target}/{part}"):
                    os.unlink(f"{target}/{part}/{n}")          # one partition is gone
        raise Died
    monkeypatch.setattr(incremental, "_copy_partitions", dies_half_way)
    with pytest.raises(Died):
        refresh(spark, path, NEW)
    monkeypatch.undo()
    incremental.finish_pending(spark, path, "d")
    assert rows_of(spark, path) == MERGED
    assert sorted(x for x in os.listdir(tmp) if not x.startswith(".")) == ["m"]


def test_drift_takes_the_place_of_the_old_table(spark, tmp):
    path = f"{tmp}/m"
    refresh(spark, path, OLD)
    wider = T.StructType([*SCHEMA.fields[:2], T.StructField("w", T.StringType()), SCHEMA.fields[2]])
    incremental.refresh_mart(spark, path, lambda c: spark.createDataFrame([], wider), wider, ("k", "d"), "d")
    got = spark.read.schema(wider).parquet(path)
    assert got.count() == 3 and got.filter("w IS NOT NULL").count() == 0


def test_files_follow_dates_not_partitions(spark, tmp):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        rows = [(k, k, D(2024, 1, 1) + dt.timedelta(days=k % 100)) for k in range(2000)]
        refresh(spark, f"{tmp}/m", rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = [n for _, _, names in os.walk(f"{tmp}/m") for n in names if n.endswith(".parquet")]
    assert 100 <= len(files) <= 130


def test_a_build_leaves_no_intermediates(spark, tmp):
    base = ensure_checkpoint_dir(spark)
    before = set(os.listdir(base))
    src = fixtures.set_b(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        pipeline.build(spark, src, f"{tmp}/wh", marts=("mart_product_daily_sales",))
    assert set(os.listdir(base)) == before
    with scratch_scope(spark, "outer"):
        with scratch_scope(spark, "inner"):
            kept = scratch_path(spark, "x")
            spark.range(1).write.parquet(kept)
        assert os.path.exists(kept)
    assert not os.path.exists(kept)


def test_a_cluster_must_name_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs://store/shared"
    assert ensure_checkpoint_dir(Session()) == "hdfs://store/shared"
