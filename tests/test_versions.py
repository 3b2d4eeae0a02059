"""Versioned tables: readers see one whole version, at every step of a commit and after any death."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplane.operators import versions
from shoplane.operators.incremental import newest
from shoplane.operators.versions import VersionedTable, refresh

D = dt.date
SCHEMA = T.StructType([T.StructField("k", T.LongType(), True, {"comment": "it's the key"}), T.StructField("d", T.DateType()), T.StructField("v", T.LongType())])
OLD = [(1, D(2024, 1, 1), 10), (2, D(2024, 1, 20), 20), (3, None, 30)]
NEW = [(2, D(2024, 1, 20), 21), (4, D(2024, 1, 21), 40)]


@pytest.fixture()
def table(spark, tmp):
    t = VersionedTable(spark, f"db{uuid.uuid4().hex[:8]}.t", f"{tmp}/with space/t", SCHEMA, "d", "a table")
    yield t
    spark.sql(f"DROP DATABASE IF EXISTS {t.database} CASCADE")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def srt(rows):
    return sorted(rows, key=str)


def test_replace_and_rewrite(spark, table):
    assert table.version() is None
    assert table.replace(frame(spark, OLD)) == 1
    assert rows_of(table.read()) == srt(OLD)
    table.rewrite(frame(spark, NEW), [D(2024, 1, 20)])
    assert rows_of(table.read()) == srt([OLD[0], OLD[2], *NEW])
    table.rewrite(frame(spark, [(9, None, 1)]), [None, D(2024, 1, 20)])          # a folder without rows left is gone
    assert rows_of(table.read()) == srt([OLD[0], NEW[1], (9, None, 1)])
    table.replace(frame(spark, []))
    assert rows_of(table.read()) == [] and table.read().schema.names == SCHEMA.names


def test_untouched_partitions_are_not_written(spark, table):
    table.replace(frame(spark, OLD))
    before = table.folders(1)
    table.rewrite(frame(spark, NEW), [D(2024, 1, 20)])
    after = table.folders(2)
    assert after[D(2024, 1, 1)] == before[D(2024, 1, 1)] and after[None] == before[None]
    assert after[D(2024, 1, 20)] != before[D(2024, 1, 20)] and D(2024, 1, 21) in after


STEPS = ("_write", "_create", "_add_partitions", "_switch", "vacuum")


def test_readers_between_all_steps(spark, table, monkeypatch):
    """The table is read before and after each step of a commit: the old rows up to the switch, then the new ones."""
    table.replace(frame(spark, OLD))
    merged, seen = srt([OLD[0], OLD[2], *NEW]), []
    for step in STEPS:
        real = getattr(VersionedTable, step)

        def read_around(self, *a, _real=real, _step=step):
            seen.append((_step, "before", rows_of(spark.table(table.name))))
            out = _real(self, *a)
            seen.append((_step, "after", rows_of(spark.table(table.name))))
            return out
        monkeypatch.setattr(VersionedTable, step, read_around)
    planned = spark.table(table.name)                 # a query that was planned before
    table.rewrite(frame(spark, NEW), [D(2024, 1, 20)])
    assert [s for s, *_ in seen] == [s for s in STEPS for _ in "ba"]
    switch = seen.index(next(x for x in seen if x[:2] == ("_switch", "after")))
    assert all(r == srt(OLD) for _, _, r in seen[:switch]) and all(r == merged for _, _, r in seen[switch:])
    assert rows_of(planned) == srt(OLD)


class Died(Exception):
    pass


@pytest.mark.parametrize("step", STEPS[:-1])
def test_death_at_any_step(spark, table, monkeypatch, step):
    table.replace(frame(spark, OLD))
    real = getattr(VersionedTable, step)

    def dies(self, *a):
        if step != "_switch":
            real(self, *a)
        raise Died
    monkeypatch.setattr(VersionedTable, step, dies)
    with pytest.raises(Died):
        table.rewrite(frame(spark, NEW), [D(2024, 1, 20)])
    monkeypatch.undo()
    assert rows_of(table.read()) == srt(OLD)
    table.rewrite(frame(spark, NEW), [D(2024, 1, 20)])
    assert rows_of(table.read()) == srt([OLD[0], OLD[2], *NEW])
    assert len(table.versions()) == 2                 # what the dead run left is gone
    fs_folders = [x for x in os.listdir(table.root) if x.startswith("v")]
    assert len(fs_folders) == 2


def test_vacuum_keeps_what_the_last_versions_use(spark, table):
    table.replace(frame(spark, OLD))
    for k in range(4):
        table.rewrite(frame(spark, [(2, D(2024, 1, 20), k)]), [D(2024, 1, 20)])
    assert table.versions() == [4, 5]
    assert rows_of(table.read_version(4)) == srt([OLD[0], OLD[2], (2, D(2024, 1, 20), 2)])
    assert rows_of(table.read()) == srt([OLD[0], OLD[2], (2, D(2024, 1, 20), 3)])
    first = next(x for x in os.listdir(table.root) if x.startswith("v000001"))
    kept = {x for x in os.listdir(f"{table.root}/{first}") if x.startswith("d=")}
    assert kept == {"d=2024-01-01", "d=__HIVE_DEFAULT_PARTITION__"}


def test_comments_and_pruning(spark, table):
    table.replace(frame(spark, OLD))
    columns = {c.name: c.description for c in spark.catalog.listColumns(table.name)}
    assert columns["k"] == "it's the key" and spark.catalog.getTable(table.name).description == "a table"
    plan = table.read().filter("d >= DATE'2024-01-15'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and len(table.read().filter("d >= DATE'2024-01-15'").inputFiles()) == 1


def test_new_columns_need_no_rewrite(spark, table):
    table.replace(frame(spark, OLD))
    wider = T.StructType([*SCHEMA.fields, T.StructField("w", T.StringType())])
    t = VersionedTable(spark, table.name, table.root, wider, "d")
    t.rewrite(spark.createDataFrame([(5, D(2024, 1, 22), 1, "x")], wider), [])
    assert rows_of(t.read()) == srt([(*r, None) for r in OLD] + [(5, D(2024, 1, 22), 1, "x")])


def test_newest_is_null_safe(spark):
    new = frame(spark, [(1, None, 5), (1, None, 6), (None, D(2024, 1, 1), 7)])
    old = frame(spark, [(1, None, 1), (1, D(2024, 1, 1), 2), (None, D(2024, 1, 1), 3), (None, None, 4)])
    want = srt([(1, None, 5), (1, None, 6), (None, D(2024, 1, 1), 7), (1, D(2024, 1, 1), 2), (None, None, 4)])
    assert rows_of(newest(new, old, ("k", "d"))) == want


def test_lookback_merge_writes_once(spark, table, monkeypatch):
    writes = []
    real = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, rows, folder: writes.append(folder) or real(self, rows, folder))

    def build(cutoff):
        df = frame(spark, [*OLD, *NEW]) if cutoff is None else frame(spark, NEW)
        return df if cutoff is None else df.filter(F.col("d") >= F.lit(cutoff))
    assert refresh(table, lambda c: frame(spark, OLD), ("k", "d"))["mode"] == "full"
    facts = refresh(table, build, ("k", "d"))
    assert (facts["mode"], facts["cutoff"], len(writes)) == ("incremental", D(2024, 1, 13), 2)
    assert rows_of(table.read()) == srt([OLD[0], OLD[2], *NEW])
    refresh(table, build, ("k", "d"))
    assert rows_of(table.read()) == srt([OLD[0], OLD[2], *NEW])
    assert refresh(table, build, ("k", "d"), full_refresh=True)["mode"] == "full"


def test_unpartitioned_table(spark, tmp):
    t = VersionedTable(spark, f"db{uuid.uuid4().hex[:8]}.u", f"{tmp}/u", SCHEMA)
    t.replace(frame(spark, OLD))
    t.rewrite(frame(spark, NEW), [])
    assert rows_of(t.read()) == srt(NEW)
    t.replace(frame(spark, []))
    assert rows_of(t.read()) == []
    spark.sql(f"DROP DATABASE {t.database} CASCADE")


def test_other_tables_are_not_taken_for_versioned_ones(spark, table):
    spark.sql(f"CREATE DATABASE {table.database}")
    spark.sql(f"CREATE VIEW {table.name} AS SELECT 1 AS k")
    with pytest.raises(ValueError, match="not as a versioned table"):
        table.replace(frame(spark, OLD))


def test_only_dates_partition(spark, tmp):
    with pytest.raises(ValueError, match="date"):
        VersionedTable(spark, "x.t", f"{tmp}/t", SCHEMA, "k")
    assert versions.KEEP >= 2
