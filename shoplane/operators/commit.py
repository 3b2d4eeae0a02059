"""Replacing a table's folder so that readers and failed runs see a whole table.

A table is written to a fresh folder next to its own (``<path>.new-...``) and takes its place by two
renames: the old folder becomes ``<path>.old-...``, the new one ``<path>``. If a run dies between the two,
``recover`` puts the old folder back. A folder counts as a table only if its write was committed, which
Spark's writers mark with a ``_SUCCESS`` file.

Replacing some partitions of a table is not one rename. The replacement rows are staged first, and a
note next to the table (``<path>.pending``) names the staged folder while they are copied; a run that
finds the note copies them again, which gives the same partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..session import delete, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a whole table (also one without rows)."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def _siblings(spark: SparkSession, path: str, kind: str) -> list[str]:
    fs, p = hadoop_path(spark, f"{path.rstrip('/')}.{kind}-*")
    return sorted(str(s.getPath()) for s in (fs.globStatus(p) or []))


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo what a run that died has left of a replacement of ``path``."""
    path = path.rstrip("/")
    old = _siblings(spark, path, "old")
    if old and not exists(spark, path):
        fs, p = hadoop_path(spark, path)
        fs.rename(hadoop_path(spark, old[-1])[1], p)
        old = old[:-1]
    for left in old + _siblings(spark, path, "new"):
        delete(spark, left)


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` a table to a fresh folder, then let that folder take the place of ``path``."""
    path = path.rstrip("/")
    recover(spark, path)
    mark = uuid.uuid4().hex[:12]
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    write(new)
    fs, p = hadoop_path(spark, path)
    had = fs.exists(p)
    if had and not fs.rename(p, hadoop_path(spark, old)[1]):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(hadoop_path(spark, new)[1], p):
        recover(spark, path)
        raise OSError(f"could not move {new} to {path}")
    if had:
        delete(spark, old)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The staged folder that a run was copying into ``path`` when it died."""
    fs, p = hadoop_path(spark, f"{path.rstrip('/')}.pending")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, staged: str) -> None:
    fs, p = hadoop_path(spark, f"{path.rstrip('/')}.pending")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(staged.encode()))
    finally:
        stream.close()


def remove_note(spark: SparkSession, path: str) -> None:
    delete(spark, f"{path.rstrip('/')}.pending")
