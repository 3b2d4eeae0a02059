"""Tables that change by versions: readers see the old version or the new one, whole.

A table is a view in the catalog, ``gold.mart``, over the catalog table of one version, ``gold.mart__v000007``.
A commit

1. writes the new rows once, to a fresh folder ``<root>/v000007-...``;
2. creates the catalog table of that version. Its partitions are the folders just written and, where a commit
   replaces some partitions only, the folders of all others as the version before has them;
3. replaces the view. This one catalog call is the switch.

So a commit never touches a file that a reader may have open, a merge writes its rows once, and what a run
that died has left is a folder and a catalog table that no view names, which ``vacuum`` takes away. A
query that was planned before the switch ends on the version it began with: the last ``KEEP`` versions stay.

(``ALTER TABLE ... SET LOCATION`` alone would not do: a partitioned table's partitions keep the locations
that the catalog has for them, and setting these is one call for each.)

New columns need no rewrite: files without them are read as NULL. There is one writer at a time per table.
With a catalog that outlives the session (a metastore), so do the tables.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import EMPTY_TARGET_DATE, LOOKBACK_DAYS
from ..session import delete, hadoop_path
from .incremental import newest

KEEP = 2
PROPERTY = "shoplane.version"
_NULL = "__HIVE_DEFAULT_PARTITION__"
_PER_STATEMENT = 500


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class VersionedTable:
    """Versions of the table ``name`` (``database.table``) below the folder ``root``.

    ``schema`` is the order and the types of the columns; ``partition`` is a date column of it by whose
    values files are put into folders.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, schema: T.StructType, partition: str | None = None, comment: str = ""):
        self.spark, self.name, self.root = spark, name, root.rstrip("/")
        self.schema, self.partition, self.comment = schema, partition, comment
        self.observed: dict[str, int] = {}
        self._folders: dict[int, dict[dt.date | None, str]] = {}
        self._metrics: dict[str, Column] = {}
        self.database, _, self.table = name.rpartition(".")
        if partition is not None and not isinstance(schema[partition].dataType, T.DateType):
            raise ValueError(f"{name}: only a date column can be the partition column")

    # ---- what is there
    def version(self) -> int | None:
        """Number of the version that readers see; None if there is no table."""
        if not self.spark.catalog.databaseExists(self.database) or not self.spark.catalog.tableExists(self.name):
            return None
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if PROPERTY not in found:
            raise ValueError(f"{self.name} is in the catalog, but not as a versioned table")
        return int(found[PROPERTY])

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.schema.names)

    def read_version(self, n: int) -> DataFrame:
        return self.spark.table(self._version_name(n)).select(*self.schema.names)

    def _version_name(self, n: int) -> str:
        return f"{self.name}__v{n:06d}"

    def versions(self) -> list[int]:
        """Numbers of all versions in the catalog, also of those that were never switched to."""
        names = (r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{self.table}__v*'").collect())
        found = (re.fullmatch(rf"{self.table}__v(\d+)", x, re.IGNORECASE) for x in names)
        return sorted(int(m[1]) for m in found if m)

    def folders(self, n: int) -> dict[dt.date | None, str]:
        """Folder of each partition of a version: as this object has committed it, or from its list of files."""
        if n in self._folders:
            return dict(self._folders[n])
        out = {}
        for file in self.spark.table(self._version_name(n)).inputFiles():
            folder = unquote(file).rpartition("/")[0]
            value = folder.rpartition("=")[2]
            out[None if value == _NULL else dt.date.fromisoformat(value)] = folder
        self._folders[n] = out
        return dict(out)

    # ---- commits
    def replace(self, rows: DataFrame, observe: dict[str, Column] | None = None) -> int:
        """A version that has exactly these rows. ``observe``: aggregates of them that the write collects on
        its way; ``observed`` has them afterwards."""
        self._metrics = observe or {}
        return self._commit(rows, lambda: {})

    def rewrite(self, rows: DataFrame, partitions: Iterable[dt.date | None], observe: dict[str, Column] | None = None) -> int:
        """A version in which the given partitions have exactly these rows, and all others what they had.

        Partitions of rows outside of the given ones are replaced as well. ``observe`` sees the rows written.
        """
        now, gone = self.version(), set(partitions)
        if now is None or self.partition is None:
            return self.replace(rows, observe)
        self._metrics = observe or {}
        return self._commit(rows, lambda: {v: f for v, f in self.folders(now).items() if v not in gone})

    def _commit(self, rows: DataFrame, others: Callable[[], dict[dt.date | None, str]]) -> int:
        # a folder of its own: dropping a database deletes its folder, which must not be that of the tables
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION {_quoted(self.root.rpartition('/')[0] + '/_db')}")
        now = self.version() or 0
        for dead in (v for v in self.versions() if v > now):       # of a run that died before its switch
            self.spark.sql(f"DROP TABLE {self._version_name(dead)}")
            self._folders.pop(dead, None)
        n = now + 1
        folder = f"{self.root}/v{n:06d}-{uuid.uuid4().hex[:8]}"
        self._write(rows.select(*self.schema.names), folder)
        self._create(n, folder)
        if self.partition is not None:
            fs, p = hadoop_path(self.spark, folder)
            written = {}
            for s in fs.listStatus(p):
                column, eq, value = s.getPath().getName().partition("=")
                if eq and column == self.partition:
                    written[None if value == _NULL else dt.date.fromisoformat(value)] = f"{folder}/{column}={value}"
            folders = {**others(), **written}
            self._add_partitions(n, folders)
            self._folders[n] = folders
        self._switch(n)
        self.vacuum()
        return n

    def _write(self, rows: DataFrame, folder: str) -> None:
        if self.partition is not None:
            # rebalance sizes tasks from the data: few files per folder, and a very large folder by several tasks
            rows = rows.hint("rebalance", self.partition)
        observation = None
        if self._metrics:
            # on top of the exchange, in the stage that writes: a task that is repeated counts once there
            observation = Observation(f"{self.table}-{uuid.uuid4().hex[:8]}")
            rows = rows.observe(observation, *[c.alias(k) for k, c in self._metrics.items()])
        writer = rows.write.partitionBy(self.partition) if self.partition is not None else rows.write
        writer.parquet(folder)
        self.observed = dict(observation.get) if observation is not None else {}

    def _create(self, n: int, folder: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        by = f"PARTITIONED BY (`{self.partition}`)" if self.partition else ""
        self.spark.sql(f"CREATE TABLE {self._version_name(n)} ({columns}) USING parquet {by} LOCATION {_quoted(folder)}")

    def _add_partitions(self, n: int, folders: dict[dt.date | None, str]) -> None:
        specs = [f"PARTITION (`{self.partition}` = {'NULL' if v is None else f'DATE {_quoted(v.isoformat())}'}) LOCATION {_quoted(f)}"
                 for v, f in folders.items()]
        for k in range(0, len(specs), _PER_STATEMENT):
            self.spark.sql(f"ALTER TABLE {self._version_name(n)} ADD {' '.join(specs[k:k + _PER_STATEMENT])}")

    def _switch(self, n: int) -> None:
        columns = ", ".join(f"`{f.name}`" + (f" COMMENT {_quoted(c)}" if (c := f.metadata.get("comment")) else "") for f in self.schema.fields)
        names = ", ".join(f"`{c}`" for c in self.schema.names)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} ({columns}) COMMENT {_quoted(self.comment)} "
                       f"TBLPROPERTIES ('{PROPERTY}' = '{n}') AS SELECT {names} FROM {self._version_name(n)}")

    def vacuum(self, keep: int = KEEP) -> None:
        """Take away versions before the last ``keep`` ones that readers saw, and folders that none of these has."""
        now = self.version()
        if now is None:
            return
        there = self.versions()
        kept = [n for n in there if n <= now][-keep:]
        used = {path for n in kept for path in self._paths(n)}
        dropped = [n for n in there if n not in kept]
        dead = {path for n in dropped for path in self._paths(n)} - used
        for n in dropped:
            self.spark.sql(f"DROP TABLE {self._version_name(n)}")
            self._folders.pop(n, None)
        fs, p = hadoop_path(self.spark, self.root)
        for s in fs.listStatus(p) if fs.exists(p) else []:
            path = s.getPath().toUri().getPath()
            if not re.match(r"v\d+-", s.getPath().getName()):
                continue
            if any(x == path or x.startswith(f"{path}/") for x in used):
                for x in dead:
                    if x.startswith(f"{path}/"):
                        delete(self.spark, f"{s.getPath()}{x[len(path):]}")
            else:
                delete(self.spark, str(s.getPath()))

    def _paths(self, n: int) -> set[str]:
        """Folders with files of a version, without scheme."""
        if self.partition is not None:
            return {urlparse(f).path for f in self.folders(n).values()}
        return {urlparse(unquote(f)).path.rpartition("/")[0] for f in self.spark.table(self._version_name(n)).inputFiles()}


def refresh(table: VersionedTable, build: Callable[[dt.date | None], DataFrame], key: tuple[str, ...],
            full_refresh: bool = False, lookback_days: int = LOOKBACK_DAYS) -> dict:
    """Full build or lookback merge of a dated table, by the rules of ``incremental.refresh_mart``, with one write.

    Folders from the cutoff on get the rows of ``build(cutoff)`` and the old rows whose keys these do not
    have; all other folders, and rows without date, stay as they are.
    """
    if full_refresh or table.version() is None:
        return {"mode": "full", "cutoff": None, "version": table.replace(build(None))}
    # the newest date is that of the newest folder: no scan
    dated = [v for v in table.folders(table.version()) if v is not None]
    cutoff = max(dated, default=EMPTY_TARGET_DATE) - dt.timedelta(days=lookback_days)
    window = table.read().filter(F.col(table.partition) >= F.lit(cutoff))
    now = [v for v in dated if v >= cutoff]
    n = table.rewrite(newest(build(cutoff), window, key), now)
    return {"mode": "incremental", "cutoff": cutoff, "version": n}
