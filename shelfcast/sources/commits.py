"""Overwriting as a commit: stored cycles behind a manifest, catalog tables behind a view.

New rows are complete in a place of their own before one small change makes them the current ones. Whatever fails before
that change leaves readers with the old rows; nothing they may still read is removed before it.

A cycle below ``root``::

    <table>/Cycle_Date=2026-08-31/Run=r<id>/*.parquet     the rows that one run wrote
    _commits/2026-08-31/00000007.json                     which run each table of the cycle is read from

The manifest with the highest number that is complete is the current one. It names all tables of the cycle, so a reader
never sees the report of one run beside the profile of another.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
KEPT_COMMITS = 2  # the current one, and the one that running readers may have opened
VERSION = "__v_"


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


class NoSuchCycle(FileNotFoundError):
    """No committed run has the table."""


class _Files:
    """The file system of a folder, by its Hadoop interface: the folder need not be local."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._text = spark._jvm.org.apache.commons.io.IOUtils.toString
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._files.listStatus(path)) if self._files.exists(path) else []

    def read(self, file: str) -> str:
        stream = self._files.open(self._path(file))
        try:
            return self._text(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, file: str, text: str) -> None:
        """Fails if the file exists."""
        stream = self._files.create(self._path(file), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def exists(self, file: str) -> bool:
        return self._files.exists(self._path(file))

    def modified(self, folder: str) -> float:
        return self._files.getFileStatus(self._path(folder)).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def _number(name: str) -> int:
    return int(name.removesuffix(".json"))


def _commits(files: _Files, root: str, cycle: str) -> list[str]:
    return [n for n in files.names(f"{root}/{COMMITS}/{cycle}") if n.endswith(".json")]


def _manifest(files: _Files, root: str, cycle: str, name: str) -> dict[str, str] | None:
    """The run of each table; None if the writer of the file did not get to its end."""
    try:
        return json.loads(files.read(f"{root}/{COMMITS}/{cycle}/{name}"))["tables"]
    except ValueError:
        return None


def _current(files: _Files, root: str, cycle: str) -> dict[str, str]:
    for name in reversed(_commits(files, root, cycle)):
        tables = _manifest(files, root, cycle, name)
        if tables is not None:
            return tables
    return {}


def committed_tables(spark: SparkSession, root: str, cycle: dt.date) -> dict[str, str]:
    """The tables of a cycle and the run each is read from; empty if nothing was committed."""
    return _current(_Files(spark, root), root, f"{cycle:%Y-%m-%d}")


def _folder(root: str, name: str, cycle: str, run: str) -> str:
    return f"{root}/{name}/Cycle_Date={cycle}/Run={run}"


def _read(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/{name}").parquet(*folders).drop("Run")


def read_cycle(spark: SparkSession, root: str, name: str, cycle: dt.date | None = None) -> DataFrame:
    """A stored table as it was last committed: one cycle (only its folder is listed), or all of them, with ``Cycle_Date``."""
    files = _Files(spark, root)
    cycles = files.names(f"{root}/{COMMITS}") if cycle is None else [f"{cycle:%Y-%m-%d}"]
    runs = {c: _current(files, root, c).get(name) for c in cycles}
    folders = [_folder(root, name, c, run) for c, run in runs.items() if run is not None]
    if not folders:
        raise NoSuchCycle(f"{root}/{name}: nothing committed" + ("" if cycle is None else f" for {cycle}"))
    df = _read(spark, root, name, folders)
    return df if cycle is None else df.filter(F.col("Cycle_Date") == F.lit(cycle))


class CycleRun:
    """One run of a cycle. Calling it stores a table, ``commit`` makes all stored ones current at once, ``abort`` removes them.

    Until the commit only the run itself sees its tables. A run that fails or is killed changes nothing; `vacuum` removes
    what a killed one left.
    """

    def __init__(self, root: str, cycle: dt.date) -> None:
        self.root, self.cycle = root, f"{cycle:%Y-%m-%d}"
        self._begin()

    def _begin(self) -> None:
        self.run, self.tables, self._begun, self._base = f"r{uuid.uuid4().hex}", {}, [], None
        self._spark: SparkSession | None = None

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if self._spark is None:
            self._spark = df.sparkSession
            # What this run builds on: a commit by another run in between is a conflict.
            self._base = self._last(_Files(self._spark, self.root))
        folder = _folder(self.root, name, self.cycle, self.run)
        self._begun.append(folder)
        df.drop("Cycle_Date", "Run").write.mode("overwrite").parquet(folder)
        self.tables[name] = self.run
        return _read(self._spark, self.root, name, [folder])

    def _last(self, files: _Files) -> int:
        return max(map(_number, _commits(files, self.root, self.cycle)), default=0)

    def commit(self, *, whole: bool = True) -> None:
        """Make the stored tables current: with ``whole`` the cycle consists of them, otherwise its other tables stay."""
        if self._spark is None:
            return
        files = _Files(self._spark, self.root)
        if self._last(files) != self._base:
            raise CommitConflict(f"{self.root}: cycle {self.cycle} was committed by another run")
        tables = self.tables if whole else _current(files, self.root, self.cycle) | self.tables
        _publish(files, f"{self.root}/{COMMITS}/{self.cycle}/{self._base + 1:08d}.json", tables)
        _prune(files, self.root, self.cycle)
        self._begin()

    def abort(self) -> None:
        if self._spark is not None:
            files = _Files(self._spark, self.root)
            for folder in self._begun:
                files.delete(folder)
            self._begin()


def _publish(files: _Files, file: str, tables: Mapping[str, str]) -> None:
    """The one change that readers see. Creating the file fails if it exists, so of two runs one commits."""
    try:
        files.create(file, json.dumps({"tables": dict(tables)}))
    except Exception as error:
        if files.exists(file):
            raise CommitConflict(f"{file} exists") from error
        raise


def _prune(files: _Files, root: str, cycle: str) -> None:
    """Remove manifests beyond the last ``KEPT_COMMITS``, and first the rows that only they name."""
    known = {name: _manifest(files, root, cycle, name) for name in _commits(files, root, cycle)}
    whole = [name for name, tables in known.items() if tables is not None]
    kept = set(whole[-KEPT_COMMITS:])
    used = {x for name in kept for x in known[name].items()}
    for name, tables in known.items():
        if name not in kept and name < max(kept, default=""):
            for table, run in set((tables or {}).items()) - used:
                files.delete(_folder(root, table, cycle, run))
            files.delete(f"{root}/{COMMITS}/{cycle}/{name}")


def vacuum(spark: SparkSession, root: str, *, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove rows of runs that no manifest names and that are older than any run still at work; returns their folders."""
    files, before, removed = _Files(spark, root), dt.datetime.now().timestamp() - older_than.total_seconds(), []
    for name in files.names(root):
        for part in [] if name.startswith("_") else files.names(f"{root}/{name}"):
            cycle = part.removeprefix("Cycle_Date=")
            manifests = [_manifest(files, root, cycle, m) or {} for m in _commits(files, root, cycle)]
            for run in files.names(f"{root}/{name}/{part}"):
                folder = f"{root}/{name}/{part}/{run}"
                named = any(m.get(name) == run.removeprefix("Run=") for m in manifests)
                if not named and files.modified(folder) <= before:
                    files.delete(folder)
                    removed.append(folder)
    return removed


def write_cycle(df: DataFrame, root: str, name: str, cycle: dt.date) -> DataFrame:
    """Write one table of a cycle below ``root``, commit it and read it back; the cycle's other tables stay.

    A rerun replaces the rows, also by an empty result; other cycles stay.
    """
    run = CycleRun(root, cycle)
    try:
        run(df, name)
        run.commit(whole=False)
    except BaseException:
        run.abort()
        raise
    return read_cycle(df.sparkSession, root, name, cycle)


# --- catalog tables ------------------------------------------------------------------------------------------------


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _kind(spark: SparkSession, name: str) -> str | None:
    try:
        return spark.catalog.getTable(name).tableType
    except AnalysisException:
        return None


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a table, oldest first."""
    *database, table = name.split(".")
    found = spark.catalog.listTables(database[0] if database else None, f"{table}{VERSION}*")
    return sorted(".".join([*database, t.name]) for t in found if not t.isTemporary)


def replace_table(df: DataFrame, name: str, *, buckets: int = 0, bucket_by: str = "Material_ID", **options: Any) -> DataFrame:
    """Create or replace a catalog table from a query and read it back.

    Every replacement is a table of its own, written whole, and ``name`` a view of the last one: replacing it is one
    catalog change, the columns may change, and a failed write keeps the old rows. The plan may read the table it replaces. The
    version before stays for those who have opened it; older ones go. A plain table of that name becomes the first version.

    With ``buckets`` the rows are written in buckets of ``bucket_by``, and later windows, joins and aggregations on that
    column need no shuffle, through the view as well. Every task writes its own part of each bucket: a hot key's rows are
    not sent to one task first.
    """
    spark = df.sparkSession
    before = _versions(spark, name)
    # Numbered, so that they sort by age; the rest keeps two writers apart.
    version = f"{name}{VERSION}{int(before[-1].rpartition(VERSION)[2][:8]) + 1 if before else 1:08d}_{uuid.uuid4().hex}"
    writer = df.write.options(**options)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.mode("errorifexists").saveAsTable(version)
        _point(spark, name, version)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")
        raise
    for old in before[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(old)}")
    return spark.table(name)


def _point(spark: SparkSession, name: str, version: str) -> None:
    """Make ``name`` a view of ``version``."""
    view = f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(version)}"
    if _kind(spark, name) in (None, "VIEW"):
        spark.sql(view)
        return
    first = f"{name}{VERSION}{0:08d}_{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(first)}")
    try:
        spark.sql(view)
    except BaseException:
        spark.sql(f"ALTER TABLE {_quoted(first)} RENAME TO {_quoted(name)}")
        raise


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a catalog table, or a replaceable one with all its versions."""
    versions = _versions(spark, name)
    spark.sql(f"DROP {'VIEW' if _kind(spark, name) == 'VIEW' else 'TABLE'} IF EXISTS {_quoted(name)}")
    for version in versions:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")
