"""Readers, writers and the materialisation point; what overwrites is in `commits`."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources import contracts


class PlanningTables:
    """The six inputs of a planning cycle. Each is opened when it is first used, and once only."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open = open_table

    @cached_property
    def materials(self) -> DataFrame:
        return self._open("materials")

    @cached_property
    def customers(self) -> DataFrame:
        return self._open("customers")

    @cached_property
    def actuals(self) -> DataFrame:
        return self._open("actuals")

    @cached_property
    def forecast(self) -> DataFrame:
        return self._open("forecast")

    @cached_property
    def inventory(self) -> DataFrame:
        return self._open("inventory")

    @cached_property
    def supply(self) -> DataFrame:
        return self._open("supply")


# Which table feeds which field of `PlanningTables`.
INPUTS = {
    "materials": contracts.MATERIAL_MASTER,
    "customers": contracts.CUSTOMER_MASTER,
    "actuals": contracts.DEMAND_ACTUALS,
    "forecast": contracts.DEMAND_FORECAST,
    "inventory": contracts.INVENTORY_SNAPSHOT,
    "supply": contracts.PLANNED_SUPPLY,
}


def read_table(spark: SparkSession, name: str, *, root: str | None = None, cast: bool = False) -> DataFrame:
    """A planning table from the catalog, or from Parquet below ``root``, checked against its contract."""
    df = spark.table(name) if root is None else spark.read.parquet(f"{root}/{name}")
    return contracts.enforce(df, name, cast=cast)


def read_inputs(spark: SparkSession, *, root: str | None = None, cast: bool = False) -> PlanningTables:
    return PlanningTables(lambda field: read_table(spark, INPUTS[field], root=root, cast=cast))


def create_table(df: DataFrame, name: str) -> DataFrame:
    """Create a catalog table from a query; fails if the table exists."""
    df.write.mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def stage_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or a folder of the warehouse, which all
    executors share as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stage"


_stored_paths: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate result that several passes read, and cut its lineage there.

    A Parquet table rather than an RDD checkpoint: readers keep column pruning and size statistics, and the rows
    are computed once, here and now. `release` removes what was stored.
    """
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored_paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    """A mark for `release`."""
    return len(_stored_paths)


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Remove the intermediate tables stored since a mark, or between two. Their readers must be done."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in _stored_paths[since:until]:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    del _stored_paths[since:until]
