"""Tables by name whose overwrite is one step: rows go to a new version beside the old one, then the name is switched.

A version is a folder that is written once. Which one is current is the last entry of a commit log, so of two writers that started from the same
version one wins and the other is told. The name in the catalog is a view of the current version; it is made anew from the log in a session whose
catalog does not know it. A writer that dies before the switch leaves the old rows readable; ``drop_versions`` deletes what it left.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskmart.sources.commits import CommitLog, folders, remove


@dataclass(frozen=True)
class NamedTable:
    """A table called ``name`` (with its database, if any), whose versions are kept below ``root``."""

    name: str
    root: str
    fmt: str = "parquet"

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name.replace('.', '/')}"

    @property
    def log(self) -> CommitLog:
        return CommitLog(f"{self.path}.log")


class Overtaken(RuntimeError):
    """Another writer has switched the table since this one started."""


def _show(spark: SparkSession, table: NamedTable, version: str) -> None:
    folder = f"{table.path}/{version}".replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {table.name} AS SELECT * FROM {table.fmt}.`{folder}`")


def overwrite(rows: DataFrame, table: NamedTable, *by: str) -> None:
    """Replace rows and columns of the table (``by``: partition columns). Until the last step readers see the old ones."""
    spark = rows.sparkSession
    before = table.log.read(spark)
    version = f"v-{uuid.uuid4().hex}"
    rows.write.format(table.fmt).mode("errorifexists").partitionBy(*by).save(f"{table.path}/{version}")
    if not table.log.append(spark, before[-1].version if before else 0, version):
        raise Overtaken(f"{table.name} was replaced while it was written")
    _show(spark, table, version)


def exists(spark: SparkSession, table: NamedTable) -> bool:
    return spark.catalog.tableExists(table.name) or bool(table.log.read(spark))


def read(spark: SparkSession, table: NamedTable) -> DataFrame:
    """The current version, by name; the name is made to show what the log says."""
    entries = table.log.read(spark)
    if not entries:
        raise ValueError(f"there is no table {table.name}")
    _show(spark, table, entries[-1].text)
    return spark.table(table.name)


def drop_versions(spark: SparkSession, table: NamedTable, grace_s: float = 24 * 3600) -> int:
    """Delete versions that are not current and were last changed more than ``grace_s`` seconds ago; returns how many."""
    entries = table.log.read(spark)
    current = entries[-1].text if entries else None
    old = [n for n, changed in folders(spark, table.path) if n != current and n.startswith("v-") and changed < time.time() - grace_s]
    for name in old:
        remove(spark, f"{table.path}/{name}")
    return len(old)
