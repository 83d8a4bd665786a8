"""A numbered log of small text entries, each written whole or not at all, for decisions that several jobs may race for.

Whoever appends names the last entry it has seen; if another job appended meanwhile, the append fails and nothing has changed. An entry is drafted
under a hidden name and renamed to its number, without overwriting: on HDFS and the other file systems whose rename is atomic, exactly one of
several writers wins. Object stores without such a rename need a committer that has one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class Entry(NamedTuple):
    version: int
    text: str
    written: datetime


def _hadoop(spark: SparkSession, path: str):
    """(package, qualified path, its file system, configuration) of a path that may be in any store Spark can open."""
    package, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fs = package.Path(path).getFileSystem(conf)
    return package, fs.makeQualified(package.Path(path)), fs, conf


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False if there is one of that name."""
    package, target, fs, conf = _hadoop(spark, path)
    if fs.exists(target):
        return False
    draft = package.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    context = package.FileContext.getFileContext(target.toUri(), conf)
    kind = getattr(package, "Options$Rename")
    try:
        context.rename(draft, target, spark.sparkContext._gateway.new_array(kind, 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    _, target, fs, _ = _hadoop(spark, path)
    fs.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, seconds since 1970 of its last change) of the folders in a folder."""
    _, target, fs, _ = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(target) if s.isDirectory()]


@dataclass(frozen=True)
class CommitLog:
    """One file per entry, named by its number; entries are as few as the decisions."""

    path: str

    def read(self, spark: SparkSession) -> list[Entry]:
        try:
            files = spark.read.text(self.path, wholetext=True)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        rows = files.select(F.col("_metadata.file_name").alias("name"), "value", F.col("_metadata.file_modification_time").alias("written")).collect()
        return sorted(Entry(int(r.name), r.value, r.written) for r in rows)

    def append(self, spark: SparkSession, after: int, text: str) -> bool:
        """Add the entry that follows number ``after`` (0 in an empty log); False if another job was faster."""
        return publish(spark, f"{self.path}/{after + 1:012d}", text)
