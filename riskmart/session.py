"""Session builder and the shared scratch area."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from riskmart.sources.commits import remove


def build_session(app: str = "riskmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for; caller settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a hot join key must be split even when the split costs one more exchange
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
        # the keys a stream remembers may outgrow an executor's heap
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master is not None:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    A local session without the setting gets its own temporary folder; a cluster without it is
    refused, because a machine-local folder is lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_shared_dir()


_LOCAL: list[str] = []


def _local_shared_dir() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="riskmart-"))
    return _LOCAL[0]


#: the intermediate tables of the innermost scope of this thread
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, also after a failure: what is read from them must have been written by then."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            remove(spark, path)


def scoped(stage: Callable) -> Callable:
    """A function of a session (and more) that returns plain values, with a scratch scope of its own."""

    @functools.wraps(stage)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return stage(spark, *args, **kwargs)

    return run


def in_scope(path: str) -> str:
    """``path``, to be deleted with the scope it was named in, if there is one."""
    paths = _SCOPE.get()
    if paths is not None:
        paths.append(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return in_scope(f"{shared_dir(spark)}/riskmart/{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that later jobs neither repeat it nor lose it with an executor.

    Without a path it goes to the shared folder; it is deleted with the scratch scope it was written in, or, without one, under the
    retention that folder has for checkpoints.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
