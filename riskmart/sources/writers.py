"""Writing: partitioned and plain tables, CSV export, run metrics, messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = "run_id string, stage string, metric string, value double, detail string"


def write_partitioned(df: DataFrame, path: str, *by: str, fmt: str = "parquet") -> None:
    """Replace a table, one directory per value of a low-cardinality column.

    The rows stay where they are: each task writes one file per value it holds, with no shuffle.
    """
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.partitionBy(*by).save(path)


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace an unpartitioned table."""
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def export_csv(df: DataFrame, path: str, order: Sequence[str | Column], single_file: bool = False) -> None:
    """CSV in documented order: a range sort, so that file after file reads in order.

    ``single_file`` is for tables of bounded size only (days, segments, thresholds).
    """
    if single_file:
        ordered = df.coalesce(1).sortWithinPartitions(*order)
    else:
        ordered = df.orderBy(*order)
    ordered.write.mode("overwrite").option("header", True).csv(path)


def run_metrics(spark: SparkSession, run_id: str, stage: str, values: Mapping[str, object]) -> DataFrame:
    """A handful of summary values as rows; text goes to ``detail``."""
    rows = [
        (run_id, stage, k, float(v), None) if isinstance(v, (int, float)) else (run_id, stage, k, None, str(v))
        for k, v in values.items()
    ]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def append_run_metrics(metrics: DataFrame, path: str) -> None:
    metrics.select("run_id", "stage", "metric", "value", "detail").coalesce(1).write.mode("append").parquet(path)


def metrics_from_row(one_row: DataFrame, run_id: str, stage: str) -> DataFrame:
    """The columns of a one-row summary as metric rows, without fetching it."""
    columns = one_row.columns
    long = one_row.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "metric", "value")
    return long.select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "metric", "value", F.lit(None).cast("string").alias("detail")
    )


def write_messages(messages: DataFrame, target: str, fmt: str = "kafka", **options: str) -> None:
    """Send ``key, value`` rows: to a Kafka topic, or to a folder when the format is a file format."""
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.option("topic", target).save()
    else:
        writer.mode("append").save(target)
