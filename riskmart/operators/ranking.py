"""Ordered output and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.session import cut_lineage


def ordered_output(df: DataFrame, *order: str | Column) -> DataFrame:
    """Documented order of a table. Sort when reading or exporting, never before a table write."""
    return df.orderBy(*order)


def with_position(ordered: DataFrame) -> DataFrame:
    """Adds ``position`` (from 1) to a sorted frame, as its rows actually lie.

    A global sort leaves ranges in order, rows in order inside each. The place in its range and the number of its range are written down
    with each row; the rows of the ranges before are added afterwards. No task sees more than its own range.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = cut_lineage(ordered.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), "ordered")
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # one row per range
    placed = stored.join(sizes.select("_part", before.alias("_before")), "_part")
    return placed.select(*ordered.columns, (F.col("_before") + F.col("_place") + 1).alias("position"))


def top_segments(segments: DataFrame, k: int = 12, by: Column | str = "rate_pct", tie: str = "value") -> DataFrame:
    """The ``k`` highest rates of one dimension."""
    by = F.col(by) if isinstance(by, str) else by
    return segments.orderBy(by.desc(), F.col(tie)).limit(k)


def top_segments_per_panel(segments: DataFrame, panels: Sequence[str], k: int = 8) -> DataFrame:
    """The ``k`` highest rates of each chosen segment."""
    rank = F.row_number().over(Window.partitionBy("segment").orderBy(F.col("rate_pct").desc(), "value"))
    ranked = segments.filter(F.col("segment").isin(*panels)).withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= k)


def top_null_columns(profile: DataFrame, k: int = 10) -> DataFrame:
    return profile.orderBy(F.col("null_fraction").desc(), "column_name").limit(k)


def render_label(label: str) -> Column:
    return F.when(F.col(label) == 1, F.lit("Sí")).otherwise(F.lit("No"))


def latest_alerts(
    scored: DataFrame, label: str, key: str, time: str = "scored_ts", k: int = 10, alert: str = "alert"
) -> DataFrame:
    """Most recent alerts by scoring time, then hour, then key; the class shown as yes or no."""
    flagged = scored.filter(F.col(alert)).withColumn("was_positive", render_label(label))
    return flagged.orderBy(F.col(time).desc(), F.col("hour").desc(), F.col(key).desc()).limit(k)


def alert_queue(scored: DataFrame, day: int, label: str, key: str, score: str = "score", alert: str = "alert") -> DataFrame:
    """All alerts of one day, highest score first."""
    flagged = scored.filter((F.col("day") == day) & F.col(alert)).withColumn("was_positive", render_label(label))
    return flagged.orderBy(F.col(score).desc(), key)
