"""Exact quantiles of unbounded groups.

Spark's exact ``percentile`` keeps all distinct values of a group in one task. Here equal values are
collapsed to counts, the counts are range-partitioned by value and written once, a small table of
partition totals says in which range each wanted rank lies, and only those ranges are scanned.
No task ever holds more than one range of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.session import cut_lineage

ALL = "all"


def value_counts(df: DataFrame, value: Column | str, by: str | None = None) -> DataFrame:
    """``grp, value, n``: one row per group and distinct value."""
    value = F.col(value) if isinstance(value, str) else value
    group = F.lit(ALL) if by is None else F.col(by).cast("string")
    return (
        df.select(group.alias("grp"), value.cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("grp", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ordered_ranges(counts: DataFrame, with_all: bool = False) -> DataFrame:
    """The counts in value ranges numbered by ``part``, written once so the numbering is final.

    ``with_all`` adds the group ``all`` on reading: its rows repeat a value once per group, which
    changes neither ranks nor sums.
    """
    ranged = counts.repartitionByRange(F.col("value"), F.col("grp")).withColumn("part", F.spark_partition_id())
    stored = cut_lineage(ranged, "value-ranges")
    if not with_all:
        return stored
    return stored.select(F.explode(F.array(F.lit(ALL), F.col("grp"))).alias("grp"), "value", "n", "part")


def quantiles_from_ranges(ranges: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``grp, prob, quantile`` with linear interpolation between neighbouring ranks."""
    # groups x ranges rows: bounded by the number of shuffle partitions
    totals = ranges.groupBy("grp", "part").agg(F.sum("n").alias("part_n"))
    by_part = Window.partitionBy("grp").orderBy("part")
    before = F.sum("part_n").over(by_part) - F.col("part_n")
    placed = totals.select(
        "grp", "part", before.alias("first_rank"), "part_n",
        F.sum("part_n").over(Window.partitionBy("grp")).alias("n_rows"),
    )
    wanted = placed.select(
        "grp", "part", "first_rank", "part_n", "n_rows",
        F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"),
    ).withColumn("pos", F.col("prob") * (F.col("n_rows") - 1).cast("double"))
    ranks = wanted.select(
        "grp", "part", "first_rank", "part_n", "prob", "pos",
        F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("target"),
    ).filter((F.col("target") >= F.col("first_rank")) & (F.col("target") < F.col("first_rank") + F.col("part_n")))

    # A handful of (group, range) pairs: as one value they filter the scan, so the ranges that are
    # not wanted are never shuffled.
    pair = F.concat_ws("/", F.col("part").cast("string"), F.col("grp"))
    needed = ranks.agg(F.collect_set(pair)).scalar()
    # row by row: group `all` holds equal values once per class, and peers must not share an offset
    in_range = Window.partitionBy("grp", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("n").over(in_range)
    scanned = ranges.filter(F.array_contains(needed, pair)).select(
        "grp", "part", "value", (upto - F.col("n")).alias("from_offset"), upto.alias("to_offset")
    )
    offset = F.col("target") - F.col("first_rank")
    hits = ranks.join(scanned, ["grp", "part"]).filter(
        (offset >= F.col("from_offset")) & (offset < F.col("to_offset"))
    )
    low, high = F.min("value"), F.max("value")
    share = F.first("pos") - F.floor(F.first("pos"))
    return hits.groupBy("grp", "prob").agg((low + (high - low) * share).alias("quantile"))


def exact_quantiles(df: DataFrame, value: Column | str, probs: Sequence[float], by: str | None = None) -> DataFrame:
    return quantiles_from_ranges(ordered_ranges(value_counts(df, value, by), with_all=by is not None), probs)
