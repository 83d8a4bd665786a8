"""Running totals over a global order, without a task that holds a whole group.

Rows are range-partitioned, numbered by range and written once. Ranges and their totals are few; a running
total is the total of the ranges before, plus a running sum inside the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.session import cut_lineage


def numbered_ranges(df: DataFrame, order: Sequence[str | Column], name: str, path: str | None = None) -> DataFrame:
    """``df`` in ranges of ``order``, numbered by ``part``; writes at once, so that the numbers are final."""
    return cut_lineage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name, path)


def running_totals(ranges: DataFrame, totals: dict[str, str], order: Sequence[str | Column], by: str | None = None) -> DataFrame:
    """Adds for every ``out: value`` of ``totals`` the sum of ``value`` up to and with the row, in ``order``, per ``by`` (or over all rows).

    ``order`` must settle every tie but those between equal rows, and begin with ``by`` if that is given. Nulls in
    ``by`` are a group of their own.
    """
    group = [] if by is None else [by]
    per_range = ranges.groupBy(*group, "part").agg(*[F.sum(v).alias(f"_{out}_sum") for out, v in totals.items()])
    # one row per range and group: the window without partitions is bounded by the number of ranges
    before = Window.partitionBy(*group).orderBy("part") if group else Window.orderBy("part")
    offsets = per_range.select(
        *group, "part", *[(F.sum(f"_{out}_sum").over(before) - F.col(f"_{out}_sum")).alias(f"_{out}_before") for out in totals]
    )
    inside = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranges.withColumns({f"_{out}_inside": F.sum(v).over(inside) for out, v in totals.items()})
    match = F.col("r.part") == F.col("o.part")
    if by is not None:
        match = match & F.col(f"r.{by}").eqNullSafe(F.col(f"o.{by}"))
    joined = summed.alias("r").join(offsets.alias("o"), match)
    return joined.select(*[F.col(f"r.`{c}`") for c in ranges.columns], *[(F.col(f"_{out}_before") + F.col(f"_{out}_inside")).alias(out) for out in totals])
