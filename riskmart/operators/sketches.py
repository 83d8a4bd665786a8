"""Mergeable sketches as measures: quantiles and distinct counts of any slice of days, without reading the facts again.

A sketch is a small binary value that merges like a sum: a daily table of sketches answers for every set of days and, where it is kept per
dimension, for every slice of the cube. Quantile sketches (KLL) return values that occur, whose rank is off by at most ``rank_error`` of all rows with
99 % confidence; distinct counts (HLL) are off by ``distinct_error`` of the count, one standard deviation. The exact forms are ``profile`` and ``kpis``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.measures import additive_sums, units
from riskmart.functions.text import or_no_data
from riskmart.operators.kpis import SUMS
from riskmart.operators.quantiles import ALL

QUANTILE_SIZE = 400
DISTINCT_BITS = 12
#: quantiles on which rows beyond a fence are counted
BOX_STEPS = 500


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Share of all rows by which the rank of a returned value may be off (99 % confidence), as the sketch's authors state it."""
    return 2.296 / size**0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Relative standard deviation of a distinct count."""
    return 1.04 / 2 ** (bits / 2)


# ----------------------------------------------------------------------- quantiles


def daily_quantiles(df: DataFrame, value: str, label: str, day: str = "day", size: int = QUANTILE_SIZE) -> DataFrame:
    """``day, grp, n, min_value, max_value, sketch``: one row per day and class, combined in each task before the shuffle.

    Nulls and NaN of the value take no part; rows without a class are a class of their own (null).
    """
    v = F.col(value).cast("double")
    kept = df.filter(v.isNotNull() & ~F.isnan(v)).select(F.col(day).alias("day"), F.col(label).cast("string").alias("grp"), v.alias("v"))
    return kept.groupBy("day", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min_value"), F.max("v").alias("max_value"),
        F.kll_sketch_agg_double("v", F.lit(size)).alias("sketch"),
    )


def merged_quantiles(daily: DataFrame, with_all: bool = True) -> DataFrame:
    """``grp, n, min_value, max_value, sketch`` over the days of ``daily``: a slice of it, or the whole."""
    groups = F.array(F.lit(ALL), F.col("grp")) if with_all else F.array("grp")
    each = daily.select(F.explode(groups).alias("grp"), "n", "min_value", "max_value", "sketch")
    return each.groupBy("grp").agg(
        F.sum("n").alias("n"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def _quantile(prob: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(float(prob)))


def percentiles_from_sketches(daily: DataFrame, probs: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """As ``percentiles_by_class``, from sketches: count and extremes are exact, percentiles within ``rank_error``."""
    return merged_quantiles(daily).select(
        F.col("grp").alias("class"), "n", "min_value", "max_value", *[_quantile(p).alias(f"p{round(100 * p):02d}") for p in probs]
    )


def box_from_sketches(daily: DataFrame, reach: float = 1.5) -> DataFrame:
    """Quartiles, fences at ``reach`` times the box height and the number of rows beyond them, from sketches.

    Outliers are counted on a grid of quantiles: the count is off by at most twice ``rank_error`` and one step of the grid, as a share of the rows.
    """
    quartiles = merged_quantiles(daily.filter(F.col("grp").isNotNull()), with_all=False).select(
        F.col("grp").alias("class"), "n", "min_value", "max_value", "sketch", *[_quantile(p).alias(c) for p, c in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    height = F.lit(reach) * (F.col("q3") - F.col("q1"))
    fenced = quartiles.withColumns({"low_fence": F.col("q1") - height, "high_fence": F.col("q3") + height})
    grid = F.kll_sketch_get_quantile_double(F.col("sketch"), F.array(*[F.lit((i + 0.5) / BOX_STEPS) for i in range(BOX_STEPS)]))
    beyond = F.size(F.filter(grid, lambda v: (v < F.col("low_fence")) | (v > F.col("high_fence")))) / F.lit(float(BOX_STEPS))
    return fenced.select("class", "n", "q1", "median", "q3", "low_fence", "high_fence", F.round(F.col("n") * beyond).cast("bigint").alias("outliers"))


# ----------------------------------------------------------------------- distinct counts


def cube_with_distinct(
    df: DataFrame, dims: Sequence[str], label: str, amount: str, distinct: Mapping[str, str], day: str = "day", bits: int = DISTINCT_BITS
) -> DataFrame:
    """The sums of the daily cube and, for every ``name: column`` of ``distinct``, a sketch of its values as one more additive measure.

    Values are compared as text; nulls are not counted.
    """
    present = [d for d in dims if d in df.columns]
    keys = [F.col(day).alias("day")] + [or_no_data(F.col(d)).alias(d) for d in present]
    counted = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(name) for name, c in distinct.items()]
    return df.groupBy(*keys).agg(*additive_sums(label, units(amount)), *counted)


def slice_distinct(cube: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and estimated distinct counts of a slice of the cube, per ``by``: sketches merge as sums add up."""
    merged = cube.groupBy(*by).agg(
        F.coalesce(F.sum(SUMS[0]), F.lit(0)).alias(SUMS[0]), *[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    )
    return merged.select(*by, SUMS[0], *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in names])
