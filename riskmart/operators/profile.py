"""Profiling: distributions, nulls, correlations, spans and the facts of a report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions.measures import EXACT, UNITS, count_if, half_up, units
from riskmart.operators import quantiles as q


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column, in one pass."""
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(
        *[fn(F.col(c).cast("double")).cast("double").alias(f"{c}|{s}") for c in columns for s, fn in stats.items()]
    )
    per_column = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in columns
    ]
    return row.select(F.inline(F.array(*per_column))).select(
        "column_name",
        F.col("count").cast("bigint").alias("n"),
        F.round("mean", digits).alias("mean_value"),
        F.round("stddev", digits).alias("stddev_value"),
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
    )


def percentiles_by_class(df: DataFrame, value: str, label: str, probs: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Count, mean, extremes and exact percentiles, overall (``all``) and per class."""
    ranges = q.ordered_ranges(q.value_counts(df, value, label), with_all=True)
    summary = ranges.groupBy("grp").agg(
        F.sum("n").alias("n"),
        # value x count in exact units, so the mean does not depend on the order of the sum
        (F.sum(units("value").cast(EXACT) * F.col("n")).cast("double") / F.sum("n").cast("double") / F.lit(float(UNITS))).alias("mean"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    wide = (
        q.quantiles_from_ranges(ranges, probs)
        .groupBy("grp")
        .pivot("prob", [float(p) for p in probs])
        .agg(F.first("quantile"))
    )
    wide = wide.toDF("grp", *[f"p{round(100 * p):02d}" for p in probs])
    return summary.join(wide, "grp").select(
        F.col("grp").alias("class"), "n", F.round("mean", 6).alias("mean_value"), "min_value", "max_value",
        *[F.round(c, 6).alias(c) for c in wide.columns[1:]],
    )


def box_stats(df: DataFrame, value: str, label: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value within ``reach`` times the box height, outlier count."""
    counts = q.value_counts(df.filter(F.col(label).isNotNull()), value, label)
    ranges = q.ordered_ranges(counts)
    quartiles = (
        q.quantiles_from_ranges(ranges, (0.25, 0.5, 0.75))
        .groupBy("grp")
        .pivot("prob", [0.25, 0.5, 0.75])
        .agg(F.first("quantile"))
        .toDF("grp", "q1", "median", "q3")
    )
    height = F.col("q3") - F.col("q1")
    fence = F.struct((F.col("q1") - F.lit(reach) * height).alias("low"), (F.col("q3") + F.lit(reach) * height).alias("high"))
    # one entry per class: looked up as a value, so the counts are neither joined nor shuffled by class
    fences = quartiles.agg(F.map_from_entries(F.collect_list(F.struct("grp", fence)))).scalar()
    mine = F.element_at(fences, F.col("grp"))
    inside = (F.col("value") >= mine["low"]) & (F.col("value") <= mine["high"])
    whiskers = ranges.groupBy("grp").agg(
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )
    return quartiles.join(whiskers, "grp").select(
        F.col("grp").alias("class"), *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
        "low_whisker", "high_whisker", "outliers",
    )


def amount_histogram(df: DataFrame, amount: str, label: str, edges: int = 50) -> DataFrame:
    """Density of log(1 + amount) per class over common equal bins; the last bin is closed.

    If all amounts are equal, so are all edges: only the closed bin holds them, without a density.
    """
    bins = edges - 1
    logged = df.select(F.col(label).alias("label"), F.log1p(F.col(amount)).alias("x"))
    span = logged.agg(
        F.struct(F.min("x").alias("low"), ((F.max("x") - F.min("x")) / F.lit(float(bins))).alias("width"))
    ).scalar()
    low, width = span["low"], F.nullif(span["width"], F.lit(0.0))
    slot = F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1).cast("bigint"))
    counts = (
        logged.filter(F.col("label").isNotNull() & F.col("x").isNotNull())
        .groupBy("label", slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_class = F.sum("n").over(Window.partitionBy("label"))  # at most `bins` rows per class
    return counts.select(
        "label", "bin", "n",
        F.round(F.col("n").cast("double") / (per_class.cast("double") * width), 6).alias("density"),
    )


def score_histogram(df: DataFrame, score: str, label: str, bin_points: int = 250) -> DataFrame:
    """Share of each class per score bin; the bin is counted in ten-thousandths (250 = 0.025)."""
    slot = (units(score) - F.pmod(units(score), F.lit(bin_points).cast("bigint"))).cast("double") / F.lit(float(UNITS))
    counts = df.groupBy(F.col(label).alias("label"), slot.alias("bin_start")).agg(F.count(F.lit(1)).alias("n"))
    per_class = F.sum("n").over(Window.partitionBy("label"))  # bounded by the number of bins
    return counts.select("label", "bin_start", "n", half_up(F.col("n") * 100, per_class, 4).alias("share_pct"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r of every pair of columns where both values are present; null without such a row, NaN where a column does not vary there.

    One aggregate per pair does not survive forty columns. Each row is instead opened into its pairs of values, and central moments are
    combined per pair in the same stage, so what is shuffled is pairs times tasks, however many rows there are. The moments move with
    the mean as rows come in: no pass for the means. A column varies if its least and greatest value differ.
    """
    columns = list(columns)

    missing = F.lit(None).cast("double")
    rows = df.select(F.array(*[F.nanvl(F.col(f"`{c}`").cast("double"), missing) for c in columns]).alias("v"))
    # a row of nulls: every pair is in the result, also of an empty table
    rows = rows.union(df.sparkSession.range(0, 1, 1, 1).select(F.array(*[missing for _ in columns]).alias("v")))
    # "outer" only spares the optimizer a filter on the size of the array, which holds all columns
    first = rows.select("v", F.posexplode_outer("v").alias("i", "x"))
    pairs = first.select("i", "x", F.posexplode_outer("v").alias("j", "y")).filter("j > i")
    x, y = F.when(F.col("y").isNotNull(), F.col("x")), F.when(F.col("x").isNotNull(), F.col("y"))
    moments = pairs.groupBy("i", "j").agg(
        F.covar_pop("x", "y").alias("xy"), F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"),
        ((F.min(x) < F.max(x)) & (F.min(y) < F.max(y))).alias("vary"),
    )
    r = F.when(F.col("vary"), F.try_divide(F.try_divide("xy", F.sqrt("xx")), F.sqrt("yy")))
    r = F.when(F.col("xy").isNotNull(), F.coalesce(r, F.lit(float("nan"))))
    names = F.array(*[F.lit(c) for c in columns])
    return moments.select(
        F.element_at(names, F.col("i") + 1).alias("left_column"), F.element_at(names, F.col("j") + 1).alias("right_column"),
        F.round(r, digits).alias("r"),
    )


def redundant_pairs(matrix: DataFrame, above: float = 0.9) -> DataFrame:
    return matrix.filter(F.abs(F.col("r")) > F.lit(above))


def null_buckets(profile: DataFrame) -> DataFrame:
    """How many columns are mostly, half or never null, and the share of null cells."""
    f = F.col("null_fraction")
    return profile.agg(
        count_if(f > 0.9).alias("over_90"),
        count_if(f > 0.5).alias("over_50"),
        count_if(f == 0).alias("without_nulls"),
        count_if(f > 0).alias("with_nulls"),
        half_up(F.sum("nulls") * 100, F.sum("n_rows"), 1).alias("null_cells_pct"),
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key. Grouping by key pre-aggregates copies before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def time_span(df: DataFrame, seconds: str) -> DataFrame:
    """First and last second, the span in days and the rows per day."""
    s = F.col(seconds)
    days = (F.max(s) - F.min(s)).cast("double") / F.lit(86400.0)
    return df.agg(
        F.min(s).alias("first_second"),
        F.max(s).alias("last_second"),
        F.round(days, 4).alias("span_days"),
        F.round(F.count(F.lit(1)).cast("double") / F.nullif(days, F.lit(0.0)), 4).alias("rows_per_day"),
    )


def _fact(df: DataFrame, fact: str, subject: Column, value: Column) -> DataFrame:
    return df.select(F.lit(fact).alias("fact"), subject.cast("string").alias("subject"), value.cast("double").alias("value"))


def findings(
    totals: DataFrame, nulls: DataFrame, amounts: DataFrame, segments: DataFrame, product: str, dropped: int
) -> DataFrame:
    """The report's facts in long form, each from a table that is already small."""
    top = segments.agg(
        F.max_by(F.concat_ws("=", "segment", "value"), F.struct("rate_pct", "segment", "value")).alias("s"),
        F.max("rate_pct").alias("v"),
    )
    bottom = segments.filter(F.col("segment") == product).agg(
        F.min_by(F.concat_ws("=", "segment", "value"), F.struct("rate_pct", "value")).alias("s"), F.min("rate_pct").alias("v")
    )
    whole = amounts.filter(F.col("class") == q.ALL)
    none = F.lit(None)
    parts = [
        _fact(totals, "global_rate_pct", none, F.col("rate_pct")),
        _fact(totals, "dropped_columns", none, F.lit(dropped)),
        _fact(nulls, "half_null_columns", none, F.col("over_50")),
        _fact(whole, "median_amount", none, F.col("p50")),
        _fact(whole, "max_amount", none, F.col("max_value")),
        _fact(whole, "max_over_median", none, F.round(F.col("max_value") / F.nullif(F.col("p50"), F.lit(0.0)), 4)),
        _fact(top, "riskiest", F.col("s"), F.col("v")),
        _fact(bottom, "least_risky", F.col("s"), F.col("v")),
    ]
    return reduce(DataFrame.unionByName, parts)
