"""Business KPIs: bundles, segments, the additive cube and everything read from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.config import NO_DATA
from riskmart.functions.measures import additive_sums, bundle_columns, count_if, half_up, money, sum_if, units, wide_units
from riskmart.functions.text import or_no_data

SUMS = ("transactions", "labelled", "positives", "amount_units", "positive_units")


def metric_bundle(df: DataFrame, by: Sequence[str | Column], label: str, amount: str) -> DataFrame:
    """Count, positives, rate in percent, total and positive amount per group."""
    sums = df.groupBy(*by).agg(*additive_sums(label, units(amount)))
    return sums.select(*sums.columns[: len(by)], *bundle_columns())


def kpis_daily(df: DataFrame, label: str, amount: str, day: str = "day") -> DataFrame:
    return metric_bundle(df, [day], label, amount)


def segment_risk(
    df: DataFrame, segments: Sequence[str], label: str, amount: str, at_least: int = 100
) -> DataFrame:
    """The bundle for every value of every segment, in long form.

    One scan: rows are unpivoted to ``(segment, value)`` and pre-aggregated in the same stage, so
    the shuffle carries one row per task and value, not the facts.
    """
    present = [s for s in segments if s in df.columns]
    narrow = df.select(
        F.col(label).alias("_label"),
        units(amount).alias("_units"),
        *[or_no_data(F.col(s)).alias(s) for s in present],
    )
    long = narrow.unpivot(["_label", "_units"], present, "segment", "value")
    sums = long.groupBy("segment", "value").agg(*additive_sums("_label", F.col("_units")))
    return sums.filter(F.col("transactions") >= at_least).select("segment", "value", *bundle_columns())


def cube_sums(df: DataFrame, dims: Sequence[str], label: str, amount: str, day: str = "day") -> DataFrame:
    """Exact sums by day and every combination of the dimensions."""
    present = [d for d in dims if d in df.columns]
    keys = [F.col(day).alias("day")] + [or_no_data(F.col(d)).alias(d) for d in present]
    return df.groupBy(*keys).agg(*additive_sums(label, units(amount)))


def bundle_from_sums(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The bundle at a coarser level, from sums already taken."""
    return sums.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS]).select(*by, *bundle_columns())


def cube_from_sums(sums: DataFrame) -> DataFrame:
    keys = [c for c in sums.columns if c not in SUMS]
    return sums.select(
        *keys,
        "transactions",
        "positives",
        money(F.col("amount_units")).alias("amount_total"),
        money(F.col("positive_units")).alias("amount_positive"),
    )


def daily_cube(df: DataFrame, dims: Sequence[str], label: str, amount: str, day: str = "day") -> DataFrame:
    """Sums by day and every combination of the dimensions. No rates, so any slice adds up."""
    return cube_from_sums(cube_sums(df, dims, label, amount, day))


def global_from_sums(sums: DataFrame) -> DataFrame:
    """The bundle over everything plus the number of days; the sums must be grouped by day or finer."""
    per_day = sums.groupBy("day").agg(*[F.sum(c).alias(c) for c in SUMS])
    total = per_day.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS], F.count(F.col("day")).alias("days")
    )
    return total.select(*bundle_columns(), "days")


def global_kpis(df: DataFrame, label: str, amount: str, day: str = "day") -> DataFrame:
    """The bundle over everything plus the number of days, in one pass.

    Days are grouped first: the distinct count then runs over a few rows instead of over the facts.
    """
    return global_from_sums(cube_sums(df, [], label, amount, day))


def riskiest_value(segments: DataFrame) -> DataFrame:
    """Per segment the value with the highest rate; equal rates are settled by the value."""
    rank = F.struct("rate_pct", "value")
    return segments.groupBy("segment").agg(
        F.max_by("value", rank).alias("riskiest"), F.max("rate_pct").alias("rate_pct")
    )


def dataset_summary(df: DataFrame, label: str, presence: str, dataset: str = "dataset") -> DataFrame:
    """Rows, positive rate and side-table coverage per dataset."""
    n = F.count(F.lit(1))
    positives, covered = count_if(F.col(label) == 1), count_if(F.col(presence))
    return df.groupBy(dataset).agg(
        n.alias("n_rows"),
        positives.alias("positives"),
        half_up(positives * 100, n, 2).alias("rate_pct"),
        half_up(covered * 100, n, 1).alias("coverage_pct"),
    )


def distinct_profile(df: DataFrame, columns: Sequence[str], approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.

    Exact: unpivot, then group by ``(column, value)``; repeats vanish before the shuffle, and a
    frequent value costs no more than a rare one. ``approximate`` needs no shuffle of values.
    """
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in columns])
        return counted.unpivot([], list(columns), "column_name", "distinct_values")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    seen = long.groupBy("column_name", "value").agg(F.count(F.col("value")).alias("n"))
    return seen.groupBy("column_name").agg(count_if(F.col("n") > 0).alias("distinct_values"))


def cutoff_day(df: DataFrame, days: int, day: str = "day") -> DataFrame:
    """Last training day: the latest day minus the validation window."""
    return df.agg((F.max(day) - F.lit(days)).cast("int").alias("cutoff_day"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    # one row per class: a window over the whole result is bounded
    total = F.sum("n_rows").over(Window.partitionBy())
    return counts.select(
        F.col(label).alias("label"), "n_rows", half_up(F.col("n_rows") * 100, total, 4).alias("share_pct")
    )


# ----------------------------------------------------------------------- slices of the cube


def _cube_sums() -> list[Column]:
    return [
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum(wide_units("amount_total")), F.lit(0)).alias("amount_units"),
        F.coalesce(F.sum(wide_units("amount_positive")), F.lit(0)).alias("positive_units"),
    ]


def _pct(num: Column, den: Column) -> Column:
    """Unrounded percentage, 0 where undefined."""
    return F.when(den > 0, F.lit(100.0) * num.cast("double") / F.nullif(den, F.lit(0)).cast("double")).otherwise(0.0)


def reaggregate_slice(cube: DataFrame) -> DataFrame:
    """Daily totals of a slice, the rate from the sums."""
    daily = cube.groupBy("day").agg(*_cube_sums())
    return daily.select(
        "day",
        "transactions",
        "positives",
        half_up(F.col("positives") * 100, F.col("transactions"), 3).alias("rate_pct"),
        money(F.col("amount_units")).alias("amount_total"),
        money(F.col("positive_units")).alias("amount_positive"),
    )


def headline(cube: DataFrame, chosen: DataFrame) -> DataFrame:
    """Totals of a slice against the whole cube; an empty slice gives zeros."""
    overall = cube.agg(F.sum("transactions").alias("n"), F.sum("positives").alias("p")).select(
        _pct(F.col("p"), F.col("n")).alias("rate")
    )
    rate = _pct(F.col("positives"), F.col("transactions"))
    return chosen.agg(*_cube_sums()).select(
        "transactions",
        "positives",
        F.round(rate, 4).alias("rate_pct"),
        F.round(rate - overall.scalar(), 4).alias("delta_pp"),
        money(F.col("amount_units")).alias("amount_total"),
        money(F.col("positive_units")).alias("amount_positive"),
        F.round(_pct(F.col("positive_units"), F.col("amount_units")), 4).alias("amount_share_pct"),
    )


def segment_lift(chosen: DataFrame, dim: str, at_least: int = 100) -> DataFrame:
    """Rate of each value of one dimension and its multiple of the slice rate."""
    totals = chosen.agg(F.sum("transactions").alias("n"), F.sum("positives").alias("p"))
    slice_rate = totals.select(_pct(F.col("p"), F.col("n")).alias("rate")).scalar()
    per_value = chosen.groupBy(F.col(dim).alias("value")).agg(*_cube_sums())
    rate = _pct(F.col("positives"), F.col("transactions"))
    return per_value.filter(F.col("transactions") >= at_least).select(
        "value",
        "transactions",
        "positives",
        F.round(rate, 4).alias("rate_pct"),
        money(F.col("positive_units")).alias("amount_positive"),
        F.round(F.when(slice_rate > 0, rate / F.nullif(slice_rate, F.lit(0.0))).otherwise(0.0), 4).alias("lift"),
    )


def hour_profile(segments: DataFrame, segment: str = "hour") -> DataFrame:
    """Rate by hour in numeric order of the hour (the long table stores text)."""
    return (
        segments.filter(F.col("segment") == segment)
        .select(F.col("value").cast("int").alias("hour"), "transactions", "positives", "rate_pct")
        .orderBy("hour")
    )


def filter_options(df: DataFrame, dims: Sequence[str], label: str = NO_DATA) -> DataFrame:
    """Values of every dimension in menu order: alphabetical, the no-data bucket last."""
    long = df.select(*[or_no_data(F.col(d)).alias(d) for d in dims]).unpivot([], list(dims), "dimension", "value")
    return long.distinct().orderBy("dimension", F.col("value") == label, "value")


# ----------------------------------------------------------------------- alerts


def alert_cards(scored: DataFrame, label: str, amount: str, alert: str = "alert") -> DataFrame:
    """Processed rows, alerts, true alerts, amount under alert."""
    flagged = F.col(alert)
    return scored.agg(
        F.count(F.lit(1)).alias("processed"),
        count_if(flagged).alias("alerts"),
        count_if(flagged & (F.col(label) == 1)).alias("true_alerts"),
        money(sum_if(flagged, units(amount))).alias("alert_amount"),
    )


def hour_spine(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))


def alerts_hour_matrix(scored: DataFrame, label: str, alert: str = "alert", hour: str = "hour") -> DataFrame:
    """Alerts by hour and class; all 24 hours present, empty cells 0."""
    per_hour = (
        scored.filter(F.col(alert))
        .groupBy(F.col(hour).cast("int").alias("hour"))
        .agg(
            count_if(F.col(label) == 0).alias("false_alarms"),
            count_if(F.col(label) == 1).alias("true_alerts"),
        )
    )
    return hour_spine(scored).join(per_hour, "hour", "left").fillna(0, subset=["false_alarms", "true_alerts"])


def cumulative_by_hour(scored: DataFrame, label: str, amount: str, alert: str = "alert", hour: str = "hour") -> DataFrame:
    """The alert cards as they stand after each hour of the day: 24 rows."""
    flagged = F.col(alert)
    per_hour = scored.groupBy(F.col(hour).cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("processed"),
        count_if(flagged).alias("alerts"),
        count_if(flagged & (F.col(label) == 1)).alias("true_alerts"),
        sum_if(flagged, units(amount)).alias("alert_units"),
    )
    # 24 rows: a window without partitions is bounded
    so_far = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    filled = hour_spine(scored).join(per_hour, "hour", "left").fillna(0)
    return filled.select(
        "hour",
        *[F.sum(c).over(so_far).alias(c) for c in ("processed", "alerts", "true_alerts")],
        money(F.sum("alert_units").over(so_far)).alias("alert_amount"),
    )


# ----------------------------------------------------------------------- moving windows


def _trailing(rows: int, calendar: bool = False):
    # the daily table holds one row per day, so one partition is enough
    w = Window.orderBy("day")
    return w.rangeBetween(1 - rows, 0) if calendar else w.rowsBetween(1 - rows, 0)


def rolling_rate(daily: DataFrame, rows: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing ratio of sums over the last ``rows`` days that have data; ``calendar``: over the last ``rows`` days, with or without data."""
    w = _trailing(rows, calendar)
    return daily.select(
        "day", F.round(_pct(F.sum("positives").over(w), F.sum("transactions").over(w)), 6).alias("rolling_rate_pct")
    )


def rolling_mean_of_rates(daily: DataFrame, rows: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing mean of daily rates: each day with data counts the same, whatever its volume."""
    w = _trailing(rows, calendar)
    return daily.select("day", F.round(F.avg("rate_pct").over(w), 6).alias("rolling_mean_rate_pct"))


def rolling_amount_share(daily: DataFrame, rows: int = 7, calendar: bool = False) -> DataFrame:
    """Trailing share of the positive amount in the whole amount."""
    w = _trailing(rows, calendar)
    positive, total = F.sum(wide_units("amount_positive")).over(w), F.sum(wide_units("amount_total")).over(w)
    return daily.select("day", F.round(_pct(positive, total), 6).alias("rolling_amount_share_pct"))
