"""Threshold economics: one pass over the scores, everything else on twenty rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.config import threshold_grid
from riskmart.functions.measures import UNITS, count_if, half_up, money, ratio_or_zero, sum_if, units, wide_units


def _cost_units(cost: float) -> Column:
    return F.lit(int(round(cost * UNITS))).cast("bigint")


def threshold_sums(
    scored: DataFrame, score: str, label: str, amount: str, thresholds: Sequence[float] | None = None
) -> DataFrame:
    """Confusion counts and missed amount at each threshold.

    Each row is put into the bucket "how many thresholds does my score reach" and the buckets are
    summed: one scan, at most one row per bucket. What lies at or above a threshold is then a
    running sum over the buckets from the top.
    """
    grid = sorted(thresholds or threshold_grid())
    # NaN would be greater than any threshold: it reaches none, like a score that is missing
    value = F.nanvl(F.col(score).cast("double"), F.lit(float("-inf")))
    reached = reduce(Column.__add__, [(value >= F.lit(float(t))).cast("int") for t in grid])
    # never null: the optimizer would otherwise test the whole sum for null in the scan, expanding
    # an expensive score once per threshold
    reached = F.coalesce(reached, F.lit(0))
    positive = F.col(label) == 1
    buckets = (
        scored.filter(F.col(label).isNotNull())
        .groupBy(reached.alias("bucket"))
        .agg(
            count_if(positive).alias("pos"),
            count_if(F.col(label) == 0).alias("neg"),
            sum_if(positive, units(amount)).alias("pos_units"),
        )
    )
    spine = scored.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("bucket"))
    filled = spine.join(buckets, "bucket", "left").fillna(0)
    # len(grid) + 1 rows: windows without partitions are bounded
    above = Window.orderBy(F.col("bucket").desc())
    everything = Window.partitionBy()
    at_least = filled.select(
        "bucket",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos_units").over(above).alias("caught_units"),
        F.sum("pos").over(everything).alias("all_pos"),
        F.sum("neg").over(everything).alias("all_neg"),
        F.sum("pos_units").over(everything).alias("all_units"),
    )
    values = F.array(*[F.lit(float(t)) for t in grid])
    return at_least.filter(F.col("bucket") > 0).select(
        F.element_at(values, F.col("bucket")).alias("threshold"),
        "tp",
        "fp",
        (F.col("all_pos") - F.col("tp")).alias("fn"),
        (F.col("all_neg") - F.col("fp")).alias("tn"),
        (F.col("all_units") - F.col("caught_units")).alias("missed_units"),
        "all_units",
    )


def _total_units(review: Column, chargeback: Column) -> Column:
    return (F.col("tp") + F.col("fp")) * review + F.col("missed_units") + F.col("fn") * chargeback


def _no_model_units(chargeback: Column) -> Column:
    return F.col("all_units") + (F.col("tp") + F.col("fn")) * chargeback


def curve_from_sums(sums: DataFrame, days: int | Column, review: float = 5.0, chargeback: float = 25.0) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    days = F.greatest((F.lit(days) if isinstance(days, int) else days).cast("bigint"), F.lit(1).cast("bigint"))
    review_u, chargeback_u = _cost_units(review), _cost_units(chargeback)
    return sums.select(
        "threshold", "tp", "fp", "fn", "tn",
        ratio_or_zero(tp, tp + fp, 4).alias("precision"),
        ratio_or_zero(tp, tp + fn, 4).alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn, 4).alias("f1"),
        half_up(tp + fp, days, 1).alias("alerts_per_day"),
        money(F.col("missed_units")).alias("missed_amount"),
        money(_total_units(review_u, chargeback_u)).alias("total_cost"),
        money(_no_model_units(chargeback_u)).alias("cost_without_model"),
    )


def threshold_curve(
    scored: DataFrame,
    score: str,
    label: str,
    amount: str,
    days: int | Column,
    review: float = 5.0,
    chargeback: float = 25.0,
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Confusion counts, quality, workload and cost at every threshold."""
    return curve_from_sums(threshold_sums(scored, score, label, amount, thresholds), days, review, chargeback)


def confusion_at(curve: DataFrame, threshold: float) -> DataFrame:
    """The 2x2 matrix at one threshold, in long form."""
    cells = [("negative", "passed", "tn"), ("negative", "alerted", "fp"), ("positive", "passed", "fn"), ("positive", "alerted", "tp")]
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(d).alias("decision"), F.col(c).alias("n")) for a, d, c in cells]
    return nearest_threshold(curve, threshold).select("threshold", F.inline(F.array(*rows)))


def metrics_at(curve: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Quality at exactly this threshold; a curve that does not hold it fails."""
    here = units("threshold") == F.lit(int(round(threshold * UNITS)))
    found = curve.filter(here).agg(F.first(F.struct("threshold", "precision", "recall", "f1")).alias("at"))
    missing = F.raise_error(F.lit(f"the curve has no threshold {threshold}")).cast(found.schema["at"].dataType)
    return found.select(F.coalesce("at", missing).alias("at")).select("at.*")


def cost_without_model(scored: DataFrame, label: str, amount: str, chargeback: float = 25.0) -> DataFrame:
    """What it costs to let every positive through: its amount plus a chargeback each."""
    positive = F.col(label) == 1
    lost = sum_if(positive, units(amount)) + count_if(positive) * _cost_units(chargeback)
    return scored.agg(count_if(positive).alias("positives"), money(lost).alias("cost_without_model"))


def _pick(df: DataFrame, rank: Column) -> DataFrame:
    whole = F.struct(*df.columns)
    return df.agg(F.min_by(whole, rank).alias("best")).filter(F.col("best").isNotNull()).select("best.*")


def argmin_threshold(curve: DataFrame) -> DataFrame:
    """The row of lowest cost; the smallest threshold wins ties."""
    return _pick(curve, F.struct("total_cost", "threshold"))


def nearest_threshold(curve: DataFrame, wanted: float) -> DataFrame:
    """The row nearest to a threshold; the lower one wins ties.

    Distances are compared in ten-thousandths: 0.15 and 0.25 are then equally far from 0.2.
    """
    away = F.abs(units("threshold") - F.lit(int(round(wanted * UNITS))))
    return _pick(curve, F.struct(away, F.col("threshold")))


def optimal_threshold(curve: DataFrame, period_days: int) -> DataFrame:
    """The cheapest threshold and what it saves against having no model."""
    saved = wide_units("cost_without_model") - wide_units("total_cost")
    return argmin_threshold(curve).select(
        "threshold", "total_cost", "cost_without_model",
        money(saved).alias("savings"),
        F.round(F.lit(100.0) * saved.cast("double") / F.nullif(wide_units("cost_without_model"), F.lit(0)).cast("double"), 2).alias("savings_pct"),
        "recall", "precision", "alerts_per_day",
        F.lit(period_days).alias("period_days"),
    )


def false_alarm_rate(curve: DataFrame) -> DataFrame:
    """Share of negatives that raise an alert."""
    return curve.select("threshold", "fp", "tn", ratio_or_zero(F.col("fp"), F.col("fp") + F.col("tn"), 4).alias("false_alarm_rate"))


def cost_scenarios(sums: DataFrame, scenarios: Sequence[tuple[float, float]]) -> DataFrame:
    """The best threshold for other (review, chargeback) pairs, without rescanning the scores."""
    options = F.array(
        *[
            F.struct(
                F.lit(float(r)).alias("review_cost"), F.lit(float(c)).alias("chargeback_cost"),
                _cost_units(r).alias("review_u"), _cost_units(c).alias("chargeback_u"),
            )
            for r, c in scenarios
        ]
    )
    priced = sums.select("*", F.inline(options)).select(
        "review_cost", "chargeback_cost", "threshold",
        _total_units(F.col("review_u"), F.col("chargeback_u")).alias("cost_u"),
        _no_model_units(F.col("chargeback_u")).alias("no_model_u"),
    )
    best = F.min_by(F.struct("threshold", "cost_u", "no_model_u"), F.struct("cost_u", "threshold"))
    return priced.groupBy("review_cost", "chargeback_cost").agg(best.alias("best")).select(
        "review_cost", "chargeback_cost",
        F.col("best.threshold").alias("threshold"),
        money(F.col("best.cost_u")).alias("total_cost"),
        money(F.col("best.no_model_u") - F.col("best.cost_u")).alias("savings"),
    )
