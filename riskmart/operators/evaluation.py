"""Ranking quality from scores: exact areas, gate, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.measures import count_if
from riskmart.operators.ranges import numbered_ranges, running_totals


def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score. Rows without a label, or with a score that is null or NaN, take no part."""
    value = F.col(score).cast("double")
    known = scored.filter(F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value))
    return known.groupBy(value.alias("points")).agg(count_if(F.col(label) == 1).alias("pos"), count_if(F.col(label) == 0).alias("neg"))


def _swept(counts: DataFrame) -> DataFrame:
    """The counts with all that lies at or above each score, as doubles, and the totals on every row.

    There may be as many scores as rows: running sums go over value ranges, not through one task.
    """
    down = [F.col("points").desc()]
    ranges = numbered_ranges(counts, down, "score-ranges")
    swept = running_totals(ranges, {"tp": "pos", "fp": "neg"}, down)
    totals = ranges.agg(F.struct(F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"))).scalar()
    return swept.select(
        "points", "pos", "neg", F.col("tp").cast("double").alias("tp"), F.col("fp").cast("double").alias("fp"),
        totals["pos"].alias("all_pos"), totals["neg"].alias("all_neg"),
    )


def _roc_area() -> Column:
    # each negative sees the positives above it plus half of those it ties with
    area = F.sum(F.col("neg") * (F.col("tp") * 2 - F.col("pos")))
    return area / F.nullif(F.max("all_pos") * F.max("all_neg") * 2, F.lit(0.0))


def _pr_area() -> Column:
    """Trapezoids from one distinct score to the next; before the first, precision is that of the first."""
    above = F.col("tp") - F.col("pos")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.coalesce(above / F.nullif(above + F.col("fp") - F.col("neg"), F.lit(0.0)), precision)
    return F.sum(F.col("pos") / F.nullif(F.col("all_pos"), F.lit(0.0)) * (precision + before) / 2)


def roc_auc(scored: DataFrame, score: str, label: str, digits: int = 4) -> DataFrame:
    """Area under the ROC curve over all distinct scores as they are."""
    return _swept(score_counts(scored, score, label)).agg(F.round(_roc_area(), digits).alias("roc_auc"))


def pr_auc(scored: DataFrame, score: str, label: str, digits: int = 4) -> DataFrame:
    """Area under precision over recall, over all distinct scores as they are."""
    return _swept(score_counts(scored, score, label)).agg(F.round(_pr_area(), digits).alias("pr_auc"))


def areas(scored: DataFrame, score: str, label: str, digits: int = 4) -> DataFrame:
    """Both areas from one pass over the scores."""
    swept = _swept(score_counts(scored, score, label))
    return swept.agg(F.round(_roc_area(), digits).alias("roc_auc"), F.round(_pr_area(), digits).alias("pr_auc"))


def prevalence_lift(scored: DataFrame, score: str, label: str) -> DataFrame:
    """PR area over the share of positives: how many times better than chance."""
    base = scored.filter(F.col(label).isNotNull()).agg(
        count_if(F.col(label) == 1).cast("double").alias("p"), F.count(F.lit(1)).cast("double").alias("n")
    )
    area = pr_auc(scored, score, label).scalar()
    rate = F.col("p") / F.nullif(F.col("n"), F.lit(0.0))
    return base.select(
        F.round(rate, 6).alias("base_rate"),
        area.alias("pr_auc"),
        F.round(area / F.nullif(rate, F.lit(0.0)), 4).alias("lift"),
    )


def acceptance_gate(metrics: DataFrame, min_roc_auc: float = 0.85, min_recall: float = 0.70) -> DataFrame:
    """Whether ranking and recall reach their targets."""
    passed = (F.col("roc_auc") >= F.lit(min_roc_auc)) & (F.col("recall") >= F.lit(min_recall))
    return metrics.select("roc_auc", "recall", passed.alias("passed"))


def compare_models(metrics: DataFrame) -> DataFrame:
    """Long ``model, metric, value`` rows side by side: one row per model."""
    names = ["roc_auc", "pr_auc", "recall", "precision", "f1"]
    return metrics.groupBy("model").pivot("metric", names).agg(F.first("value"))
