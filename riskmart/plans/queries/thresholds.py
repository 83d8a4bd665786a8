"""Queries: gate, comparison, threshold economics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.hashing import key_hash
from riskmart.functions.measures import UNITS
from riskmart.operators import economics, evaluation
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.profiling import _AREAS, validation
from riskmart.plans.queries.registry import query

LABEL, AMOUNT = "is_positive", "amount"
SCENARIOS = [(5.0, 25.0), (1.0, 25.0), (20.0, 25.0), (5.0, 100.0), (0.5, 0.0)]

_U = s.units("amount")
_SWEEP = f"""grid AS (SELECT CAST(range AS DOUBLE) / 20 AS threshold FROM range(1, 20)),
sums AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold AND is_positive = 1) AS tp,
  count(*) FILTER (WHERE score >= threshold AND is_positive = 0) AS fp,
  count(*) FILTER (WHERE score < threshold AND is_positive = 1) AS fn,
  count(*) FILTER (WHERE score < threshold AND is_positive = 0) AS tn,
  coalesce(CAST(sum({_U}) FILTER (WHERE score < threshold AND is_positive = 1) AS BIGINT), 0) AS missed,
  CAST(sum({_U}) FILTER (WHERE is_positive = 1) AS BIGINT) AS all_units FROM grid, val GROUP BY threshold)"""
_CURVE = f"""{_SWEEP},
curve AS (SELECT threshold, tp, fp, fn, tn, {s.ratio_or_zero('tp', 'tp + fp', 4)} AS precision, {s.ratio_or_zero('tp', 'tp + fn', 4)} AS recall,
  {s.ratio_or_zero('2 * tp', '2 * tp + fp + fn', 4)} AS f1, {s.half_up('tp + fp', '7', 1)} AS alerts_per_day,
  {s.money('missed')} AS missed_amount, {s.money('(tp + fp) * 50000 + missed + fn * 250000')} AS total_cost,
  {s.money('all_units + (tp + fn) * 250000')} AS cost_without_model,
  (tp + fp) * 50000 + missed + fn * 250000 AS cost_u, all_units + (tp + fn) * 250000 AS no_model_u FROM sums)"""
CURVE_SQL = f"{s.VAL}, {_CURVE}"
_COLUMNS = "threshold, tp, fp, fn, tn, precision, recall, f1, alerts_per_day, missed_amount, total_cost, cost_without_model"
_BEST = "ORDER BY total_cost, threshold LIMIT 1"


def curve(spark, sf):
    return economics.threshold_curve(validation(spark, sf), "score", LABEL, AMOUNT, b.VALIDATION_DAYS)


@query("threshold_curve", f"WITH {CURVE_SQL} SELECT {_COLUMNS} FROM curve")
def threshold_curve(spark, sf):
    return curve(spark, sf)


@query(
    "confusion_at",
    f"""WITH {CURVE_SQL}, c AS (SELECT * FROM curve WHERE threshold = CAST(8 AS DOUBLE) / 20)
SELECT threshold, 'negative' AS actual, 'passed' AS decision, tn AS n FROM c
UNION ALL SELECT threshold, 'negative', 'alerted', fp FROM c
UNION ALL SELECT threshold, 'positive', 'passed', fn FROM c
UNION ALL SELECT threshold, 'positive', 'alerted', tp FROM c""",
)
def confusion_at(spark, sf):
    return economics.confusion_at(curve(spark, sf), 0.4)


@query("metrics_at", f"WITH {CURVE_SQL} SELECT threshold, precision, recall, f1 FROM curve WHERE threshold = CAST(10 AS DOUBLE) / 20")
def metrics_at(spark, sf):
    return economics.metrics_at(curve(spark, sf))


@query(
    "cost_without_model",
    f"""WITH {s.VAL}, t AS (SELECT count(*) FILTER (WHERE is_positive = 1) AS p, CAST(sum({_U}) FILTER (WHERE is_positive = 1) AS BIGINT) AS u FROM val)
SELECT p AS positives, {s.money('u + p * 250000')} AS cost_without_model FROM t""",
)
def cost_without_model(spark, sf):
    return economics.cost_without_model(validation(spark, sf), LABEL, AMOUNT)


@query("argmin_threshold", f"WITH {CURVE_SQL} SELECT {_COLUMNS} FROM curve {_BEST}")
def argmin_threshold(spark, sf):
    return economics.argmin_threshold(curve(spark, sf))


@query("nearest_threshold", f"WITH {CURVE_SQL} SELECT {_COLUMNS} FROM curve WHERE threshold = CAST(14 AS DOUBLE) / 20")
def nearest_threshold(spark, sf):
    # 0.725 lies between 0.70 and 0.75: the lower one wins
    return economics.nearest_threshold(curve(spark, sf), 0.725)


@query(
    "optimal_threshold",
    f"""WITH {CURVE_SQL} SELECT threshold, total_cost, cost_without_model, {s.money('no_model_u - cost_u')} AS savings,
  round(1e2 * CAST(no_model_u - cost_u AS DOUBLE) / CAST(no_model_u AS DOUBLE), 2) AS savings_pct, recall, precision, alerts_per_day,
  CAST(7 AS INTEGER) AS period_days FROM curve {_BEST}""",
)
def optimal_threshold(spark, sf):
    return economics.optimal_threshold(curve(spark, sf), b.VALIDATION_DAYS)


@query("false_alarm_rate", f"WITH {CURVE_SQL} SELECT threshold, fp, tn, {s.ratio_or_zero('fp', 'fp + tn', 4)} AS false_alarm_rate FROM curve")
def false_alarm_rate(spark, sf):
    return economics.false_alarm_rate(curve(spark, sf))


_OPTIONS = ", ".join(f"({r}::DOUBLE, {c}::DOUBLE, {int(r * UNITS)}, {int(c * UNITS)})" for r, c in SCENARIOS)


@query(
    "cost_scenarios",
    f"""WITH {s.VAL}, {_SWEEP}, o(review_cost, chargeback_cost, ru, cu) AS (VALUES {_OPTIONS}),
c AS (SELECT review_cost, chargeback_cost, threshold, (tp + fp) * ru + missed + fn * cu AS cost_u, all_units + (tp + fn) * cu AS none_u FROM sums, o)
SELECT review_cost, chargeback_cost, threshold, {s.money('cost_u')} AS total_cost, {s.money('none_u - cost_u')} AS savings FROM c
QUALIFY row_number() OVER (PARTITION BY review_cost, chargeback_cost ORDER BY cost_u, threshold) = 1""",
)
def cost_scenarios(spark, sf):
    sums = economics.threshold_sums(validation(spark, sf), "score", LABEL, AMOUNT)
    return economics.cost_scenarios(sums, SCENARIOS)


@query(
    "acceptance_gate",
    f"""WITH {_AREAS}, r AS (SELECT {s.ratio_or_zero("count(*) FILTER (WHERE alert AND is_positive = 1)", "count(*) FILTER (WHERE is_positive = 1)", 4)} AS recall FROM val)
SELECT roc_auc, recall, roc_auc >= 0.85 AND recall >= 0.7 AS passed FROM roc, r""",
)
def acceptance_gate(spark, sf):
    scored = validation(spark, sf)
    recall = economics.metrics_at(curve(spark, sf)).select("recall").scalar()
    return evaluation.acceptance_gate(evaluation.roc_auc(scored, "score", LABEL).withColumn("recall", recall))


def model_metrics(scored: DataFrame, score: str, model: str) -> DataFrame:
    """Long metric rows of one model."""
    at_half = economics.metrics_at(economics.threshold_curve(scored, score, LABEL, AMOUNT, b.VALIDATION_DAYS))
    tables = [
        evaluation.areas(scored, score, LABEL),
        at_half.select("recall", "precision", "f1"),
    ]
    long = [t.unpivot([], t.columns, "metric", "value") for t in tables]
    return reduce(DataFrame.unionByName, long).withColumn("model", F.lit(model))


def _compared(prefix: str, score: str, model: str) -> str:
    tp = f"count(*) FILTER (WHERE {score} >= CAST(10 AS DOUBLE) / 20 AND is_positive = 1)"
    fp = f"count(*) FILTER (WHERE {score} >= CAST(10 AS DOUBLE) / 20 AND is_positive = 0)"
    pos = "count(*) FILTER (WHERE is_positive = 1)"
    return f"""SELECT '{model}' AS model, max(roc_auc) AS roc_auc, max(pr_auc) AS pr_auc, {s.ratio_or_zero(tp, pos, 4)} AS recall,
  {s.ratio_or_zero(tp, f'{tp} + {fp}', 4)} AS precision, {s.ratio_or_zero(f'2 * {tp}', f'{tp} + {fp} + {pos}', 4)} AS f1
  FROM both_scores, {prefix}_roc, {prefix}_prc"""


@query(
    "compare_models",
    f"""WITH {s.VAL},
both_scores AS (SELECT *, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS DOUBLE) / 1e4 AS flat FROM val),
{s.areas('both_scores', 'score', 'lean_')}, {s.areas('both_scores', 'flat', 'even_')}
{_compared('lean', 'score', 'leaning')} UNION ALL {_compared('even', 'flat', 'flat')}""",
)
def compare_models(spark, sf):
    scored = validation(spark, sf).withColumn("flat", (key_hash(F.col("id")) % 10_000).cast("double") / F.lit(1e4))
    rows = model_metrics(scored, "score", "leaning").unionByName(model_metrics(scored, "flat", "flat"))
    return evaluation.compare_models(rows)
