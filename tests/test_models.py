"""The fitted baseline against an independent fit: Newton's method on the same weighted, penalised likelihood."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.config import RiskConfig
from riskmart.operators import models

CONFIG = RiskConfig(baseline_iterations=200, baseline_reg=0.01)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 3)) * [1.0, 5.0, 0.2] + [0.0, 2.0, -1.0]
    p = 1 / (1 + np.exp(-(x @ [0.8, -0.2, 3.0] + 1.0)))
    return x, (rng.random(3000) < p).astype(float)


def fitted(spark, x, y, weight):
    rows = [(*map(float, r), int(t), float(w)) for r, t, w in zip(x, y, weight)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int, w double").repartition(4)
    model = models.train_baseline(df, ["a", "b", "c"], [], "y", "w", CONFIG)
    return model, df


def newton(x, y, weight, reg):
    """Coefficients and intercept for features scaled to unit variance; the penalty is on coefficients of weighted unit variance."""
    z = x / x.std(axis=0, ddof=1)
    mean = np.average(z, axis=0, weights=weight)
    total, square = weight.sum(), (weight**2).sum()
    spread = (weight[:, None] * (z - mean) ** 2).sum(axis=0) / (total - square / total)
    design = np.hstack([z, np.ones((len(z), 1))])
    penalty = np.diag([*(reg * spread), 0.0])
    beta = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) / total + penalty @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design / total + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize("positive_weight", [1.0, 4.0])
def test_baseline_is_the_penalised_maximum(spark, sample, positive_weight):
    x, y = sample
    weight = np.where(y == 1, positive_weight, 1.0)
    model, df = fitted(spark, x, y, weight)
    regression, want = model.stages[-1], newton(x, y, weight, CONFIG.baseline_reg)
    assert np.allclose(regression.coefficients.toArray(), want[:3], atol=2e-3) and regression.intercept == pytest.approx(want[3], abs=2e-3)
    z = np.hstack([x / x.std(axis=0, ddof=1), np.ones((len(x), 1))])
    by_hand = np.round(1 / (1 + np.exp(-z @ want)), 4)
    scores = {(r.a, r.b): r.score for r in models.with_score(model, df).select("a", "b", "score").collect()}
    assert max(abs(scores[float(a), float(b)] - s) for (a, b, _), s in zip(x, by_hand)) < 1e-3


def test_the_class_weight_moves_the_intercept_by_its_logarithm(spark):
    """Without informative features the intercept is the log odds of the weighted classes."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(4000, 3)), np.array([1.0] * 400 + [0.0] * 3600)
    found = [fitted(spark, x, y, np.where(y == 1, w, 1.0))[0].stages[-1].intercept for w in (1.0, 9.0)]
    assert found[0] == pytest.approx(np.log(400 / 3600), abs=0.02)
    assert found[1] - found[0] == pytest.approx(np.log(9), abs=0.03)


def test_trees_follow_weights_and_rank_by_the_signal(spark):
    """With the weight of every row doubled nothing changes; with the positives weighted up, scores rise."""
    df = spark.range(3000).select(
        (F.col("id") % 97).cast("double").alias("a"), (F.col("id") * 7919 % 101).cast("double").alias("b"),
        ((F.col("id") % 97 > 80) & (F.col("id") % 3 > 0)).cast("int").alias("y"),
    )
    cfg = RiskConfig(trees=5)

    def mean_score(weight):
        model = models.train_gbt(df.withColumn("w", weight), ["a", "b"], [], "y", "w", cfg)
        top = models.feature_importance(model, df).first()
        assert top.feature == "a" and top.importance > 0.7
        return models.with_score(model, df).agg(F.avg("score")).first()[0]

    plain, doubled, up = (mean_score(w) for w in (F.lit(1.0), F.lit(2.0), F.when(F.col("y") == 1, 5.0).otherwise(1.0)))
    assert plain == pytest.approx(doubled, abs=1e-3) and up > plain + 0.02
