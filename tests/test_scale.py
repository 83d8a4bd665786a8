"""What only shows on large or odd inputs: totals beyond bigint, raw scores, NaN, fractions near 0 and 1, wide tables."""

from __future__ import annotations

import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.functions.hashing import keep_fraction
from riskmart.operators import economics, evaluation, features, kpis, models, profile
from riskmart.plans.queries.storing import TABLES
from riskmart.sources import readers


@pytest.fixture(scope="module")
def large(spark):
    """A thousand rows of 1e12: the units of their sum are above 9.2e18."""
    return spark.range(1000).select(
        "id", F.lit(3).alias("day"), F.lit("x").alias("seg"), (F.col("id") % 2).cast("int").alias("y"), F.lit(1e12).alias("amount"),
        (F.col("id") % 2 * 0.8).alias("score"), (F.col("id") % 24).cast("int").alias("hour"),
    )


def test_totals_beyond_bigint(large):
    row = kpis.global_kpis(large, "y", "amount").first()
    assert (row["amount_total"], row["amount_positive"]) == (1e15, 5e14)
    assert kpis.metric_bundle(large, ["seg"], "y", "amount").first()["amount_total"] == 1e15
    cube = kpis.daily_cube(large, ["seg"], "y", "amount")
    assert cube.first()["amount_total"] == 1e15
    assert profile.percentiles_by_class(large, "amount", "y").filter("class = 'all'").first()["mean_value"] == 1e12
    curve = economics.threshold_curve(large, "score", "y", "amount", 7).filter("threshold = 0.9").first()
    assert curve["missed_amount"] == 5e14
    best = economics.optimal_threshold(economics.threshold_curve(large, "score", "y", "amount", 7), 7).first()
    assert best["savings"] == pytest.approx(5e14, rel=1e-6)


def test_totals_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.lit(1).alias("day"), F.lit(1).alias("y"), (F.xxhash64("id") / 3e10).alias("amount"))
    totals = {kpis.global_kpis(df.repartition(n), "y", "amount").first()["amount_total"] for n in (1, 3, 8)}
    exact = sum(int(np.floor(r["amount"] * 10_000 + 0.5)) for r in df.collect())
    assert totals == {((exact + 50) // 100 * 100) / 10_000}


def areas_by_hand(scores, labels):
    pairs = sorted(zip(scores, labels), reverse=True)
    pos, neg = sum(labels), len(labels) - sum(labels)
    tp = fp = area = pr = 0.0
    before = None
    k = 0
    while k < len(pairs):
        j = k
        while j < len(pairs) and pairs[j][0] == pairs[k][0]:
            j += 1
        p = sum(y for _, y in pairs[k:j])
        n = j - k - p
        area += n * (tp + p / 2)
        tp, fp = tp + p, fp + n
        precision = tp / (tp + fp)
        pr += p / pos * (precision + (precision if before is None else before)) / 2
        before, k = precision, j
    return round(area / pos / neg, 4), round(pr, 4)


def test_areas_use_scores_as_they_are(spark):
    """Scores that differ after the fourth decimal only: rounded ones would all be ties."""
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 600).tolist()
    scores = (0.5 + 1e-6 * (rng.integers(0, 40, 600) + 5 * np.array(labels))).tolist()
    rows = [*zip(scores, labels), (float("nan"), 1), (None, 0), (0.7, None)]
    df = spark.createDataFrame(rows, "score double, y int").repartition(5)
    row = evaluation.areas(df, "score", "y").first()
    assert (row["roc_auc"], row["pr_auc"]) == pytest.approx(areas_by_hand(scores, labels), abs=1e-4)
    assert row["roc_auc"] > 0.55
    assert evaluation.roc_auc(df, "score", "y").first()[0] == row["roc_auc"]
    assert evaluation.pr_auc(df, "score", "y").first()[0] == row["pr_auc"]


def test_nan_scores_do_not_alert(spark):
    df = spark.createDataFrame([(float("nan"), 1, 10.0), (0.9, 1, 10.0), (0.1, 0, 5.0)], "score double, y int, amount double")
    row = economics.threshold_curve(df, "score", "y", "amount", 1).filter("threshold = 0.95").first()
    assert (row["tp"], row["fn"], row["fp"]) == (0, 2, 0)
    assert [r["alert"] for r in models.flag_alerts(df, 0.5).collect()] == [False, True, False]


def test_metrics_at_needs_the_threshold(spark):
    df = spark.createDataFrame([(0.9, 1, 10.0), (0.1, 0, 5.0)], "score double, y int, amount double")
    curve = economics.threshold_curve(df, "score", "y", "amount", 1, thresholds=[0.4, 0.6])
    assert economics.metrics_at(curve, 0.6).first()["recall"] == 1.0
    with pytest.raises(Exception, match="no threshold 0.5"):
        economics.metrics_at(curve, 0.5).collect()


def test_fractions_near_the_ends(spark):
    keys = spark.range(20_000)
    assert keys.filter(keep_fraction(F.col("id"), 1.0)).count() == 20_000
    assert keys.filter(keep_fraction(F.col("id"), 0.0)).count() == 0
    share = keys.filter(keep_fraction(F.col("id"), 0.2)).count() / 20_000
    assert abs(share - 0.2) < 0.02
    plan = keys.filter(keep_fraction(F.col("id"), 1e-9))._jdf.queryExecution().optimizedPlan().toString()
    assert "< 1152921505" in plan  # 1e-9 of 2 ** 60 draws: not none of them


def test_rows_without_label_are_never_sampled(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id long, y int")
    for fraction in (1.0, 0.9999999):
        kept = features.stratified_sample(df, "y", F.col("id"), fraction)
        assert sorted(r["id"] for r in kept.collect()) == [1, 2]


def test_correlation_of_wide_tables(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(10_000, 200)) + 1e6
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=10_000)
    x[:, 2] = 7.3
    x[rng.random(x.shape) < 0.1] = np.nan
    import pandas as pd

    frame = pd.DataFrame(x, columns=[f"v{i}" for i in range(200)])
    df = spark.createDataFrame(frame).replace(float("nan"), None)
    started = time.perf_counter()
    found = {(r["left_column"], r["right_column"]): r["r"] for r in profile.correlation_matrix(df, df.columns).collect()}
    assert time.perf_counter() - started < 60 and len(found) == 199 * 100
    want = frame.corr()
    for pair in [("v0", "v1"), ("v0", "v3"), ("v17", "v150")]:
        assert found[pair] == pytest.approx(want.loc[pair], abs=1e-5)
    assert np.isnan(found[("v2", "v5")])


def test_correlation_without_common_or_any_rows(spark):
    rows = [(1.0, 2.0, None, 4.0), (2.0, 4.5, None, float("nan")), (3.0, 5.0, None, None), (None, 1.0, 9.0, None)]
    df = spark.createDataFrame(rows, "`a.b` double, b double, c double, d double")
    found = {(r["left_column"], r["right_column"]): r["r"] for r in profile.correlation_matrix(df, df.columns).collect()}
    assert found[("a.b", "b")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1], abs=1e-6)
    assert found[("a.b", "c")] is None and found[("c", "d")] is None  # never both present
    assert np.isnan(found[("b", "c")]) and np.isnan(found[("a.b", "d")])  # one row: nothing varies
    empty = profile.correlation_matrix(df.limit(0), df.columns).collect()
    assert len(empty) == 6 and all(r["r"] is None for r in empty)


def test_inventory_states_files_and_bytes(spark, sf):
    rows = {r["table_name"]: r for r in readers.table_inventory(spark, {t: f"{sf}/{t}.parquet" for t in TABLES}).collect()}
    sizes = {t: sum(f.stat().st_size for f in ([Path(sf, f"{t}.parquet")] if Path(sf, f"{t}.parquet").is_file() else Path(sf, f"{t}.parquet").iterdir())) for t in TABLES}
    assert {t: rows[t]["n_bytes"] for t in TABLES} == sizes
    assert rows["total"]["n_bytes"] == sum(sizes.values()) and rows["total"]["n_files"] >= len(TABLES)
