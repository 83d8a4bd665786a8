import pytest
from pyspark.sql import functions as F

from riskmart.config import RiskConfig, threshold_grid
from riskmart.operators import economics, evaluation

LABEL, AMOUNT = "is_positive", "amount"


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, ((i * 37) % 10001) / 10000.0, int((i * 31) % 7 == 0), (i % 100) / 4.0) for i in range(3000)]
    rows += [(9001, 0.05, 1, 3.0), (9002, 0.95, 0, 1.0), (9003, 0.5, 1, 2.5), (9004, 0.4999, 1, 2.5)]
    return spark.createDataFrame(rows, "id int, score double, is_positive int, amount double")


def test_curve_against_brute_force(scored):
    rows = scored.collect()
    curve = {r.threshold: r for r in economics.threshold_curve(scored, "score", LABEL, AMOUNT, 7).collect()}
    assert sorted(curve) == threshold_grid()
    for t, r in curve.items():
        tp = sum(x.score >= t and x.is_positive == 1 for x in rows)
        fp = sum(x.score >= t and x.is_positive == 0 for x in rows)
        fn = sum(x.score < t and x.is_positive == 1 for x in rows)
        missed = sum(x.amount for x in rows if x.score < t and x.is_positive == 1)
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, len(rows) - tp - fp - fn)
        assert r.total_cost == pytest.approx((tp + fp) * 5 + missed + fn * 25, abs=0.006)
        assert r.precision == pytest.approx(tp / (tp + fp), abs=5.1e-5)
        assert r.recall == pytest.approx(tp / (tp + fn), abs=5.1e-5)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=5.1e-5)
    recalls = [curve[t].recall for t in sorted(curve)]
    assert recalls == sorted(recalls, reverse=True)


def test_no_positives_and_no_alerts(spark):
    df = spark.createDataFrame([(0.01, 0, 5.0), (0.02, 0, 5.0), (None, 0, 1.0)], "score double, is_positive int, amount double")
    for r in economics.threshold_curve(df, "score", LABEL, AMOUNT, 0).collect():
        assert (r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.f1, r.total_cost) == (0, 0, 0, 3, 0.0, 0.0, 0.0, 0.0)
    assert economics.threshold_curve(df.limit(0), "score", LABEL, AMOUNT, 1).count() == 19


def test_published_confusion_at_the_optimum(spark):
    # tp, fp, fn, tn, missed amount and positive amount in ten-thousandths
    sums = spark.createDataFrame(
        [(0.4, 2456, 15106, 538, 67330, 823_888_800, 4_574_355_800), (0.5, 2263, 10150, 731, 72286, 1_623_888_800, 4_574_355_800)],
        "threshold double, tp bigint, fp bigint, fn bigint, tn bigint, missed_units bigint, all_units bigint",
    )
    best = economics.optimal_threshold(economics.curve_from_sums(sums, 30), 30).first()
    assert (best.threshold, best.recall, best.precision, best.alerts_per_day) == (0.4, 0.8203, 0.1398, 585.4)
    assert (best.total_cost, best.cost_without_model, best.savings) == (183648.88, 532285.58, 348636.7)


def test_ties_go_to_the_lower_threshold(spark):
    curve = spark.createDataFrame([(0.3, 5.0), (0.2, 5.0), (0.4, 9.0)], "threshold double, total_cost double")
    assert economics.argmin_threshold(curve).first().threshold == 0.2
    assert economics.nearest_threshold(curve, 0.25).first().threshold == 0.2
    assert economics.nearest_threshold(curve, 0.99).first().threshold == 0.4


def test_scenarios_agree_with_a_fresh_curve(scored):
    sums = economics.threshold_sums(scored, "score", LABEL, AMOUNT)
    pairs = [(5.0, 25.0), (50.0, 0.0), (0.0, 100.0)]
    got = {(r.review_cost, r.chargeback_cost): (r.threshold, r.total_cost) for r in economics.cost_scenarios(sums, pairs).collect()}
    for review, chargeback in pairs:
        best = economics.argmin_threshold(
            economics.threshold_curve(scored, "score", LABEL, AMOUNT, 7, review, chargeback)
        ).first()
        assert got[(review, chargeback)] == (best.threshold, best.total_cost)


def test_cost_without_model_is_the_same_from_rows_and_from_sums(scored):
    direct = economics.cost_without_model(scored, LABEL, AMOUNT).first().cost_without_model
    curve = economics.threshold_curve(scored, "score", LABEL, AMOUNT, 7)
    assert {r.cost_without_model for r in curve.collect()} == {direct}


def test_areas_against_brute_force(scored):
    rows = scored.limit(400).collect()
    small = scored.sparkSession.createDataFrame(rows)
    pos = [r.score for r in rows if r.is_positive == 1]
    neg = [r.score for r in rows if r.is_positive == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert evaluation.roc_auc(small, "score", LABEL).first()[0] == pytest.approx(wins / len(pos) / len(neg), abs=5.1e-5)
    points, tp, fp = [], 0, 0
    for s in sorted({r.score for r in rows}, reverse=True):
        tp += sum(p == s for p in pos)
        fp += sum(n == s for n in neg)
        points.append((tp / len(pos), tp / (tp + fp)))
    points.insert(0, (0.0, points[0][1]))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert evaluation.pr_auc(small, "score", LABEL).first()[0] == pytest.approx(area, abs=5.1e-5)


def test_areas_without_a_class(spark):
    df = spark.createDataFrame([(0.3, 0), (0.4, 0)], "score double, is_positive int")
    assert evaluation.roc_auc(df, "score", LABEL).first()[0] is None
    assert evaluation.pr_auc(df, "score", LABEL).first()[0] is None


def test_gate(spark):
    df = spark.createDataFrame([(0.85, 0.70), (0.8499, 0.9), (0.9, 0.69)], "roc_auc double, recall double")
    assert [r.passed for r in evaluation.acceptance_gate(df).collect()] == [True, False, False]


def test_category_limit_is_tied_to_the_bins():
    with pytest.raises(ValueError, match="max_bins"):
        RiskConfig(max_categories=63)
    assert RiskConfig().thresholds[7] == 0.4
    assert len(RiskConfig().thresholds) == 19


def test_mean_of_scores_is_untouched(scored):
    # the sweep counts every labelled row once
    sums = economics.threshold_sums(scored, "score", LABEL, AMOUNT)
    n = scored.count()
    assert {r.n for r in sums.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n")).collect()} == {n}
