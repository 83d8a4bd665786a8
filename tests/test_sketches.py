"""Sketches: errors against exact ranks and counts, merging, nulls, empty tables; moving windows over calendar days."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators import kpis, sketches


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 19), rng.choice([0, 0, 0, 1]), math.exp(rng.gauss(3, 1.2)), rng.randint(0, 4000), rng.choice("abc")) for _ in range(40_000)]
    rows += [(3, 0, None, None, "a"), (3, None, 5.0, 1, None), (4, 1, float("nan"), 2, "b")]
    return spark.createDataFrame(rows, "day int, label int, value double, user long, dim string").repartition(6).cache()


def ranks(values, v):
    return sum(x < v for x in values), sum(x <= v for x in values)


@pytest.mark.parametrize("days", [(0, 19), (4, 11), (7, 7)])
def test_percentiles_lie_within_the_stated_error(facts, days):
    daily = sketches.daily_quantiles(facts, "value", "label").filter(F.col("day").between(*days))
    probs = (0.01, 0.25, 0.5, 0.75, 0.99)
    found = {r["class"]: r for r in sketches.percentiles_from_sketches(daily, probs).collect()}
    raw = [r for r in facts.filter(F.col("day").between(*days)).collect() if r.value is not None and not math.isnan(r.value)]
    for cls in ("all", "0", "1"):
        values = sorted(r.value for r in raw if cls == "all" or str(r.label) == cls)
        row = found[cls]
        assert (row.n, row.min_value, row.max_value) == (len(values), values[0], values[-1])
        for p in probs:
            below, upto = ranks(values, row[f"p{round(100 * p):02d}"])
            slack = 2 * sketches.rank_error() * len(values) + 1
            assert below - slack <= p * len(values) <= upto + slack


def test_sketches_merge_as_if_taken_at_once(facts):
    """Days merged one after the other, or taken as one: the counts agree and so do the values, within the error."""
    daily = sketches.daily_quantiles(facts, "value", "label")
    once = sketches.daily_quantiles(facts.withColumn("day", F.lit(0)), "value", "label")
    a, b_ = ({r["class"]: r for r in sketches.percentiles_from_sketches(d).collect()} for d in (daily, once))
    assert {c: r.n for c, r in a.items()} == {c: r.n for c, r in b_.items()}
    assert a["all"].p50 == pytest.approx(b_["all"].p50, rel=0.15)


def test_box_from_sketches(facts):
    box = {r["class"]: r for r in sketches.box_from_sketches(sketches.daily_quantiles(facts, "value", "label")).collect()}
    assert set(box) == {"0", "1"}  # rows without a class have no box
    for cls, r in box.items():
        values = [x.value for x in facts.filter(F.col("label") == int(cls)).collect() if x.value is not None and not math.isnan(x.value)]
        exact = sum(v < r.low_fence or v > r.high_fence for v in values)
        assert r.q1 < r.median < r.q3 and abs(exact - r.outliers) <= (4 * sketches.rank_error() + 1 / sketches.BOX_STEPS) * len(values) + 1


def test_distinct_counts_of_slices_merge(facts):
    cube = sketches.cube_with_distinct(facts, ["dim"], "label", "value", {"users": "user"})
    rows = facts.collect()
    for days in ((0, 19), (2, 3)):
        part = cube.filter(F.col("day").between(*days))
        total = sketches.slice_distinct(part, ["users"]).first()
        exact = len({r.user for r in rows if days[0] <= r.day <= days[1] and r.user is not None})
        assert abs(total.users - exact) <= 3 * sketches.distinct_error() * exact + 1
        assert total.transactions == sum(days[0] <= r.day <= days[1] for r in rows)
    per_dim = {r.dim: r.users for r in sketches.slice_distinct(cube, ["users"], ["dim"]).collect()}
    assert len(per_dim) == 4 and all(v > 0 for v in per_dim.values())


def test_sketches_of_nothing(facts):
    none = facts.limit(0)
    assert sketches.percentiles_from_sketches(sketches.daily_quantiles(none, "value", "label")).count() == 0
    row = sketches.slice_distinct(sketches.cube_with_distinct(none, ["dim"], "label", "value", {"users": "user"}), ["users"]).first()
    assert (row.transactions, row.users) == (0, 0)


def test_approximate_profile(facts):
    exact = {r.column_name: r.distinct_values for r in kpis.distinct_profile(facts, ["user", "dim", "day"]).collect()}
    near = {r.column_name: r.distinct_values for r in kpis.distinct_profile(facts, ["user", "dim", "day"], approximate=True).collect()}
    assert set(exact) == set(near) and all(abs(near[c] - exact[c]) <= 0.03 * exact[c] + 1 for c in exact)


def test_calendar_windows_leave_out_old_days(spark):
    daily = spark.createDataFrame([(1, 10, 1, 10.0), (2, 10, 3, 30.0), (9, 10, 5, 50.0), (10, 0, 0, None)], "day int, transactions long, positives long, rate_pct double")
    by_rows = {r.day: r[1] for r in kpis.rolling_rate(daily, 3).collect()}
    by_days = {r.day: r[1] for r in kpis.rolling_rate(daily, 3, calendar=True).collect()}
    assert by_rows == {1: 10.0, 2: 20.0, 9: 30.0, 10: 40.0} and by_days == {1: 10.0, 2: 20.0, 9: 50.0, 10: 50.0}
    means = {r.day: r[1] for r in kpis.rolling_mean_of_rates(daily, 3, calendar=True).collect()}
    assert means == {1: 10.0, 2: 20.0, 9: 50.0, 10: 50.0}
