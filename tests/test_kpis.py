from pyspark.sql import functions as F

from riskmart.operators import clean, kpis, ranking
from riskmart.plans import bindings as b

LABEL, AMOUNT = "is_positive", "amount"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_segments_keep_nulls_apart_and_skip_absent_columns(spark):
    df = spark.createDataFrame(
        [("a", None, 1, 10.0), ("a", 3, 0, 5.5), (None, 3, 0, 1.0)], "s string, h int, is_positive int, amount double"
    )
    got = rows(kpis.segment_risk(df, ["s", "h", "absent"], LABEL, AMOUNT, at_least=1), "segment", "value")
    assert got == [
        ("h", "(sin dato)", 1, 1, 100.0, 10.0, 10.0), ("h", "3", 2, 0, 0.0, 6.5, 0.0),
        ("s", "(sin dato)", 1, 0, 0.0, 1.0, 0.0), ("s", "a", 2, 1, 50.0, 15.5, 10.0),
    ]
    assert kpis.segment_risk(df, ["s"], LABEL, AMOUNT, at_least=3).count() == 0


def test_unlabelled_rows_do_not_dilute_the_rate(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (None, 1.0)], "is_positive int, amount double")
    assert rows(kpis.metric_bundle(df, [], LABEL, AMOUNT)) == [(3, 1, 50.0, 3.0, 1.0)]
    empty = df.limit(0)
    assert rows(kpis.metric_bundle(empty, [], LABEL, AMOUNT)) == [(0, 0, None, 0.0, 0.0)]


def test_cube_adds_up_to_the_daily_table_and_the_totals(spark, sf):
    events = b.events_frame(spark, sf, with_customer=True)
    cube = kpis.daily_cube(events, ["channel", "segment"], LABEL, AMOUNT)
    daily = kpis.kpis_daily(events, LABEL, AMOUNT)
    assert rows(kpis.reaggregate_slice(cube), "day") == rows(daily, "day")
    sums = kpis.cube_sums(events, ["channel", "segment"], LABEL, AMOUNT)
    assert rows(kpis.bundle_from_sums(sums, ["day"]), "day") == rows(daily, "day")
    assert rows(kpis.global_from_sums(sums)) == rows(kpis.global_kpis(events, LABEL, AMOUNT))


def test_every_segment_adds_up_to_the_totals(spark, sf):
    lines = b.lineitem_frame(spark, sf)
    total = kpis.global_kpis(lines, LABEL, AMOUNT).first()
    per_segment = kpis.segment_risk(lines, b.LI_SEGMENTS, LABEL, AMOUNT, at_least=1).groupBy("segment").agg(
        F.sum("transactions").alias("n"), F.sum("positives").alias("p")
    )
    assert {(r.n, r.p) for r in per_segment.collect()} == {(total.transactions, total.positives)}


def test_results_do_not_depend_on_partitioning(spark, sf):
    events = b.events_frame(spark, sf)
    expected = rows(kpis.kpis_daily(events, LABEL, AMOUNT), "day")
    assert rows(kpis.kpis_daily(events.repartition(13), LABEL, AMOUNT), "day") == expected


def test_rolling_ratio_differs_from_rolling_mean(spark):
    daily = spark.createDataFrame(
        [(0, 10, 1, 10.0, 100.0, 10.0), (1, 90, 0, 0.0, 100.0, 0.0), (4, 100, 50, 50.0, 200.0, 90.0)],
        "day int, transactions bigint, positives bigint, rate_pct double, amount_total double, amount_positive double",
    )
    ratio = dict(rows(kpis.rolling_rate(daily)))
    mean = dict(rows(kpis.rolling_mean_of_rates(daily)))
    assert ratio == {0: 10.0, 1: 1.0, 4: 25.5}
    assert mean == {0: 10.0, 1: 5.0, 4: 20.0}
    assert dict(rows(kpis.rolling_amount_share(daily)))[4] == 25.0
    # frames count rows, not calendar days
    assert dict(rows(kpis.rolling_rate(daily, rows=2)))[4] == round(100 * 50 / 190, 6)


def test_empty_slice_gives_zeros(spark, sf):
    cube = kpis.daily_cube(b.events_frame(spark, sf), ["channel"], LABEL, AMOUNT)
    row = kpis.headline(cube, clean.slice_filter(cube, (900, 901))).first()
    assert (row.transactions, row.positives, row.rate_pct, row.amount_share_pct) == (0, 0, 0.0, 0.0)
    assert kpis.segment_lift(clean.slice_filter(cube, (900, 901)), "channel").count() == 0


def test_hour_matrix_and_running_cards_fill_all_hours(spark):
    scored = spark.createDataFrame(
        [(3, 1, True, 5.0), (3, 0, True, 1.0), (9, 0, False, 7.0)], "hour int, is_positive int, alert boolean, amount double"
    )
    matrix = {r.hour: (r.false_alarms, r.true_alerts) for r in kpis.alerts_hour_matrix(scored, LABEL).collect()}
    assert len(matrix) == 24 and matrix[3] == (1, 1) and matrix[9] == (0, 0)
    cards = {r.hour: tuple(r)[1:] for r in kpis.cumulative_by_hour(scored, LABEL, AMOUNT).collect()}
    assert cards[2] == (0, 0, 0, 0.0) and cards[3] == (2, 2, 1, 6.0) and cards[23] == (3, 2, 1, 6.0)
    assert tuple(kpis.alert_cards(scored, LABEL, AMOUNT).first()) == cards[23]


def test_distinct_profile_ignores_nulls_and_approximates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, n int")
    assert dict(rows(kpis.distinct_profile(df, ["s", "n"]))) == {"s": 1, "n": 2}
    assert dict(rows(kpis.distinct_profile(df, ["s", "n"], approximate=True))) == {"s": 1, "n": 2}


def test_ties_are_settled_by_value(spark):
    seg = spark.createDataFrame([("s", "x", 9.0), ("s", "y", 9.0), ("s", "z", 1.0)], "segment string, value string, rate_pct double")
    assert rows(kpis.riskiest_value(seg)) == [("s", "y", 9.0)]
    assert [r.value for r in ranking.top_segments(seg, 2).collect()] == ["x", "y"]


def test_menu_puts_the_no_data_bucket_last(spark):
    df = spark.createDataFrame([("~z",), (None,), ("a",)], "d string")
    assert [r.value for r in kpis.filter_options(df, ["d"]).collect()] == ["a", "~z", "(sin dato)"]
