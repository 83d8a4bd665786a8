import pytest
from pyspark.sql import functions as F

from riskmart.functions import measures, text, timing
from riskmart.operators import clean, joins, profile, quantiles


def column(spark, values, expr, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_names_are_normalised_and_collisions_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`id-01` int, id_02 int")
    assert clean.normalize_names(df).columns == ["id_01", "id_02"]
    with pytest.raises(ValueError, match="id_01"):
        clean.normalize_names(spark.createDataFrame([(1, 2)], "`id-01` int, id_01 int"))


def test_email_provider(spark):
    given = ["gmail.com", " Yahoo.com.mx ", "hotmail.co.uk", "", None, "anonymous", "   "]
    assert column(spark, given, text.first_label) == ["gmail", "yahoo", "hotmail", None, None, "anonymous", None]


def test_device_brand_rules_and_precedence(spark):
    given = {
        "SM-G930V": "samsung", "GT-I9": "samsung", "my Samsung": "samsung", "iOS Device": "apple", "MacOS": "apple",
        "iPhone": "apple", "Moto G": "motorola", "XT1635": "motorola", "the motorola": "motorola", "LG-K": "lg",
        "a lg-b": "lg", "ALE-L23": "huawei", "ANE-1": "huawei", "HUAWEI": "huawei", "Redmi": "xiaomi", "Mi A1": "xiaomi",
        "Nexus 5": "google", "Pixel": "google", "Trident/7.0": "windows", "Windows": "windows", "Linux": "linux",
        "rv:57": "otro", "moto windows": "motorola", "  ": None,
    }
    assert column(spark, list(given), text.device_brand) == list(given.values())
    assert column(spark, [None], text.device_brand) == [None]


def test_rare_levels_are_case_sensitive(spark):
    given = ["credit", "debit", None, "charge card", "debit or credit", "Credit"]
    kept = column(spark, given, lambda c: text.keep_or_other(c, ["credit", "debit"]))
    assert kept == ["credit", "debit", None, "other", "other", "other"]


def test_sparse_limit_is_strict_and_protection_holds(spark):
    df = spark.range(100).select(
        *[F.when(F.col("id") >= n, 1).alias(f"n{n}") for n in (89, 90, 91)], F.lit(None).cast("int").alias("empty"),
        F.lit(None).cast("int").alias("kept"),
    )
    kept, dropped = clean.drop_sparse_columns(df, df, 0.90, protected=["kept"])
    assert dropped == ["empty", "n91"]
    assert kept.columns == ["n89", "n90", "kept"]


def test_relative_time(spark):
    df = spark.createDataFrame([(s,) for s in (0, 3599, 3600, 86399, 86400, 604800)], "s bigint")
    rows = [tuple(r) for r in clean.derive_time(df, "s").orderBy("s").collect()]
    assert rows == [
        (0, 0, 0, 0), (3599, 0, 0, 0), (3600, 0, 1, 0), (86399, 0, 23, 0), (86400, 1, 0, 1), (604800, 7, 0, 0),
    ]
    assert dict(clean.derive_time(df, "s").dtypes)["day"] == "int"


def test_seconds_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:07.9' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = set()
        for zone in ("UTC", "Europe/Madrid", "America/Bogota"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(df.select(timing.seconds_since(F.col("ts"), "2024-01-01")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen == {90 * 86400 + 2 * 3600 + 30 * 60 + 7}


def test_dedup_is_repeatable_idempotent_and_independent_of_partitioning(spark):
    rows = [(i % 5, i % 3, f"t{i % 7}") for i in range(200)] + [(1, None, None)]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    once = clean.dedup_by_key(df, ["k"], ["a"])
    expected = sorted(map(tuple, once.collect()), key=str)
    assert len(expected) == 5
    for n in (1, 3, 16):
        again = clean.dedup_by_key(df.repartition(n), ["k"], ["a"])
        assert sorted(map(tuple, again.collect()), key=str) == expected
    assert sorted(map(tuple, clean.dedup_by_key(once, ["k"], ["a"]).collect()), key=str) == expected


def test_slice_filter_ignores_unknown_and_empty_choices(spark):
    df = spark.createDataFrame([(d, c) for d in range(5) for c in "ab"], "day int, c string")
    chosen = clean.slice_filter(df, (1, 3), {"c": ["a"], "absent": ["x"]})
    assert sorted(r.day for r in chosen.collect()) == [1, 2, 3]
    assert clean.slice_filter(df, None, {"c": []}).count() == 10


def test_rates_round_half_up(spark):
    rows = [(1, 8), (1005, 100_000), (285, 100_000), (0, 3), (2, 3)]
    df = spark.createDataFrame(rows, "p bigint, n bigint")
    got = [r[0] for r in df.select(measures.half_up(F.col("p") * 100, F.col("n"), 2)).collect()]
    assert got == [12.5, 1.01, 0.29, 0.0, 66.67]
    empty = spark.createDataFrame([(0, 0)], "p bigint, n bigint")
    assert empty.select(measures.half_up(F.col("p"), F.col("n"), 2)).first()[0] is None
    assert empty.select(measures.ratio_or_zero(F.col("p"), F.col("n"), 2)).first()[0] == 0.0


def test_money_keeps_sub_cent_amounts_and_signs(spark):
    df = spark.createDataFrame([(31.937,), (0.001,), (0.002,)], "a double")
    assert df.agg(measures.money(F.sum(measures.units("a")))).first()[0] == 31.94
    negative = spark.createDataFrame([(-1.25,), (-2.5,)], "a double")
    assert negative.agg(measures.money(F.sum(measures.units("a")))).first()[0] == -3.75


def test_latency(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' a, TIMESTAMP'2024-01-01 00:00:03.415' b")
    assert df.select(timing.elapsed_seconds(F.col("b"), F.col("a"))).first()[0] == 3.42


def test_left_join_keeps_all_facts_and_marks_presence(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    side = spark.createDataFrame([(2, None), (9, "z")], "k int, s string")
    rows = joins.left_join_presence(facts, side, "k", "has").orderBy("k").collect()
    assert [(r.k, r.s, r.has) for r in rows] == [(1, None, False), (2, None, True), (3, None, False)]


def test_union_fills_missing_columns_with_null(spark):
    a = spark.createDataFrame([(1, 0)], "k int, y int")
    b = spark.createDataFrame([(2,)], "k int")
    assert sorted(map(tuple, joins.union_missing(a, b).collect()), key=str) == [(1, 0), (2, None)]


def test_coverage_of_a_hot_key(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("k"))
    side = spark.createDataFrame([(7,), (7,), (500,)], "k bigint")
    assert tuple(joins.side_coverage(facts, side, "k").first()) == (1000, 401, 40.1)


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_exact_quantiles_against_brute_force(spark, n):
    values = [float((i * 7919) % 1013) if i % 3 else 5.0 for i in range(n)]  # a third of all rows share one value
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "v double, y int")
    got = {(r.grp, r.prob): r.quantile for r in quantiles.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0], "y").collect()}
    for grp in ("all", "0", "1"):
        mine = sorted(v for i, v in enumerate(values) if grp == "all" or str(i % 2) == grp)
        for p in (0.0, 0.25, 0.5, 0.99, 1.0):
            if not mine:
                assert (grp, p) not in got
                continue
            pos = p * (len(mine) - 1)
            lo = int(pos)
            hi = min(lo + (pos > lo), len(mine) - 1)
            assert got[(grp, p)] == pytest.approx(mine[lo] + (mine[hi] - mine[lo]) * (pos - lo), abs=1e-9)


def test_box_stats_count_outliers(spark):
    df = spark.createDataFrame([(float(v), 1) for v in [1, 2, 3, 4, 5, 100]], "v double, y int")
    row = profile.box_stats(df, "v", "y").first()
    assert (row.q1, row.median, row.q3, row.low_whisker, row.high_whisker, row.outliers) == (2.25, 3.5, 4.75, 1.0, 5.0, 1)


def test_histogram_closes_the_last_bin_and_survives_one_value(spark):
    df = spark.createDataFrame([(0.0, 0), (9.0, 0), (9.0, 1)], "a double, y int")
    bins = {(r.label, r.bin): r.n for r in profile.amount_histogram(df, "a", "y").collect()}
    assert bins == {(0, 0): 1, (0, 48): 1, (1, 48): 1}
    flat = profile.amount_histogram(spark.createDataFrame([(4.0, 0), (4.0, 0)], "a double, y int"), "a", "y").collect()
    assert [(r.bin, r.n, r.density) for r in flat] == [(48, 2, None)]
