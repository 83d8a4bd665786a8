import pytest
from pyspark.sql import functions as F

from riskmart.config import RiskConfig
from riskmart.operators import features, models
from riskmart.plans import bindings as b


def test_columns_are_classified_by_family(spark):
    df = spark.createDataFrame([], "id bigint, s string, n double, f boolean, d decimal(9,2), ts timestamp")
    assert features.classify_columns(df, ["id", "ts"]) == (["n", "f", "d"], ["s"])
    with pytest.raises(TypeError, match="ts timestamp"):
        features.classify_columns(df, ["id"])


def test_split_days(spark):
    rows = [(d, "train") for d in range(1, 41)] + [(5, "test"), (99, "test")]
    df = spark.createDataFrame(rows, "day int, dataset string")
    split = {(r.day, r.dataset): r.split for r in features.temporal_split(df, 30).collect()}
    assert split[(10, "train")] == "entrenamiento" and split[(11, "train")] == "validacion"
    assert split[(40, "train")] == "validacion" and split[(5, "test")] == split[(99, "test")] == "test_kaggle"


def test_categories_are_counted_on_training_rows_only(spark):
    rows = [(d, "train", f"c{d % 3}", f"v{d}") for d in range(10)] + [(20, "test", "other", "x")]
    df = spark.createDataFrame(rows, "day int, dataset string, few string, many string")
    strict = features.decide_features(df, ["day", "dataset"], 3, 7)
    assert (strict.categorical, strict.excluded) == (("few", "many"), ())
    loose = features.decide_features(df, ["day", "dataset"], 3, 7, training_only=False)
    assert (loose.categorical, loose.excluded) == (("few",), ("many",))


def test_feature_table_fills_after_counting_nulls(spark):
    rows = [(1, 1, 10.0, 0, "train", None, True, "a"), (2, 0, 0.0, 9, "train", 3, False, None), (3, None, 5.0, 1, "test", None, None, None)]
    df = spark.createDataFrame(rows, "id int, y int, amount double, day int, dataset string, n int, f boolean, s string")
    lists = features.decide_features(df, ["id", "y", "day", "dataset"], 60, 3)
    out = features.feature_table(df, lists, "id", "y", "amount", 3)
    assert out.columns == ["id", "y", "amount", "split", "n", "f", "null_count", "log_amount", "s"]
    got = {r.id: (r.split, r.n, r.f, r.null_count, r.s) for r in out.collect()}
    assert got == {
        1: ("entrenamiento", -999, 1, 1, "a"), 2: ("validacion", 3, 0, 1, "missing"), 3: ("test_kaggle", -999, -999, 3, "missing"),
    }
    assert features.model_inputs(lists, "amount") == ["n", "f", "null_count", "log_amount", "amount"]


def test_weights_and_their_guards(spark):
    df = spark.range(505_110).select((F.col("id") < 17_669).cast("int").alias("y"))
    assert round(features.class_weight(df, "y").first().positive_weight, 2) == 27.59
    assert features.class_weight(df.filter("y = 0"), "y").first().positive_weight == 487_441.0
    assert features.class_weight(df.filter("y = 1"), "y").first().positive_weight == 1 / 17_669
    weighted = features.class_weights(df, "y").groupBy("y").agg(F.max("weight").alias("w")).collect()
    assert {r.y: round(r.w, 2) for r in weighted} == {0: 1.0, 1: 27.59}


def test_sample_keeps_positives_and_is_the_same_on_any_partitioning(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 20 == 0).cast("int").alias("y"))
    sample = features.stratified_sample(df, "y", F.col("id"), 0.2, seed=42)
    again = features.stratified_sample(df.repartition(13), "y", F.col("id"), 0.2, seed=42)
    ids = {r.id for r in sample.collect()}
    assert ids == {r.id for r in again.collect()}
    assert {i for i in range(0, 20_000, 20)} <= ids
    assert abs((len(ids) - 1000) / 19_000 - 0.2) < 0.02
    assert features.stratified_sample(df, "y", F.col("id"), 1.0).count() == df.count()


@pytest.fixture(scope="module")
def signal(spark):
    rows = spark.range(4000).select(
        "id",
        ((F.col("id") * 7919) % 1000 / 10.0).alias("amount"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("cat"),
        (F.col("id") % 3).cast("double").alias("noise"),
    )
    label = ((F.col("amount") > 70) & F.col("cat").isin("c1", "c2")) | (F.col("id") % 97 == 0)
    return rows.withColumn("y", label.cast("int")).withColumn("weight", F.lit(1.0)).cache()


def test_boosting_finds_a_signal_and_survives_storage(spark, signal, tmp_path):
    from riskmart.operators import evaluation

    model = models.train_gbt(signal, ["amount", "noise"], ["cat"], "y", "weight", RiskConfig(trees=5))
    scored = models.score_table(model, signal, ["id", "y"], 0.5)
    assert evaluation.roc_auc(scored, "score", "y").first()[0] > 0.9
    assert scored.filter((F.col("score") < 0) | (F.col("score") > 1) | (F.col("alert") != (F.col("score") >= 0.5))).count() == 0
    top = models.feature_importance(model, signal, top=2).collect()
    assert {r.feature for r in top} == {"amount", "cat"} and top[0].importance >= top[1].importance
    models.save_model(model, str(tmp_path / "m"))
    again = models.score_table(models.load_model(str(tmp_path / "m")), signal, ["id", "y"], 0.5)
    assert scored.exceptAll(again).count() == 0
    unseen = signal.limit(1).withColumn("cat", F.lit("never seen"))
    assert models.score_table(model, unseen, ["id"], 0.5).count() == 1


def test_baseline_learns(spark, signal):
    from riskmart.operators import evaluation

    model = models.train_baseline(signal, ["amount", "noise"], ["cat"], "y", "weight", RiskConfig())
    assert evaluation.roc_auc(models.with_score(model, signal), "score", "y").first()[0] > 0.75


def test_event_features_have_no_nulls(spark, sf):
    silver = b.event_silver(spark, sf)
    lists = features.decide_features(silver, b.EVENT_NOT_FEATURES, 60, b.VALIDATION_DAYS)
    table = features.feature_table(silver, lists, "id", "is_positive", "amount", b.VALIDATION_DAYS)
    nulls = table.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in table.columns]).first().asDict()
    assert set(nulls.values()) == {0}
    assert table.count() == silver.count()


def test_a_fit_uses_all_cores_and_bounded_partitions(spark, monkeypatch):
    rows = spark.range(1000).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert models.spread(rows).rdd.getNumPartitions() == cores
    monkeypatch.setattr(models, "FIT_ROWS", 10)
    dealt = models.spread(rows).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(dealt) == max(cores, 100) and sum(dealt) == 1000 and max(dealt) <= 20
