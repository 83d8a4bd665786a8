from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskmart import session
from riskmart.config import Layout, RiskConfig
from riskmart.operators import features
from riskmart.plans import bindings as b
from riskmart.plans import jobs, serving, stages


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stages"))
    b.raw_files(spark, "/root/testdata/sf0.01", f"{root}/raw")
    cfg = RiskConfig(validation_days=7, trees=4, baseline_iterations=5)
    results = stages.run_stages(spark, Layout(root), cfg, f"{root}/raw", stages.ORDER[::-1])  # order is fixed
    return root, cfg, results


def test_rows_are_conserved(spark, built):
    root, _, results = built
    assert list(results) == list(stages.ORDER)
    loaded = results["bronze"]
    silver = results["silver"]
    assert silver["train_rows"] == loaded["train_transaction_rows"] and silver["test_rows"] == loaded["test_transaction_rows"]
    split = results["gold_features"]
    assert split["entrenamiento"] + split["validacion"] == silver["train_rows"] and split["test_kaggle"] == silver["test_rows"]
    assert silver["dropped_columns"] == 1 and silver["coverage_pct"] == 25.0
    names = spark.read.parquet(f"{root}/silver/transactions").columns
    assert "D7" not in names and "id_01" in names and "id-01" not in names


def test_rerun_of_bronze_loads_nothing(spark, built):
    root, cfg, _ = built
    again = stages.bronze(spark, Layout(root), cfg, f"{root}/raw")
    assert {v for v in again.values()} == {0}


def test_missing_sources_are_skipped(spark, built, tmp_path):
    _, cfg, _ = built
    assert set(stages.bronze(spark, Layout(str(tmp_path)), cfg, str(tmp_path / "none")).values()) == {0}


def test_scores_flags_and_threshold_agree(spark, built):
    root, _, results = built
    best = results["model"]["best_threshold"]
    scored = spark.read.parquet(f"{root}/gold/predictions")
    assert scored.filter(F.col("alert") != (F.col("score") >= best)).count() == 0
    assert results["model"]["roc_auc"] > results["model"]["baseline_roc_auc"] - 0.05
    assert results["model"]["roc_auc"] > 0.75
    curve = spark.read.parquet(f"{root}/gold/threshold_curve")
    assert curve.agg(F.min("total_cost")).first()[0] == results["model"]["best_total_cost"]
    lists = stages.stored_lists(spark, Layout(root))
    assert set(lists.categorical) == {"card6", "P_email_provider", "DeviceType", "device_brand"}
    assert "null_count" in features.model_inputs(lists, "TransactionAmt")


def test_export_and_metrics(spark, built):
    root, _, results = built
    exported = spark.read.option("header", True).csv(f"{root}/export/predictions_validation")
    assert exported.count() == results["gold_features"]["validacion"]
    assert {"day", "hour", "device_brand", "score", "alert"} <= set(exported.columns)
    metrics = spark.read.parquet(f"{root}/_meta/run_metrics")
    assert {r.stage for r in metrics.select("stage").distinct().collect()} == set(stages.ORDER)
    facts = {r.fact for r in spark.read.parquet(f"{root}/gold/findings").collect()}
    assert {"global_rate_pct", "riskiest", "least_risky", "max_over_median"} <= facts


def test_intermediate_tables_go_with_their_stage(spark, built, tmp_path, monkeypatch):
    root, _, _ = built
    assert not list(Path(root, "_staging").iterdir())
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    with session.scratch_scope(spark):
        kept = session.cut_lineage(spark.range(5), "inner")
        assert kept.count() == 5 and list(Path(tmp_path, "riskmart").iterdir())
    assert not list(Path(tmp_path, "riskmart").iterdir())
    with pytest.raises(RuntimeError), session.scratch_scope(spark):
        session.cut_lineage(spark.range(5), "inner")
        raise RuntimeError("lost")
    assert not list(Path(tmp_path, "riskmart").iterdir())
    outside = session.cut_lineage(spark.range(5), "outside")
    assert outside.count() == 5 and len(list(Path(tmp_path, "riskmart").iterdir())) == 1


def test_failure_keeps_the_evidence(spark, tmp_path):
    with pytest.raises(Exception):
        stages.run_stages(spark, Layout(str(tmp_path)), RiskConfig(), stages=["gold_kpis"])
    row = spark.read.parquet(f"{tmp_path}/_meta/run_metrics").filter("metric = 'failed'").first()
    assert (row.stage, row.value) == ("gold_kpis", 1.0)
    with pytest.raises(ValueError, match="unknown"):
        stages.run_stages(spark, Layout(str(tmp_path)), RiskConfig(), stages=["nope"])


def test_silver_reads_are_pruned(spark, built):
    root, cfg, _ = built
    plan = stages._training_rows(spark, Layout(root)).groupBy("day").count()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan and "ReadSchema: struct<day:int>" in plan


def test_stream_scores_equal_batch_scores(spark):
    rows = entry.queries()["score_stream"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.in_range and r.as_in_batch and r.day == 24 for r in rows)


def test_sources_can_be_sampled(spark, built, tmp_path):
    root, cfg, _ = built
    serving.sample_sources(spark, f"{root}/raw", str(tmp_path), cfg, 0.2)
    facts = spark.read.option("header", True).csv(f"{tmp_path}/train_transaction.csv")
    side = spark.read.option("header", True).csv(f"{tmp_path}/train_identity.csv")
    assert 0.15 < facts.count() / 8339 < 0.25
    assert side.join(facts, "TransactionID", "left_anti").count() == 0 and side.count() > 0
    whole = spark.read.option("header", True).csv(f"{root}/raw/train_transaction.csv")
    assert facts.exceptAll(whole).count() == 0  # every field as it was written


def test_command_line():
    args = jobs.arguments(["stages", "--root", "r", "--raw", "x", "--stages", "silver", "--trees", "30", "--negative-fraction", "0.2", "--without-baseline"])
    cfg = jobs.config_from(args)
    assert (args.stages, cfg.trees, cfg.negative_fraction, cfg.with_baseline) == (["silver"], 30, 0.2, False)
    assert jobs.config_from(jobs.arguments(["replay", "--root", "r", "--servers", "s", "--day", "182"])).replay_day == 182
    assert jobs.config_from(jobs.arguments(["score", "--root", "r", "--servers", "s", "--keep-alerts"])).keep_alerts
    with pytest.raises(ValueError):
        RiskConfig(negative_fraction=0.0)
