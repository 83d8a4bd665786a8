"""The batch stages: raw files to bronze, silver, KPI tables, features, model and export.

A stage is a function of session, layout and configuration. It reads the tables of the stage
before, writes its own, and returns a few summary values, which also go to the run-metrics table.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from riskmart.config import (
    AUDIT_COLUMNS, DATASET_TEST, DATASET_TRAIN, SPLIT_HOLDOUT, SPLIT_TRAIN, SPLIT_VALIDATION, Layout, RiskConfig,
)
from riskmart.functions import text
from riskmart.operators import clean, economics, evaluation, features, joins, kpis, models, profile, sketches
from riskmart.session import cut_lineage, in_scope, scoped
from riskmart.sources import buckets, readers, writers

log = logging.getLogger("riskmart")

# Source files, one table each.
SOURCES = ("train_transaction", "train_identity", "test_transaction", "test_identity")
Schemas = dict[str, T.StructType]


def _staged(layout: Layout, name: str) -> str:
    """Where a run keeps an intermediate table: its own place, gone when the stage is done."""
    return in_scope(layout.staging(f"{name}-{uuid.uuid4().hex}"))


def bucketed(layout: Layout, cfg: RiskConfig, name: str) -> buckets.Buckets | None:
    return None if layout.buckets is None else buckets.Buckets(layout.bronze(name), cfg.key, layout.buckets)


@scoped
def bronze(spark: SparkSession, layout: Layout, cfg: RiskConfig, raw: str, schemas: Schemas | None = None) -> dict:
    """Load every source file once; a missing source is skipped and a file that does not fit is set aside, with a warning."""
    loaded = {}
    for name in SOURCES:
        try:
            load = readers.ingest_once(
                spark, f"{raw.rstrip('/')}/{name}.csv", layout.bronze(name), layout.meta(f"manifest_{name}"),
                (schemas or {}).get(name), fmt=layout.fmt, bucketed=bucketed(layout, cfg, name),
                set_misfits_aside=True, lease=None if cfg.loader is None else readers.Lease(cfg.loader),
            )
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            log.warning("source %s does not exist, skipped", name)
            load = readers.Loaded(0, ())
        loaded[f"{name}_files"] = load.files
        aside = readers.set_aside(spark, layout.meta(f"manifest_{name}")).collect()  # one row per misfit file
        loaded[f"{name}_set_aside"] = len(aside)
        for r in aside:
            log.warning("file %s is set aside: %s", r.path, r.reason)
        if load.files:
            # only the partitions just written are counted
            table = readers.read_table(spark, layout.bronze(name), layout.fmt)
            check = readers.ingest_load_check(clean.filter_partition(table, "_batch", *load.batches))
            loaded[f"{name}_rows"] = check.agg(F.sum("n_rows")).first()[0] or 0
    return loaded


DELIVERED = "_ingest_ts"


def _bronze_rows(spark: SparkSession, layout: Layout, cfg: RiskConfig, name: str) -> DataFrame:
    """One row per key: that of the newest delivery; of several in one delivery, the one with values where others have none."""
    table = bucketed(layout, cfg, name)
    rows = readers.read_table(spark, layout.bronze(name), layout.fmt) if table is None else buckets.read(spark, table)
    named = clean.normalize_names(clean.drop_audit(rows, [c for c in (*AUDIT_COLUMNS, "_batch") if c != DELIVERED]))
    rest = [F.col(c).asc_nulls_last() for c in named.columns if c not in (cfg.key, DELIVERED)]
    return clean.dedup_by_key(named, [cfg.key], [F.col(DELIVERED).desc(), *rest]).drop(DELIVERED)


def clean_rows(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Trim, derive time, group mail domains and device texts, fold rare levels."""
    df = clean.trim_strings(clean.derive_time(df, cfg.seconds))
    derived = {
        target: text.first_label(F.col(source)) for source, target in cfg.email_columns if source in df.columns
    }
    if cfg.device_text in df.columns:
        derived[cfg.device_brand] = text.device_brand(F.col(cfg.device_text))
    if cfg.rare_column in df.columns:
        derived[cfg.rare_column] = text.keep_or_other(F.col(cfg.rare_column), cfg.rare_keep)
    return df.withColumns(derived) if derived else df


def joined_rows(spark: SparkSession, layout: Layout, cfg: RiskConfig, dataset: str) -> DataFrame:
    """The facts of a dataset with their side rows; over bucketed bronze tables without a shuffle."""
    facts, side = (_bronze_rows(spark, layout, cfg, f"{dataset}_{kind}") for kind in ("transaction", "identity"))
    return joins.left_join_presence(facts, side, cfg.key, cfg.presence).withColumn("dataset", F.lit(dataset))


@scoped
def silver(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """Join facts and side rows, drop sparse columns, clean; one table with a partition per dataset."""
    parts = [
        joined_rows(spark, layout, cfg, ds)
        for ds in (DATASET_TRAIN, DATASET_TEST)
        if readers.table_exists(spark, layout.bronze(f"{ds}_transaction"), layout.fmt)
    ]
    # Which columns stay depends on the joined rows. They are stored once, so that the profile and
    # the final write read columns instead of repeating the shuffles.
    joined_path = _staged(layout, "silver_joined")
    writers.write_partitioned(joins.union_missing(*parts), joined_path, "dataset")
    joined = readers.read_table(spark, joined_path)
    training = clean.filter_partition(joined, "dataset", DATASET_TRAIN)
    nulls = clean.null_profile(training)
    sparse = cut_lineage(clean.sparse_columns(nulls, cfg.max_null_fraction, cfg.protected), "sparse-columns", _staged(layout, "sparse_columns"))
    dropped = [r.column_name for r in sparse.orderBy("column_name").collect()]  # one row per column at most
    writers.write_snapshot(sparse, layout.meta("silver_dropped_columns"), layout.fmt)

    path = layout.silver("transactions")
    writers.write_partitioned(clean_rows(joined.drop(*dropped), cfg), path, "dataset", fmt=layout.fmt)
    table = readers.read_table(spark, path, layout.fmt)
    summary = {"columns": len(table.columns), "dropped_columns": len(dropped), "max_null_fraction": cfg.max_null_fraction}
    for r in kpis.dataset_summary(table, cfg.label, cfg.presence).collect():  # one row per dataset
        summary[f"{r.dataset}_rows"] = r.n_rows
        if r.dataset == DATASET_TRAIN:
            summary |= {"rate_pct": r.rate_pct, "coverage_pct": r.coverage_pct}
    return summary


def _training_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    table = readers.read_table(spark, layout.silver("transactions"), layout.fmt)
    return clean.filter_partition(table, "dataset", DATASET_TRAIN)


@scoped
def gold_kpis(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """Daily table, cube, segments and totals: two column-pruned scans, nothing cached."""
    train = _training_rows(spark, layout)
    # the daily table and the totals are sums of the cube's sums
    sums = cut_lineage(kpis.cube_sums(train, cfg.cube_dims, cfg.label, cfg.amount), "cube-sums", _staged(layout, "cube_sums"))
    writers.write_snapshot(kpis.cube_from_sums(sums), layout.gold("cube_daily"), layout.fmt)
    writers.write_snapshot(kpis.bundle_from_sums(sums, ["day"]), layout.gold("kpis_daily"), layout.fmt)
    segments = kpis.segment_risk(train, cfg.segments, cfg.label, cfg.amount, cfg.min_support)
    writers.write_snapshot(segments, layout.gold("segment_risk"), layout.fmt)

    total = kpis.global_from_sums(sums).first()
    stored = readers.read_table(spark, layout.gold("segment_risk"), layout.fmt)
    summary = total.asDict()
    for r in kpis.riskiest_value(stored).collect():  # one row per segment
        summary[f"riskiest_{r.segment}"] = f"{r.riskiest} ({r.rate_pct} %)"
    return summary


@scoped
def gold_features(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """The feature table with a partition per split, and the decisions that shaped it."""
    table = readers.read_table(spark, layout.silver("transactions"), layout.fmt)
    lists = features.decide_features(
        table, cfg.not_features, cfg.max_categories, cfg.validation_days,
        training_only=cfg.cardinality_on_training_only,
    )
    built = features.feature_table(table, lists, cfg.key, cfg.label, cfg.amount, cfg.validation_days)
    path = layout.gold("features")
    writers.write_partitioned(built, path, "split", fmt=layout.fmt)

    stored = readers.read_table(spark, path, layout.fmt)
    cutoff = kpis.cutoff_day(_training_rows(spark, layout), cfg.validation_days)
    descriptor = features.feature_descriptor(stored, lists, cutoff)
    writers.write_snapshot(descriptor, layout.meta("features"), layout.fmt)
    summary = {"numeric": len(lists.numeric) + 2, "categorical": len(lists.categorical), "excluded": len(lists.excluded)}
    bounded = readers.read_table(spark, layout.meta("features"), layout.fmt).filter(F.col("value").isNotNull())
    return summary | {r.name: r.value for r in bounded.collect()}


def stored_lists(spark: SparkSession, layout: Layout) -> features.FeatureLists:
    """The column decisions of the stored feature table, in its column order."""
    kinds = {
        r.name: r.kind
        for r in readers.read_table(spark, layout.meta("features"), layout.fmt).collect()  # one row per column
        if r.kind in ("numeric", "categorical", "excluded")
    }
    order = readers.read_table(spark, layout.gold("features"), layout.fmt).columns
    pick = lambda kind: tuple(c for c in order if kinds.get(c) == kind)
    return features.FeatureLists(pick("numeric"), pick("categorical"), tuple(c for c, k in kinds.items() if k == "excluded"))


def _quality(scored: DataFrame, curve: DataFrame, cfg: RiskConfig) -> dict:
    areas = evaluation.areas(scored, "score", cfg.label)
    at_half = economics.metrics_at(curve, 0.5).drop("threshold")
    return areas.first().asDict() | at_half.first().asDict()


@scoped
def model(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """Fit, score once, find the cheapest threshold, store scores, curve, importances and model."""
    table = readers.read_table(spark, layout.gold("features"), layout.fmt)
    lists = stored_lists(spark, layout)
    inputs = features.model_inputs(lists, cfg.amount)
    training = features.stratified_sample(
        clean.filter_partition(table, "split", SPLIT_TRAIN), cfg.label, F.col(cfg.key), cfg.negative_fraction, cfg.seed
    )
    balance = features.class_weight(training, cfg.label).first()  # one row
    weighted = training.withColumn(
        "weight", F.when(F.col(cfg.label) == 1, F.lit(balance.positive_weight)).otherwise(F.lit(1.0))
    )  # a stored table with one more column: the fits keep their own encoded form
    validation = clean.filter_partition(table, "split", SPLIT_VALIDATION)
    summary = {"positive_weight": round(balance.positive_weight, 2), "training_positives": balance.positives, "training_negatives": balance.negatives}

    def curve_of(scored: DataFrame) -> DataFrame:
        return economics.threshold_curve(
            scored, "score", cfg.label, cfg.amount, cfg.validation_days, cfg.review_cost, cfg.chargeback_cost, cfg.thresholds
        )

    keep = [cfg.key, "split", cfg.label, cfg.amount]
    if cfg.with_baseline:
        baseline = models.train_baseline(weighted, inputs, lists.categorical, cfg.label, "weight", cfg)
        scored = cut_lineage(models.with_score(baseline, validation).select(*keep, "score"), "baseline-scores", _staged(layout, "baseline_scores"))
        summary |= {f"baseline_{k}": v for k, v in _quality(scored, curve_of(scored), cfg).items()}
    boosted = models.train_gbt(weighted, inputs, lists.categorical, cfg.label, "weight", cfg)
    models.save_model(boosted, layout.model("gbt"))
    writers.write_snapshot(models.feature_importance(boosted, table), layout.gold("feature_importance"), layout.fmt)

    # validation and holdout are scored once; the threshold is chosen on the stored scores
    both = joins.union_scored(table, [SPLIT_VALIDATION, SPLIT_HOLDOUT])
    scores = cut_lineage(models.with_score(boosted, both).select(*keep, "score"), "scores", _staged(layout, "scores"))
    scored = clean.filter_partition(scores, "split", SPLIT_VALIDATION)
    curve = cut_lineage(curve_of(scored), "threshold-curve", _staged(layout, "threshold_curve"))
    writers.write_snapshot(curve, layout.gold("threshold_curve"), layout.fmt)
    best = economics.optimal_threshold(curve, cfg.validation_days)
    writers.write_snapshot(best, layout.gold("optimal_threshold"), layout.fmt)
    chosen = best.first()
    writers.write_partitioned(
        models.flag_alerts(scores, chosen.threshold), layout.gold("predictions"), "split", fmt=layout.fmt
    )
    quality = _quality(scored, curve, cfg)
    summary |= quality
    summary["passed"] = float(quality["roc_auc"] >= cfg.min_roc_auc and quality["recall"] >= cfg.min_recall)
    summary |= {f"best_{k}": v for k, v in chosen.asDict().items()}
    summary |= {"review_cost": cfg.review_cost, "chargeback_cost": cfg.chargeback_cost}
    return summary


@scoped
def export(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """The gold tables as CSV. One file only where the number of rows is bounded, by days or by thresholds."""

    def gold(name: str) -> DataFrame:
        return readers.read_table(spark, layout.gold(name), layout.fmt)

    def predictions() -> DataFrame:
        scored = clean.filter_partition(gold("predictions"), "split", SPLIT_VALIDATION).drop("split")
        facts = readers.read_table(spark, layout.silver("transactions"), layout.fmt)
        return joins.enrich_scores(scored, facts, cfg.key, ["day", "hour", *cfg.business])

    cube = gold("cube_daily")
    exports = [
        # name, rows, order, bounded
        ("cube_daily", cube, [c for c in ("day", *cfg.cube_dims) if c in cube.columns], False),
        ("kpis_daily", gold("kpis_daily"), ["day"], True),
        ("predictions_validation", predictions(), ["day", F.col("score").desc(), cfg.key], False),
        ("segment_risk", gold("segment_risk"), ["segment", F.col("rate_pct").desc(), "value"], False),
        ("threshold_curve", gold("threshold_curve"), ["threshold"], True),
    ]
    for name, rows, order, bounded in exports:
        writers.export_csv(rows, layout.table("export", name), order, single_file=bounded)
    return {"tables": len(exports)}


@scoped
def report(spark: SparkSession, layout: Layout, cfg: RiskConfig) -> dict:
    """Profile of the training rows and the findings drawn from it."""
    train = _training_rows(spark, layout)
    nulls = cut_lineage(clean.null_profile(train), "null-profile", _staged(layout, "null_profile"))
    writers.write_snapshot(nulls, layout.gold("null_profile"), layout.fmt)
    amounts = cut_lineage(profile.percentiles_by_class(train, cfg.amount, cfg.label), "amounts", _staged(layout, "amounts"))
    writers.write_snapshot(amounts, layout.gold("amount_profile"), layout.fmt)
    # percentiles of any slice of days, without another pass over the rows
    writers.write_snapshot(sketches.daily_quantiles(train, cfg.amount, cfg.label), layout.gold("amount_sketches"), layout.fmt)
    dropped = readers.read_table(spark, layout.meta("silver_dropped_columns"), layout.fmt).count()
    segments = readers.read_table(spark, layout.gold("segment_risk"), layout.fmt)
    daily = readers.read_table(spark, layout.gold("kpis_daily"), layout.fmt)
    totals = kpis.reaggregate_slice(daily.withColumn("day", F.lit(0)))
    facts = profile.findings(totals, profile.null_buckets(nulls), amounts, segments, cfg.segments[0], dropped)
    writers.write_snapshot(facts, layout.gold("findings"), layout.fmt)
    return {"null_columns": nulls.filter(F.col("nulls") > 0).count()}


ORDER = ("bronze", "silver", "gold_kpis", "gold_features", "model", "report", "export")
DEFAULT = ORDER[:5]


def run_stages(
    spark: SparkSession,
    layout: Layout,
    cfg: RiskConfig,
    raw: str | None = None,
    stages: Sequence[str] = DEFAULT,
    schemas: Schemas | None = None,
) -> dict[str, dict]:
    """Run the chosen stages in their fixed order; stop at the first failure.

    Summaries and timings are appended to the run-metrics table, also for the stage that fails.
    """
    unknown = set(stages) - set(ORDER)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if "bronze" in stages and raw is None:
        raise ValueError("the bronze stage needs the folder of the raw files")
    run: dict[str, Callable[[], dict]] = {
        "bronze": lambda: bronze(spark, layout, cfg, raw, schemas),
        "silver": lambda: silver(spark, layout, cfg),
        "gold_kpis": lambda: gold_kpis(spark, layout, cfg),
        "gold_features": lambda: gold_features(spark, layout, cfg),
        "model": lambda: model(spark, layout, cfg),
        "report": lambda: report(spark, layout, cfg),
        "export": lambda: export(spark, layout, cfg),
    }
    run_id, results = uuid.uuid4().hex, {}
    for stage in (s for s in ORDER if s in stages):
        started = time.time()

        def record(outcome: dict, stage=stage, started=started) -> None:
            outcome = outcome | {"seconds": round(time.time() - started, 1)}
            log.info("stage %s: %s", stage, outcome)
            writers.append_run_metrics(writers.run_metrics(spark, run_id, stage, outcome), layout.meta("run_metrics"))

        try:
            results[stage] = run[stage]()
        except Exception:
            try:
                record({"failed": 1.0})
            except Exception:  # the stage's own error is the one to see
                log.exception("the metrics of the failed stage %s could not be written", stage)
            raise
        record(results[stage])
    return results
