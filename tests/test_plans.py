"""What the optimizer makes of the queries: scans, pushdown, no Python, no cross joins, skew."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskmart.operators import clean, economics, features, joins, kpis, profile
from riskmart.plans import bindings as b
from riskmart.plans.queries import QUERIES
from riskmart.sources import readers, writers

# these run jobs while they are built; their plans read finished tables
STORED = {
    "train_baseline", "train_gbt", "class_probability", "feature_importance", "score_table", "model_store", "run_stages",
    "score_stream", "stream_score", "message_source", "foreach_batch_sink", "micro_batch_trigger", "batch_stats",
    "hourly_backfill", "stream_panel", "stream_latest", "exactly_once_append", "ingest_once", "export_csv",
    "keyed_dedup", "stream_compaction", "ingest_quarantine", "stage_outputs",
}
LAZY = sorted(set(QUERIES) - STORED)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in text


def test_segments_take_one_scan_per_table_and_only_their_columns(spark, sf):
    text = plan(entry.queries()["segment_risk"](spark, sf))
    assert text.count("FileScan parquet") == 4 and text.count("Expand") == 1
    assert text.count("Exchange hashpartitioning(segment") == 1
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_tax" not in scan and "l_shipdate" not in scan


def test_thresholds_take_one_scan_of_the_scores(spark, sf):
    scored = b.scored_events(spark, sf)
    text = plan(economics.threshold_curve(scored, "score", "is_positive", "amount", 7))
    assert text.count("FileScan parquet") == 1
    # the score is computed once per row, not once per threshold
    assert text.count("md5") == 1


def test_duplicates_are_dropped_before_the_shuffle(spark, sf):
    text = plan(clean.dedup_by_key(b.table(spark, sf, "lineitem"), ["l_orderkey"]))
    lines = [n for n in re.findall(r"(WindowGroupLimit|Exchange)", text)]
    assert lines == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]
    assert ", Partial" in text and ", Final" in text


def test_dedup_and_join_share_one_shuffle_per_side(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = clean.dedup_by_key(b.table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"])
        labels = clean.dedup_by_key(b.table(spark, sf, "labels"), ["doc_id"])
        text = plan(joins.left_join_presence(docs, labels, "doc_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2


def test_coverage_counts_keys_before_the_join(spark, sf):
    facts = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    side = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.side_coverage(facts, side, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_partitions_are_pruned(spark, sf, tmp_path):
    path = str(tmp_path / "events")
    writers.write_partitioned(b.events_frame(spark, sf), path, "dataset")
    text = plan(clean.filter_partition(readers.read_table(spark, path), "dataset", "train").select("id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(dataset#\d+\), \(dataset#\d+ = train\)\]", text)
    assert "ReadSchema: struct<id:bigint>" in text


def test_filters_reach_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "cube")
    writers.write_snapshot(kpis.daily_cube(b.events_frame(spark, sf), ["channel"], "is_positive", "amount"), path)
    text = plan(clean.slice_filter(readers.read_table(spark, path), (5, 20), {"channel": ["1", "3"]}))
    assert "GreaterThanOrEqual(day,5)" in text and "LessThanOrEqual(day,20)" in text and "In(channel, [1,3])" in text


def test_null_count_stays_out_of_interpreted_lambdas(spark, sf):
    docs = b.documents_frame(spark, sf)
    text = plan(docs.select(features.null_count(docs.columns)))
    assert "lambda" not in text


def test_a_hot_join_key_is_split(spark, tmp_path):
    """A third of all facts share one key: the runtime plan splits that partition."""
    facts = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    facts.repartition(16).write.parquet(str(tmp_path / "facts"))
    side = spark.range(300_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    side.write.parquet(str(tmp_path / "side"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.left_join_presence(
            spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "side")), "k"
        )
        assert joined.filter("has_side").agg(F.count("s")).first()[0] == 300_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        text = plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(rows) == 300_000
    assert "skew=true" in text


def test_only_the_wanted_value_ranges_are_shuffled(spark, sf):
    lines = b.line_facts(spark, sf)
    text = plan(profile.box_stats(lines, "amount", "is_positive"))
    joins_ = [n for n in text.splitlines() if "Join" in n and "Subquery" not in n]
    assert "LeftSemi" not in text and "array_contains" in text and joins_
