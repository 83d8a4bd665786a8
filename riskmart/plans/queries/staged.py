"""Queries: the batch stages from raw files to KPI tables, and the stored model on a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from riskmart.config import Layout, RiskConfig
from riskmart.plans import bindings as b
from riskmart.plans import serving, stages
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.registry import query
from riskmart.session import scratch_path
from riskmart.sources import readers, writers
from riskmart.streaming import messages

CONFIG = RiskConfig(validation_days=b.VALIDATION_DAYS)

_RAW = f"""{s.EV}, raw AS (SELECT *, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 <
  CASE WHEN amount > 80 THEN 350 ELSE 10 END + CASE WHEN channel = '3' THEN 300 ELSE 0 END
  + CASE WHEN starts_with(device_text, 'Moto') THEN 300 ELSE 0 END AS INTEGER) AS fraud FROM ev WHERE dataset = 'train')"""


@query("run_stages", f"WITH {_RAW} SELECT day, {s.bundle('fraud', 'amount')} FROM raw GROUP BY day")
def run_stages(spark, sf):
    root = scratch_path(spark, "stages")
    b.raw_files(spark, sf, f"{root}/raw")
    layout = Layout(root)
    stages.run_stages(spark, layout, CONFIG, f"{root}/raw", ["bronze", "silver", "gold_kpis"])
    return readers.read_table(spark, layout.gold("kpis_daily"))


@query(
    "stage_outputs",
    f"""WITH {_RAW}, last AS (SELECT max(day) AS day FROM raw)
SELECT 'kpis_daily' AS output, count(DISTINCT day) AS n_rows, CAST(NULL AS DOUBLE) AS rate_pct FROM raw
UNION ALL SELECT 'predictions_validation', count(*), NULL FROM raw WHERE day > (SELECT day FROM last) - {b.VALIDATION_DAYS}
UNION ALL SELECT 'threshold_curve', 19, NULL
UNION ALL SELECT 'findings', 8, {s.half_up('100 * sum(fraud)', 'count(*)', 3)} FROM raw""",
)
def stage_outputs(spark, sf):
    """All seven stages, over bucketed bronze tables: rows of the exported files and of the report, and its rate."""
    root = scratch_path(spark, "all-stages")
    b.raw_files(spark, sf, f"{root}/raw")
    layout = Layout(root, buckets=8)
    stages.run_stages(spark, layout, replace(CONFIG, trees=3, baseline_iterations=5), f"{root}/raw", stages.ORDER)
    none = F.lit(None).cast("double").alias("rate_pct")
    out = None
    for name in ("kpis_daily", "predictions_validation", "threshold_curve"):
        exported = spark.read.option("header", True).csv(layout.table("export", name))
        rows = exported.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n_rows"), F.max(none).alias("rate_pct"))
        out = rows if out is None else out.unionByName(rows)
    facts = readers.read_table(spark, layout.gold("findings"))
    rate = F.max(F.when(F.col("fact") == "global_rate_pct", F.col("value")))
    return out.unionByName(facts.agg(F.lit("findings").alias("output"), F.count(F.lit(1)).alias("n_rows"), rate.alias("rate_pct")))


@query(
    "score_stream",
    f"""WITH {_RAW} SELECT id AS "TransactionID", day, hour, true AS in_range, true AS as_in_batch FROM raw WHERE day = {b.HOLDOUT_FROM_DAY - 1}""",
)
def score_stream(spark, sf):
    """All stages, then one stored day replayed through the scoring stream: scores next to the batch scores."""
    root = scratch_path(spark, "scored-stream")
    b.raw_files(spark, sf, f"{root}/raw")
    layout = Layout(root)
    stages.run_stages(spark, layout, CONFIG, f"{root}/raw")
    feed = f"{root}/feed"
    day = b.HOLDOUT_FROM_DAY - 1

    def send(rows):
        writers.write_messages(rows.withColumn("timestamp", F.current_timestamp()), feed, fmt="parquet")

    serving.replay_day(spark, layout, CONFIG, day, send)
    running, sink = serving.score_stream(spark, layout, CONFIG, messages.file_source(spark, feed), "day", None)
    running.awaitTermination()
    batch = readers.read_table(spark, layout.gold("predictions")).select(
        "TransactionID", F.col("score").alias("batch_score"), F.col("alert").alias("batch_alert")
    )
    streamed = spark.read.parquet(sink.alerts).select("TransactionID", "day", "hour", "score", "alert")
    s = F.col("score")
    same = (s == F.col("batch_score")) & (F.col("alert") == F.col("batch_alert"))
    return streamed.join(batch, "TransactionID", "left").select(
        "TransactionID", "day", "hour", ((s >= 0.0) & (s <= 1.0) & (s == F.round(s, 4))).alias("in_range"), F.coalesce(same, F.lit(False)).alias("as_in_batch")
    )
