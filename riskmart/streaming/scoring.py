"""Scoring stream: decode, score, write each batch exactly once, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskmart.functions.measures import count_if
from riskmart.functions.timing import elapsed_seconds
from riskmart.operators.kpis import alerts_hour_matrix
from riskmart.sources.readers import table_exists
from riskmart.streaming.messages import decode_messages, split_rejects

BATCH_KEYS = ("stream_id", "batch_id")


@dataclass(frozen=True)
class Sink:
    """Where a stream writes. ``stream_id`` names the checkpoint: batch numbers restart with a new one."""

    root: str
    stream_id: str

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def stats(self) -> str:
        return f"{self.root}/stats"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoints/{self.stream_id}"


def exactly_once_append(batch: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Write a batch to its own partition; a repeated batch replaces itself."""
    (
        batch.withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BATCH_KEYS)
        .parquet(path)
    )


def stream_score(
    batch: DataFrame, score: Callable[[DataFrame], DataFrame], threshold: float, keep: tuple[str, ...]
) -> DataFrame:
    """Scored rows with the alert flag, the columns the business reads and the three times."""
    scored = score(batch)
    business = [c for c in keep if c in scored.columns]
    return scored.select(
        *business,
        "score",
        # NaN is greater than any threshold: it does not alert
        ((F.col("score") >= F.lit(float(threshold))) & ~F.isnan(F.col("score").cast("double"))).alias("alert"),
        "sent_ts",
        "received_ts",
        F.current_timestamp().alias("scored_ts"),
    )


def latency_seconds() -> Column:
    return elapsed_seconds(F.col("scored_ts"), F.col("sent_ts"))


def _stat_columns(label: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        count_if(F.col("alert")).alias("alerts"),
        count_if(F.col("alert") & (F.col(label) == 1)).alias("true_alerts"),
        F.avg(latency_seconds()).alias("mean_latency_s"),
    ]


def batch_stats(scored: DataFrame, label: str) -> DataFrame:
    """Rows, alerts, true alerts and mean latency of scored rows."""
    return scored.agg(*_stat_columns(label)).withColumn("mean_latency_s", F.round("mean_latency_s", 2))


def _observed_row(spark: SparkSession, seen: dict) -> DataFrame:
    latency = seen.get("mean_latency_s")
    return spark.range(1).select(
        *[F.lit(seen.get(c, 0)).cast("bigint").alias(c) for c in ("n_rows", "alerts", "true_alerts")],
        F.lit(None if latency is None else round(latency, 2)).cast("double").alias("mean_latency_s"),
    )


def foreach_batch_sink(
    schema: T.StructType,
    key: str,
    label: str,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    keep: tuple[str, ...],
    sink: Sink,
    required: tuple[str, ...] = (),
) -> Callable[[DataFrame, int], None]:
    """The batch callback: alerts, rejects and statistics, all repeatable; empty batches are skipped.

    Messages that lack a ``required`` field are rejects: what the model was never shown as missing must not be missing. The statistics
    are written last: a batch that has them is whole, and a restarted stream that repeats it leaves it as it is.
    """
    started: list[int] = []  # batches since the start of this run

    def write(messages: DataFrame, batch_id: int) -> None:
        # both writes share one decoded batch; the statistics are observed while the alerts are
        # written, so they cost no second scoring and no listing of older batches
        decoded = decode_messages(messages, schema).persist()
        observed = Observation()
        try:
            # every partition is computed, and computed once: a stateful step before it has its state stored then
            if not decoded.count():
                return
            # only the first batch after a start can be one that was written before
            repeated = not started and table_exists(messages.sparkSession, f"{sink.stats}/stream_id={sink.stream_id}/batch_id={batch_id}")
            started.append(batch_id)
            if repeated:
                return
            rows, rejects = split_rejects(decoded, key, required)
            scored = stream_score(rows, score, threshold, keep).observe(observed, *_stat_columns(label))
            exactly_once_append(scored, sink.alerts, sink.stream_id, batch_id)
            exactly_once_append(rejects, sink.rejects, sink.stream_id, batch_id)
        finally:
            decoded.unpersist()
        stats = _observed_row(messages.sparkSession, observed.get)
        exactly_once_append(stats, sink.stats, sink.stream_id, batch_id)

    return write


def start(
    messages: DataFrame, write: Callable[[DataFrame, int], None], sink: Sink, every: str | None = None
) -> StreamingQuery:
    """Start the stream: every so often, or (without ``every``) once over everything available."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", sink.checkpoint)
        .trigger(**trigger)
        .start()
    )


def state_figures(running: StreamingQuery) -> dict[str, int]:
    """Keys held in state after the last batch, and messages dropped because they came too late."""
    steps = [op for p in running.recentProgress for op in p["stateOperators"]]
    held = running.lastProgress["stateOperators"] if running.lastProgress else []
    return {"in_state": sum(op["numRowsTotal"] for op in held), "late": sum(op["numRowsDroppedByWatermark"] for op in steps)}


def stream_panel(alerts: DataFrame, label: str) -> DataFrame:
    """Totals and days received, then the alerts per hour of the latest day, all from the alert table."""
    flagged = F.col("alert")
    per_day = alerts.groupBy("day").agg(
        F.count(F.lit(1)).alias("processed"),
        count_if(flagged).alias("alerts"),
        count_if(flagged & (F.col(label) == 1)).alias("true_alerts"),
    )
    total = per_day.agg(
        *[F.sum(c).alias(c) for c in ("processed", "alerts", "true_alerts")], F.count("day").alias("days")
    ).withColumn("part", F.lit("total"))
    current = alerts.filter(F.col("day") == alerts.agg(F.max("day")).scalar())
    hours = alerts_hour_matrix(current, label).select(
        F.lit("hour").alias("part"),
        "hour",
        (F.col("false_alarms") + F.col("true_alerts")).alias("alerts"),
        "true_alerts",
    )
    return total.unionByName(hours, allowMissingColumns=True).select(
        "part", "hour", "processed", "alerts", "true_alerts", "days"
    )


def mean_latency(alerts: DataFrame) -> DataFrame:
    """Mean seconds from sending to scoring."""
    return alerts.agg(F.round(F.avg(latency_seconds()), 2).alias("mean_latency_s"))
