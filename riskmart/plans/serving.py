"""The stored model on a stream, the replay of a stored day, and samples of the sources."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskmart.config import SPLIT_VALIDATION, Layout, RiskConfig
from riskmart.operators import clean, joins, models
from riskmart.plans.stages import SOURCES
from riskmart.session import in_scope, scoped
from riskmart.sources import readers, writers
from riskmart.streaming import compaction, messages, scoring


def score_stream(
    spark: SparkSession, layout: Layout, cfg: RiskConfig, source: DataFrame, stream_id: str, every: str | None
) -> tuple[StreamingQuery, scoring.Sink]:
    """Score messages with the batch model and the batch threshold.

    ``keep_alerts`` continues the named stream from its checkpoint; otherwise a new stream starts
    and its alerts stand beside the older ones under their own id.
    """
    model = models.load_model(layout.model("gbt"))
    best = readers.read_table(spark, layout.gold("optimal_threshold"), layout.fmt).select("threshold").first()
    wire = messages.message_schema(readers.read_table(spark, layout.gold("features"), layout.fmt).schema)
    keep = (cfg.key, "day", "hour", cfg.amount, cfg.label, *cfg.business)
    name = stream_id if cfg.keep_alerts else f"{stream_id}-{uuid.uuid4().hex}"
    sink = scoring.Sink(layout.gold("stream"), name)
    write = scoring.foreach_batch_sink(
        wire, cfg.key, cfg.label, lambda batch: models.with_score(model, batch), best.threshold, keep, sink,
        required=tuple(c for c in wire.fieldNames() if c not in (cfg.key, cfg.label, "sent_ts")),
    )
    single = messages.drop_repeats(source, cfg.repeat_within) if cfg.repeat_within else source
    return scoring.start(single, write, sink, every), sink


def score_topic(spark, layout: Layout, cfg: RiskConfig, servers: str, topic: str, stream_id: str) -> StreamingQuery:
    source = messages.kafka_source(spark, servers, topic)
    return score_stream(spark, layout, cfg, source, stream_id, cfg.trigger)[0]


def day_messages(spark: SparkSession, layout: Layout, cfg: RiskConfig, day: int) -> DataFrame:
    """Validation feature rows of one day with the hour they occurred in and their place in the day."""
    table = readers.read_table(spark, layout.gold("features"), layout.fmt)
    rows = clean.filter_partition(table, "split", SPLIT_VALIDATION).drop("split")
    times = readers.read_table(spark, layout.silver("transactions"), layout.fmt).select(cfg.key, "day", cfg.seconds)
    found = joins.rows_of_day(rows, times, cfg.key, day)
    if found.isEmpty():
        raise ValueError(f"day {day} has no rows in the validation window")
    return found


@scoped
def replay_day(
    spark: SparkSession, layout: Layout, cfg: RiskConfig, day: int, send: Callable[[DataFrame], None], pause_s: float = 0.0
) -> int:
    """Send one stored day hour by hour, each hour in event order and stamped when it is sent; returns the number of hours."""

    def send_hour(rows: DataFrame) -> None:
        send(messages.encode_messages(rows.orderBy(cfg.seconds, cfg.key).drop(cfg.seconds), cfg.key))

    staged = in_scope(layout.staging(f"replay-{uuid.uuid4().hex}"))
    return messages.hourly_backfill(day_messages(spark, layout, cfg, day), staged, send_hour, pause_s=pause_s)


def replay_topic(spark, layout: Layout, cfg: RiskConfig, servers: str, topic: str) -> None:
    def send(rows: DataFrame) -> None:
        writers.write_messages(rows, topic, **{"kafka.bootstrap.servers": servers})

    replay_day(spark, layout, cfg, cfg.replay_day, send, cfg.replay_pause_s)


def compact_stream(spark: SparkSession, layout: Layout, grace_s: float = 24 * 3600) -> bool:
    """Rewrite the batches of the scoring stream into a folder per day and delete what was replaced long ago."""
    compacted = compaction.compact(spark, layout.gold("stream"))
    compaction.vacuum(spark, layout.gold("stream"), grace_s)
    return compacted


def sample_sources(
    spark: SparkSession, raw: str, target: str, cfg: RiskConfig, fraction: float = 0.05, seed: int = 42
) -> None:
    """Sample the transactions by key and keep just the side rows that belong to them.

    All columns are read and written as the text they are: leading zeros and the form of times stay. Transactions come out
    in order of time, side rows in no order.
    """

    def as_text(name: str) -> DataFrame:
        return spark.read.option("header", True).csv(f"{raw}/{name}.csv")

    for facts, side in (SOURCES[:2], SOURCES[2:]):
        sampled, kept = joins.semi_join_sample(as_text(facts), as_text(side), cfg.key, fraction, seed)
        in_time = [F.col(cfg.seconds).cast("double"), F.col(cfg.key).cast("double"), F.col(cfg.key)]
        writers.export_csv(sampled, f"{target}/{facts}.csv", in_time)
        kept.write.mode("overwrite").option("header", True).csv(f"{target}/{side}.csv")
