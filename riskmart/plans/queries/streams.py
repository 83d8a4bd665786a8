"""Queries: the message format and the scoring stream, run over everything available."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.functions.timing import elapsed_seconds
from riskmart.operators import clean, joins, ranking
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.registry import query
from riskmart.session import scratch_path
from riskmart.sources import writers
from riskmart.streaming import compaction, messages, scoring

LABEL, AMOUNT = "is_positive", "amount"
KEEP = ("id", "day", "hour", AMOUNT, LABEL, "channel", "segment", "device_brand")
THRESHOLD = 0.5
EPOCH_SECONDS = 1_704_067_200
#: messages that one task shuffles and writes to a file, about 100 MB of text
FILE_MESSAGES = 500_000


def sent():
    return F.timestamp_seconds(F.lit(EPOCH_SECONDS) + F.col("seconds"))


def payload(spark, sf):
    """What a message carries: the event with its fixed score as one more field."""
    return b.scored_events(spark, sf, with_customer=True).select(
        "id", "seconds", "day", "hour", AMOUNT, LABEL, "channel", "segment", "score"
    )


def encoded(spark, sf):
    return messages.encode_messages(payload(spark, sf), "id", sent())


def wire_schema(spark, sf):
    return messages.message_schema(payload(spark, sf).schema)


def _arrived(rows):
    return rows.withColumn("timestamp", F.current_timestamp())


def _spoiled(rows):
    """Spoil every message whose id is a multiple of 50: cut in half, a number that is none, text behind the object, a field left out."""
    n = F.col("key").cast("bigint")
    half = F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    wrong_type = F.regexp_replace("value", '"amount":[^,]*', '"amount":"abc"')
    trailing = F.concat("value", F.lit(" and more"))
    left_out = F.regexp_replace("value", '"id":[^,]*,', "")
    kinds = F.element_at(F.array(half, wrong_type, trailing, left_out), ((n / 50).cast("int") % 4 + 1))
    return rows.withColumn("value", F.when(n % 50 == 0, kinds).otherwise(F.col("value")))


def in_files(spark, sf, rows):
    """Messages dealt to files by their key, and the number of files: four at least, so many that none holds more than about ``FILE_MESSAGES``."""
    n = b.table(spark, sf, "events").count()
    files = max(4, -(-n // FILE_MESSAGES))
    return rows.repartition(files, "key"), files


def _fixed_score(batch):
    return batch


def run_stream(spark, sf, rows, stream_id: str = "events", files_per_trigger: int | None = None):
    """Feed messages through the scoring stream until all are processed; returns its sink."""
    root = scratch_path(spark, "stream")
    feed = f"{root}/feed"
    _arrived(rows).write.parquet(feed)
    sink = scoring.Sink(root, stream_id)
    write = scoring.foreach_batch_sink(wire_schema(spark, sf), "id", LABEL, _fixed_score, THRESHOLD, KEEP, sink)
    scoring.start(messages.file_source(spark, feed, files_per_trigger), write, sink).awaitTermination()
    return sink


@query(
    "message_schema",
    f"""WITH {s.SC} SELECT * FROM (
  SELECT 'id' AS field, 'bigint' AS type, count(id) AS filled FROM sc UNION ALL SELECT 'seconds', 'bigint', count(seconds) FROM sc
  UNION ALL SELECT 'day', 'int', count(day) FROM sc UNION ALL SELECT 'hour', 'int', count(hour) FROM sc
  UNION ALL SELECT 'amount', 'double', count(amount) FROM sc UNION ALL SELECT 'is_positive', 'int', count(is_positive) FROM sc
  UNION ALL SELECT 'channel', 'string', count(channel) FROM sc UNION ALL SELECT 'segment', 'string', count(segment) FROM sc
  UNION ALL SELECT 'score', 'double', count(score) FROM sc UNION ALL SELECT 'sent_ts', 'timestamp', count(seconds) FROM sc)""",
)
def message_schema(spark, sf):
    schema = wire_schema(spark, sf)
    decoded = messages.decode_messages(_arrived(encoded(spark, sf)), schema).select(*schema.fieldNames())
    types = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, f.dataType.simpleString())])
    return clean.null_profile(decoded).select(
        F.col("column_name").alias("field"), types[F.col("column_name")].alias("type"),
        (F.col("n_rows") - F.col("nulls")).alias("filled"),
    )


_BACK = "id, seconds, day, hour, amount, is_positive, channel, segment, score"


@query("encode_messages", f"WITH {s.SC} SELECT CAST(id AS VARCHAR) AS key, {_BACK} FROM sc")
def encode_messages(spark, sf):
    value = F.from_json("value", wire_schema(spark, sf)).alias("m")
    return encoded(spark, sf).select("key", value).select("key", "m.*").drop("sent_ts")


@query("decode_messages", f"WITH {s.SC} SELECT id, day, hour, amount, score, CASE WHEN id % 50 = 0 THEN 'reject' ELSE 'row' END AS route FROM sc WHERE id % 50 <> 0 "
       "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'reject' FROM sc WHERE id % 50 = 0")
def decode_messages(spark, sf):
    decoded = messages.decode_messages(_arrived(_spoiled(encoded(spark, sf))), wire_schema(spark, sf))
    rows, rejects = messages.split_rejects(decoded, "id")
    good = rows.select("id", "day", "hour", "amount", "score", F.lit("row").alias("route"))
    return joins.union_missing(good, rejects.select(F.lit("reject").alias("route")))


@query("latency", f"""WITH {s.EV} SELECT id, CAST(CAST(floor((id * 137911 % 9000000 + 5000) / 10000) AS BIGINT) * 10000 AS DOUBLE) / 1e6 AS latency_s FROM ev""")
def latency(spark, sf):
    events = b.events_frame(spark, sf).select("id", sent().alias("sent_ts"))
    micros = F.unix_micros("sent_ts") + F.col("id") * 137_911 % 9_000_000
    late = events.withColumn("scored_ts", F.timestamp_micros(micros))
    return late.select("id", elapsed_seconds(F.col("scored_ts"), F.col("sent_ts")).alias("latency_s"))


_SCORED = f"WITH {s.SC} SELECT id, day, hour, amount, is_positive, channel, segment, score, alert FROM sc"
_OUT = ["id", "day", "hour", AMOUNT, LABEL, "channel", "segment", "score", "alert"]


@query("stream_score", _SCORED)
def stream_score(spark, sf):
    sink = run_stream(spark, sf, encoded(spark, sf))
    return spark.read.parquet(sink.alerts).select(*_OUT)


@query(
    "message_source",
    f"WITH {s.EV} SELECT CAST(id AS VARCHAR) AS key, true AS has_value, true AS has_time FROM ev",
)
def message_source(spark, sf):
    """A message stream with the columns of a topic, from files, appended to a table."""
    root = scratch_path(spark, "source")
    _arrived(encoded(spark, sf)).write.parquet(f"{root}/feed")
    query_ = (
        messages.file_source(spark, f"{root}/feed")
        .writeStream.format("parquet")
        .option("path", f"{root}/table")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.parquet(f"{root}/table").select(
        "key", F.col("value").isNotNull().alias("has_value"), F.col("timestamp").isNotNull().alias("has_time")
    )


@query(
    "foreach_batch_sink",
    f"""WITH {s.SC} SELECT 'alerts' AS target, count(*) AS n_rows FROM sc WHERE id % 50 <> 0
UNION ALL SELECT 'rejects', count(*) FROM sc WHERE id % 50 = 0""",
)
def foreach_batch_sink(spark, sf):
    sink = run_stream(spark, sf, _spoiled(encoded(spark, sf)))
    return spark.read.parquet(sink.alerts).select(F.lit("alerts").alias("target")).unionByName(
        spark.read.parquet(sink.rejects).select(F.lit("rejects").alias("target"))
    ).groupBy("target").agg(F.count(F.lit(1)).alias("n_rows"))


@query("micro_batch_trigger", f"WITH {s.SC} SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, true AS several_batches FROM sc")
def micro_batch_trigger(spark, sf):
    rows, files = in_files(spark, sf, encoded(spark, sf))
    sink = run_stream(spark, sf, rows, files_per_trigger=-(-files // 2))
    written = spark.read.parquet(sink.alerts)
    # ids are grouped first: the distinct count then needs no second shuffle of single rows
    per_id = written.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("batch_id").alias("last"), F.min("batch_id").alias("first"))
    return per_id.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), (F.max("last") > F.min("first")).alias("several_batches")
    )


@query(
    "batch_stats",
    f"""WITH {s.SC} SELECT count(*) AS n_rows, count(*) FILTER (WHERE alert) AS alerts,
  count(*) FILTER (WHERE alert AND is_positive = 1) AS true_alerts FROM sc""",
)
def batch_stats(spark, sf):
    rows, files = in_files(spark, sf, encoded(spark, sf))
    sink = run_stream(spark, sf, rows, files_per_trigger=-(-files // 2))
    stats = spark.read.parquet(sink.stats)
    return stats.agg(*[F.sum(c).alias(c) for c in ("n_rows", "alerts", "true_alerts")])


@query(
    "hourly_backfill",
    f"""WITH {s.SC} SELECT id, day, hour, amount, is_positive, channel, segment, score, alert,
  CAST(dense_rank() OVER (ORDER BY hour) - 1 AS BIGINT) AS batch_id FROM sc WHERE day = 20""",
)
def hourly_backfill(spark, sf):
    """One stored day through the stream: every micro-batch is one hour, in order."""
    root = scratch_path(spark, "backfill")
    day = payload(spark, sf).filter(F.col("day") == 20)

    def send(rows):
        writers.write_messages(_arrived(messages.encode_messages(rows, "id", sent())).coalesce(1), f"{root}/feed", fmt="parquet")

    messages.hourly_backfill(day, f"{root}/staged", send)
    sink = scoring.Sink(root, "backfill")
    write = scoring.foreach_batch_sink(wire_schema(spark, sf), "id", LABEL, _fixed_score, THRESHOLD, KEEP, sink)
    scoring.start(messages.file_source(spark, f"{root}/feed", files_per_trigger=1), write, sink).awaitTermination()
    return spark.read.parquet(sink.alerts).select(*_OUT, "batch_id")


@query("keyed_dedup", f"WITH {s.SC}, sent AS (SELECT * FROM sc UNION ALL SELECT * FROM sc WHERE id % 3 = 0) SELECT DISTINCT id, day, hour, amount, is_positive, channel, segment, score, alert FROM sent")
def keyed_dedup(spark, sf):
    """A producer sends every third message again, in other batches and after a restart of the stream: each is scored once."""
    root = scratch_path(spark, "keyed-dedup")
    sink, feed = scoring.Sink(root, "dedup"), f"{root}/feed"
    rows = encoded(spark, sf)
    number = F.col("key").cast("bigint")
    deliveries = [number % 2 == 0, number % 6 == 0, number % 2 == 1, number % 6 == 3]
    for part in (deliveries[:2], deliveries[2:]):
        for chosen in part:
            _arrived(rows.filter(chosen)).coalesce(1).write.mode("append").parquet(feed)
        write = scoring.foreach_batch_sink(wire_schema(spark, sf), "id", LABEL, _fixed_score, THRESHOLD, KEEP, sink)
        single = messages.drop_repeats(messages.file_source(spark, feed, files_per_trigger=1), "1 hour")
        scoring.start(single, write, sink).awaitTermination()
    return spark.read.parquet(sink.alerts).select(*_OUT)


@query("stream_compaction", _SCORED)
def stream_compaction(spark, sf):
    """Ten batches, a compaction, five more batches, and a compaction that dies before its commit: each row is read once."""
    root = scratch_path(spark, "compaction")
    sink, feed = scoring.Sink(root, "compacted"), f"{root}/feed"
    rows = _arrived(encoded(spark, sf)).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(15)))
    rows.write.partitionBy("part").parquet(f"{root}/parts")
    staged = spark.read.parquet(f"{root}/parts")
    write = scoring.foreach_batch_sink(wire_schema(spark, sf), "id", LABEL, _fixed_score, THRESHOLD, KEEP, sink)
    for first, last in ((0, 9), (10, 14)):
        for number in range(first, last + 1):
            staged.filter(F.col("part") == number).drop("part").coalesce(1).write.mode("append").parquet(feed)
        scoring.start(messages.file_source(spark, feed, files_per_trigger=1), write, sink).awaitTermination()
        if first == 0:
            compaction.compact(spark, root)
    compaction.prepare(spark, root)
    return compaction.read(spark, root, "alerts").select(*_OUT)


@query(
    "stream_panel",
    f"""WITH {s.SC}, last AS (SELECT max(day) AS day FROM sc), spine AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
t AS (SELECT count(*) AS processed, count(*) FILTER (WHERE alert) AS alerts, count(*) FILTER (WHERE alert AND is_positive = 1) AS true_alerts, count(DISTINCT day) AS days FROM sc)
SELECT 'total' AS part, CAST(NULL AS INTEGER) AS hour, processed, alerts, true_alerts, days FROM t
UNION ALL SELECT 'hour', spine.hour, NULL, count(id), count(id) FILTER (WHERE is_positive = 1), NULL
FROM spine LEFT JOIN (SELECT * FROM sc WHERE alert AND day = (SELECT day FROM last)) a ON a.hour = spine.hour GROUP BY spine.hour""",
)
def stream_panel(spark, sf):
    sink = run_stream(spark, sf, encoded(spark, sf))
    alerts = spark.read.parquet(sink.alerts)
    return scoring.stream_panel(alerts, LABEL)


@query("stream_latest", f"WITH {s.SC} SELECT id, hour, amount, score, CASE WHEN is_positive = 1 THEN 'Sí' ELSE 'No' END AS was_positive FROM sc WHERE alert ORDER BY seconds DESC, hour DESC, id DESC LIMIT 10")
def stream_latest(spark, sf):
    """The panel's last alerts; ordered by sending time, which a rerun reproduces."""
    sink = run_stream(spark, sf, encoded(spark, sf))
    latest = ranking.latest_alerts(spark.read.parquet(sink.alerts), LABEL, "id", time="sent_ts")
    return latest.select("id", "hour", "amount", "score", "was_positive")


@query("exactly_once_append", _SCORED)
def exactly_once_append(spark, sf):
    """A batch written twice and a stream started twice leave each row once."""
    root = scratch_path(spark, "once")
    sink = scoring.Sink(root, "first")
    feed = f"{root}/feed"
    write = scoring.foreach_batch_sink(wire_schema(spark, sf), "id", LABEL, _fixed_score, THRESHOLD, KEEP, sink)

    def crash_and_retry(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    rows = _arrived(encoded(spark, sf))
    for half in (0, 1):
        rows.filter(F.col("key").cast("bigint") % 2 == half).write.mode("append").parquet(feed)
        scoring.start(messages.file_source(spark, feed), crash_and_retry, sink).awaitTermination()
    return spark.read.parquet(sink.alerts).select(*_OUT)


