import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators import kpis
from riskmart.plans import bindings as b
from riskmart.plans.queries import streams
from riskmart.streaming import messages, scoring

LABEL, AMOUNT = "is_positive", "amount"
KEEP = ("id", "day", "hour", AMOUNT, LABEL)


@pytest.fixture
def rows(spark):
    return spark.range(200).select(
        "id", F.lit(3).alias("day"), (F.col("id") % 24).cast("int").alias("hour"), (F.col("id") / 2.0).alias(AMOUNT),
        (F.col("id") % 7 == 0).cast("int").alias(LABEL), (F.col("id") % 100 / 100.0).alias("score"),
    )


def wire(rows):
    return messages.message_schema(rows.schema)


def feed(rows, path, spoil=False):
    encoded = messages.encode_messages(rows, "id").withColumn("timestamp", F.current_timestamp())
    if spoil:
        encoded = encoded.withColumn("value", F.when(F.col("key") == "5", "{broken").otherwise(F.col("value")))
    encoded.write.mode("append").parquet(path)


def run(spark, rows, root, stream_id="s", wrap=lambda f: f):
    sink = scoring.Sink(str(root), stream_id)
    write = scoring.foreach_batch_sink(wire(rows), "id", LABEL, lambda b: b, 0.5, KEEP, sink)
    scoring.start(messages.file_source(spark, f"{root}/feed"), wrap(write), sink).awaitTermination()
    return sink


def test_schema_of_the_wire():
    features = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("split", T.StringType()), T.StructField("x", T.DoubleType())])
    schema = messages.message_schema(features)
    assert [f.simpleString() for f in schema.fields] == ["id:bigint", "x:double", "day:int", "sent_ts:timestamp"]
    assert all(f.nullable for f in schema.fields)


def test_malformed_incomplete_and_extended_messages(spark):
    schema = T.StructType.fromDDL("id bigint, x double")
    bad_texts = ["not json", '{"x": 1.0}', '{"id": 5, "x": "abc"}', '{"id": 6, "x": 1.0} more', '{"id": 7},{"id": 8}', "[]", ""]
    texts = ['{"id": 1, "x": 2.5, "more": true}', '{"id": 4}', *bad_texts, None]
    raw = spark.createDataFrame([(t,) for t in texts], "value string").withColumn("timestamp", F.current_timestamp())
    good, bad = messages.split_rejects(messages.decode_messages(raw, schema), "id")
    assert sorted((r.id, r.x) for r in good.fillna(-1.0).collect()) == [(1, 2.5), (4, -1.0)]
    assert sorted(str(r.raw) for r in bad.collect()) == sorted([*bad_texts, "None"])
    complete, _ = messages.split_rejects(messages.decode_messages(raw, schema), "id", ("x",))
    assert [r.id for r in complete.collect()] == [1]


def test_stream_equals_batch_and_rejects_are_set_aside(spark, rows, tmp_path):
    feed(rows, f"{tmp_path}/feed", spoil=True)
    sink = run(spark, rows, tmp_path)
    got = spark.read.parquet(sink.alerts)
    batch = rows.filter("id <> 5").withColumn("alert", F.col("score") >= 0.5)
    columns = [*KEEP, "score", "alert"]
    assert got.select(columns).exceptAll(batch.select(columns)).count() == 0 and got.count() == 199
    assert [r.raw for r in spark.read.parquet(sink.rejects).collect()] == ["{broken"]
    stats = spark.read.parquet(sink.stats).first()
    cards = kpis.alert_cards(batch, LABEL, AMOUNT).first()
    assert (stats.n_rows, stats.alerts, stats.true_alerts) == (cards.processed, cards.alerts, cards.true_alerts)
    assert stats.mean_latency_s > 0
    assert scoring.mean_latency(got).first().mean_latency_s == pytest.approx(stats.mean_latency_s, abs=0.011)


def test_restart_and_repeated_batches_add_nothing(spark, rows, tmp_path):
    feed(rows.filter("id < 100"), f"{tmp_path}/feed")

    def twice(write):
        def both(batch, batch_id):
            write(batch, batch_id)
            write(batch, batch_id)
        return both

    run(spark, rows, tmp_path, wrap=twice)
    run(spark, rows, tmp_path)  # nothing new
    feed(rows.filter("id >= 100"), f"{tmp_path}/feed")
    sink = run(spark, rows, tmp_path)
    got = spark.read.parquet(sink.alerts)
    assert got.count() == got.select("id").distinct().count() == 200
    # a crash between write and checkpoint repeats a batch: the failed start leaves its rows, the next replaces them
    feed(rows.withColumn("id", F.col("id") + 1000), f"{tmp_path}/feed")

    def crash_after(write):
        def then_fail(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost")
        return then_fail

    with pytest.raises(Exception, match="lost"):
        run(spark, rows, tmp_path, wrap=crash_after)
    run(spark, rows, tmp_path)
    got = spark.read.parquet(sink.alerts)
    assert got.count() == got.select("id").distinct().count() == 400


def test_a_new_stream_id_keeps_older_alerts(spark, rows, tmp_path):
    feed(rows, f"{tmp_path}/feed")
    run(spark, rows, tmp_path, "first")
    sink = run(spark, rows, tmp_path, "second")
    assert spark.read.parquet(sink.alerts).groupBy("stream_id").count().count() == 2


def test_a_batch_of_rejects_only(spark, rows, tmp_path):
    bad = spark.createDataFrame([("1", "x")], "key string, value string").withColumn("timestamp", F.current_timestamp())
    bad.write.parquet(f"{tmp_path}/feed")
    sink = run(spark, rows, tmp_path)
    assert spark.read.parquet(sink.stats).first().n_rows == 0
    assert spark.read.parquet(sink.rejects).count() == 1


def test_hourly_backfill_sends_hour_by_hour(spark, rows, tmp_path):
    seen = []
    sent = messages.hourly_backfill(rows.filter("hour <> 7"), f"{tmp_path}/staged", lambda part: seen.append(part))
    hours = [{r.hour for r in part.select("hour").distinct().collect()} for part in seen]
    assert sent == 23 and hours == [{h} for h in range(24) if h != 7]
    back = seen[0]
    for part in seen[1:]:
        back = back.union(part)
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and back.count() == rows.filter("hour <> 7").count()


# --------------------------------------------------------------------------- repeated messages


def at(spark, path, *keyed):
    """One file of messages ``(key, time)``; the id is the key."""
    data = [(k, None if k is None else f'{{"id": {k}, "day": 3, "hour": 1, "amount": 1.0, "is_positive": 0, "score": 0.5}}', t) for k, t in keyed]
    spark.createDataFrame(data, "key string, value string, timestamp string").withColumn("timestamp", F.to_timestamp("timestamp")).coalesce(1).write.mode("append").parquet(path)


def run_single(spark, rows, root, within="1 hour", wrap=lambda f: f):
    sink = scoring.Sink(str(root), "s")
    write = scoring.foreach_batch_sink(wire(rows), "id", LABEL, lambda b: b, 0.5, KEEP, sink)
    single = messages.drop_repeats(messages.file_source(spark, f"{root}/feed", 1), within)
    running = scoring.start(single, wrap(write), sink)
    running.awaitTermination()
    return sink, running


def ids(spark, sink):
    return sorted(r.id for r in spark.read.parquet(sink.alerts).collect())


def test_repeats_are_dropped_in_and_across_batches_and_restarts(spark, rows, tmp_path):
    at(spark, f"{tmp_path}/feed", ("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:00:01"), ("1", "2024-01-01 00:00:02"))
    at(spark, f"{tmp_path}/feed", ("2", "2024-01-01 00:10:00"), ("3", "2024-01-01 00:10:00"))
    sink, _ = run_single(spark, rows, tmp_path)
    assert ids(spark, sink) == [1, 2, 3]
    at(spark, f"{tmp_path}/feed", ("1", "2024-01-01 00:20:00"), ("3", "2024-01-01 00:20:00"), ("4", "2024-01-01 00:20:00"))
    sink, running = run_single(spark, rows, tmp_path)
    assert ids(spark, sink) == [1, 2, 3, 4]
    assert scoring.state_figures(running) == {"in_state": 4, "late": 0}


def test_state_older_than_the_watermark_is_forgotten(spark, rows, tmp_path):
    at(spark, f"{tmp_path}/feed", ("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:00:00"))
    run_single(spark, rows, tmp_path)
    at(spark, f"{tmp_path}/feed", ("3", "2024-01-01 05:00:00"))
    sink, running = run_single(spark, rows, tmp_path)
    assert scoring.state_figures(running)["in_state"] == 1
    # a repeat after five hours is a message like any other; one that comes hours late is dropped and counted
    at(spark, f"{tmp_path}/feed", ("1", "2024-01-01 05:00:01"), ("9", "2024-01-01 01:00:00"))
    sink, running = run_single(spark, rows, tmp_path)
    assert ids(spark, sink) == [1, 1, 2, 3]
    assert scoring.state_figures(running)["late"] == 1


def test_messages_without_a_key_are_known_by_their_text(spark, rows, tmp_path):
    data = [(None, "broken"), (None, "broken"), (None, "other"), (None, None)]
    df = spark.createDataFrame(data, "key string, value string").withColumn("timestamp", F.current_timestamp())
    df.coalesce(1).write.parquet(f"{tmp_path}/feed")
    sink, _ = run_single(spark, rows, tmp_path)
    assert sorted(str(r.raw) for r in spark.read.parquet(sink.rejects).collect()) == ["None", "broken", "other"]


def test_a_crash_neither_loses_nor_repeats_with_state(spark, rows, tmp_path):
    at(spark, f"{tmp_path}/feed", ("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:00:00"))

    def crash(when):
        def wrapped(write):
            def failing(batch, batch_id):
                if when == "after":
                    write(batch, batch_id)
                raise RuntimeError("lost")
            return failing
        return wrapped

    for when in ("before", "after", "after"):
        with pytest.raises(Exception, match="lost"):
            run_single(spark, rows, tmp_path, wrap=crash(when))
    at(spark, f"{tmp_path}/feed", ("2", "2024-01-01 00:01:00"), ("3", "2024-01-01 00:01:00"))
    sink, _ = run_single(spark, rows, tmp_path)
    assert ids(spark, sink) == [1, 2, 3]


def test_the_timed_trigger_runs_batch_after_batch(spark, rows, tmp_path):
    feed(rows.filter("id < 100"), f"{tmp_path}/feed")
    sink = scoring.Sink(str(tmp_path), "timed")
    write = scoring.foreach_batch_sink(wire(rows), "id", LABEL, lambda b: b, 0.5, KEEP, sink)
    running = scoring.start(messages.file_source(spark, f"{tmp_path}/feed"), write, sink, every="200 milliseconds")
    try:
        running.processAllAvailable()
        feed(rows.filter("id >= 100"), f"{tmp_path}/feed")
        running.processAllAvailable()
    finally:
        running.stop()
    got = spark.read.parquet(sink.alerts)
    assert got.count() == 200 and got.select("batch_id").distinct().count() == 2


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_source(spark, "localhost:1", "topic")


def test_files_of_a_feed_grow_in_number_not_in_size(spark, sf, monkeypatch):
    n = b.table(spark, sf, "events").count()
    rows = streams.encoded(spark, sf)
    assert streams.in_files(spark, sf, rows)[1] == 4
    monkeypatch.setattr(streams, "FILE_MESSAGES", n // 20)
    dealt, files = streams.in_files(spark, sf, rows)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert files >= 20 and sum(sizes) == n and max(sizes) < 2 * n / 20 + 20
    assert streams.batch_stats(spark, sf).first()["n_rows"] == n


def test_micro_batches_of_many_files(spark, sf, monkeypatch):
    n, sent = b.table(spark, sf, "events").count(), []
    monkeypatch.setattr(streams, "FILE_MESSAGES", n // 20)
    run_stream = streams.run_stream

    def noted(spark, sf, rows, files_per_trigger):
        sent.append((rows.rdd.getNumPartitions(), files_per_trigger))
        return run_stream(spark, sf, rows, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(streams, "run_stream", noted)
    assert streams.micro_batch_trigger(spark, sf).collect() == [(n, n, True)]
    ((files, a_batch),) = sent
    assert files >= 20 and a_batch < files <= 2 * a_batch
