"""Compaction of the stream's tables: each row once at every moment."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskmart.plans import jobs
from riskmart.sources import commits
from riskmart.streaming import compaction, messages, scoring

KEEP = ("id", "day", "hour", "is_positive")


@pytest.fixture
def rows(spark):
    return spark.range(300).select(
        "id", (F.col("id") % 3).cast("int").alias("day"), F.lit(1).alias("hour"), F.lit(0).alias("is_positive"), F.lit(0.5).alias("score")
    )


class Stream:
    def __init__(self, spark, rows, root, name="007"):
        self.spark, self.rows, self.root, self.sink = spark, rows, str(root), scoring.Sink(str(root), name)
        self.feed = f"{root}/feed-{name}"

    def send(self, *spans):
        """A file, and so a batch, per span of ids; every tenth message is broken."""
        for first, last in spans:
            part = messages.encode_messages(self.rows.filter(F.col("id").between(first, last)), "id").withColumn("timestamp", F.current_timestamp())
            broken = F.when(F.col("key").cast("int") % 10 == 9, "broken").otherwise(F.col("value"))
            part.withColumn("value", broken).coalesce(1).write.mode("append").parquet(self.feed)

    def run(self, wrap=lambda f: f):
        write = scoring.foreach_batch_sink(messages.message_schema(self.rows.schema), "id", "is_positive", lambda b: b, 0.5, KEEP, self.sink)
        scoring.start(messages.file_source(self.spark, self.feed, 1), wrap(write), self.sink).awaitTermination()


def ids(spark, root):
    return sorted(r.id for r in compaction.read(spark, str(root), "alerts").collect())


def good(last):
    return [i for i in range(last + 1) if i % 10 != 9]


def files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_every_moment_shows_each_row_once(spark, rows, tmp_path):
    stream = Stream(spark, rows, tmp_path)
    stream.send((0, 59), (60, 99), (100, 149))
    stream.run()
    assert ids(spark, tmp_path) == good(149)
    prepared = compaction.prepare(spark, str(tmp_path))
    assert ids(spark, tmp_path) == good(149)  # written, not committed
    before = compaction.snapshot(spark, str(tmp_path))
    assert compaction.commit(spark, str(tmp_path), prepared)
    assert ids(spark, tmp_path) == good(149)
    # a reader that began before the commit still finds its files
    assert compaction.read(spark, str(tmp_path), "alerts", before).count() == len(good(149))
    stream.send((150, 199))
    stream.run()
    assert ids(spark, tmp_path) == good(199)
    assert compaction.compact(spark, str(tmp_path)) and not compaction.compact(spark, str(tmp_path))
    assert ids(spark, tmp_path) == good(199)
    assert compaction.read(spark, str(tmp_path), "rejects").count() == 20
    stats = compaction.read(spark, str(tmp_path), "stats")
    assert stats.count() == 4 and stats.agg(F.sum("n_rows")).first()[0] == len(good(199))
    assert {r.stream_id for r in stats.collect()} == {"007"}


def test_one_folder_and_few_files_per_day_after_vacuum(spark, rows, tmp_path):
    stream = Stream(spark, rows, tmp_path)
    stream.send(*[(k, k + 29) for k in range(0, 150, 30)])
    stream.run()
    compaction.compact(spark, str(tmp_path))
    stream.send(*[(k, k + 29) for k in range(150, 300, 30)])
    stream.run()
    compaction.compact(spark, str(tmp_path))
    assert len(files(f"{tmp_path}/alerts")) >= 10
    assert compaction.vacuum(spark, str(tmp_path)) == 0  # a day's grace
    assert compaction.vacuum(spark, str(tmp_path), grace_s=-5) > 0
    assert ids(spark, tmp_path) == good(299)
    assert not files(f"{tmp_path}/alerts") and not files(f"{tmp_path}/stats")
    per_day = {p.parent.name for p in files(f"{tmp_path}/compacted/alerts")}
    assert per_day == {"slot=0", "slot=1", "slot=2"} and len(files(f"{tmp_path}/compacted/alerts")) <= 6


def test_a_crash_before_the_commit_changes_nothing(spark, rows, tmp_path):
    stream = Stream(spark, rows, tmp_path)
    stream.send((0, 99))
    stream.run()
    lost = compaction.prepare(spark, str(tmp_path))
    assert ids(spark, tmp_path) == good(99)
    assert compaction.compact(spark, str(tmp_path))
    assert ids(spark, tmp_path) == good(99)
    assert not compaction.commit(spark, str(tmp_path), lost)  # too late: the log has moved on
    compaction.vacuum(spark, str(tmp_path), grace_s=-5)
    assert ids(spark, tmp_path) == good(99)
    assert not list(Path(tmp_path).glob(f"compacted/*/part={lost.part}"))


def test_of_two_compactions_one_wins(spark, rows, tmp_path):
    stream = Stream(spark, rows, tmp_path)
    stream.send((0, 49), (50, 99))
    stream.run()
    a, b = compaction.prepare(spark, str(tmp_path)), compaction.prepare(spark, str(tmp_path))
    assert [compaction.commit(spark, str(tmp_path), p) for p in (a, b)] == [True, False]
    assert ids(spark, tmp_path) == good(99)


def test_a_batch_repeated_after_its_compaction_is_not_read_again(spark, rows, tmp_path):
    stream = Stream(spark, rows, tmp_path)
    stream.send((0, 99))

    def compact_then_crash(write):
        def both(batch, batch_id):
            write(batch, batch_id)
            if batch_id == 0:
                compaction.compact(spark, str(tmp_path))
                raise RuntimeError("lost")
        return both

    with pytest.raises(Exception, match="lost"):
        stream.run(compact_then_crash)
    compaction.vacuum(spark, str(tmp_path), grace_s=-5)
    stream.run()  # repeats batch 0, whose folders are gone
    assert files(f"{tmp_path}/alerts") and ids(spark, tmp_path) == good(99)
    assert not compaction.compact(spark, str(tmp_path))


def test_two_streams_and_rows_without_a_day(spark, rows, tmp_path):
    first, second = Stream(spark, rows, tmp_path, "1"), Stream(spark, rows.withColumn("day", F.when(F.col("id") > 100, F.col("day"))), tmp_path, "01")
    for stream in (first, second):
        stream.send((0, 99) if stream is first else (100, 199))
        stream.run()
    assert compaction.compact(spark, str(tmp_path))
    assert ids(spark, tmp_path) == good(199)
    assert {r.stream_id for r in compaction.read(spark, str(tmp_path), "alerts").select("stream_id").distinct().collect()} == {"1", "01"}
    assert compaction.read(spark, str(tmp_path), "alerts").filter("day IS NULL").count() == 1


def test_nothing_to_read_or_compact(spark, tmp_path):
    assert not compaction.compact(spark, str(tmp_path)) and compaction.vacuum(spark, str(tmp_path)) == 0
    with pytest.raises(ValueError):
        compaction.read(spark, str(tmp_path), "alerts")


def test_log_entries_are_whole_and_exclusive(spark, tmp_path):
    log = commits.CommitLog(f"{tmp_path}/log")
    assert log.read(spark) == []
    assert log.append(spark, 0, "a\nb") and not log.append(spark, 0, "c") and log.append(spark, 1, "d")
    assert [(e.version, e.text) for e in log.read(spark)] == [(1, "a\nb"), (2, "d")]
    assert not [p for p in Path(f"{tmp_path}/log").iterdir() if "-" in p.name and not p.name.endswith(".crc")]


def test_command_line():
    args = jobs.arguments(["compact", "--root", "r", "--grace-hours", "2"])
    assert (args.job, args.grace_hours) == ("compact", 2.0)
