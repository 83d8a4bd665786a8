"""Bucketed tables: deliveries, refusals, plans without a shuffle, the same silver table as without buckets."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskmart.config import Layout, RiskConfig
from riskmart.plans import bindings as b
from riskmart.plans import stages
from riskmart.plans.queries import QUERIES
from riskmart.sources import buckets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(tmp_path):
    return buckets.Buckets(f"{tmp_path}/{uuid.uuid4().hex}", "k", 4)


def delivery(spark, first, last, value="x"):
    return spark.range(first, last).select(F.col("id").alias("k"), F.lit(value).alias("v-1"))


def parts(table, batch):
    return {p: p.stat().st_mtime_ns for p in Path(table.path).glob(f"_batch={batch}/*.parquet")}


def test_a_delivery_leaves_older_buckets_alone_and_replaces_itself(spark, table):
    buckets.append(delivery(spark, 0, 100), table, "a")
    before = parts(table, "a")
    assert len(before) == 4
    buckets.append(delivery(spark, 50, 150, "y"), table, "b")
    buckets.append(delivery(spark, 50, 120, "z"), table, "b")
    assert parts(table, "a") == before
    rows = buckets.read(spark, table)
    assert rows.columns == ["k", "v-1", "_batch"] and rows.count() == 170 and rows.filter("`v-1` = 'y'").isEmpty()


def test_another_session_finds_the_table_by_its_files(spark, table):
    buckets.append(delivery(spark, 0, 100), table, "it's")
    spark.sql(f"DROP TABLE {table.name}")
    assert buckets.exists(spark, table) and buckets.read(spark, table).count() == 100
    assert "Bucketed: true" in plan(buckets.read(spark, table).groupBy("k").count())


def test_other_buckets_and_other_columns_are_refused(spark, table):
    with pytest.raises(ValueError, match="no bucketed table"):
        buckets.read(spark, table)
    buckets.append(delivery(spark, 0, 10), table, "a")
    with pytest.raises(ValueError, match="has 4 buckets by k"):
        buckets.append(delivery(spark, 0, 10), buckets.Buckets(table.path, "k", 8), "b")
    with pytest.raises(ValueError, match="adds"):
        buckets.append(delivery(spark, 0, 10).withColumn("w", F.lit(1)), table, "b")
    assert buckets.read(spark, table).count() == 10


def test_dedup_and_join_need_no_exchange(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["bucketed_join"](spark, sf)
        text = plan(df)
        assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2
        assert df.count() == b.table(spark, sf, "events").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_is_the_same_with_and_without_buckets(spark, sf, tmp_path):
    b.raw_files(spark, sf, f"{tmp_path}/raw")
    plain, dealt = Layout(f"{tmp_path}/plain"), Layout(f"{tmp_path}/dealt", buckets=4)
    for layout in (plain, dealt):
        stages.run_stages(spark, layout, RiskConfig(), f"{tmp_path}/raw", ["bronze", "silver"])
    again = stages.bronze(spark, dealt, RiskConfig(), f"{tmp_path}/raw")
    assert set(again.values()) == {0}
    a, z = (spark.read.parquet(layout.silver("transactions")) for layout in (plain, dealt))
    assert a.columns == z.columns and a.exceptAll(z).isEmpty() and a.count() == z.count() > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(stages.joined_rows(spark, plain, RiskConfig(), "train")).count("Exchange") == 2
        assert "Exchange" not in plan(stages.joined_rows(spark, dealt, RiskConfig(), "train"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_layout_with_buckets_is_parquet():
    with pytest.raises(ValueError):
        Layout("r", "delta", 8)
    with pytest.raises(ValueError):
        Layout("r", "parquet", 0)
