"""The given tables as canonical transaction frames.

Every frame has an id or key, relative time, ``is_positive``, ``amount`` and string dimensions;
the operators know nothing about where it came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.config import DATASET_TEST, DATASET_TRAIN
from riskmart.functions.hashing import key_hash
from riskmart.functions.text import device_brand, first_label
from riskmart.functions.timing import seconds_since
from riskmart.operators.clean import derive_time
from riskmart.operators.joins import left_join_presence

EVENT_EPOCH = "2024-01-01"
SHIP_EPOCH = "1995-01-01"
HOLDOUT_FROM_DAY = 25
VALIDATION_DAYS = 7
VALIDATION_FROM_DAY = HOLDOUT_FROM_DAY - VALIDATION_DAYS
LI_SEGMENTS = ["mktsegment", "orderpriority", "orderstatus", "linestatus", "p_type", "p_brand", "p_name"]
LI_DIMS = ["mktsegment", "orderpriority"]

# Device texts and mail domains that events are mapped to by their `props.k`.
DEVICE_TEXTS = [
    "SM-G930V", " Samsung tablet", "GT-I9300", "iOS Device", "MacOS", "iPhone 8", "Moto G", "XT1635",
    "LG-K8", "vs LG-US", "HUAWEI P9", "ALE-L23", "ANE-LX3", "Redmi Note", "xiaomi a1", "Mi A2", "Pixel 2",
    "Nexus 5", "Windows", "Trident/7.0", "Linux", "rv:57", "  ", "moto windows",
]
MAIL_DOMAINS = ["gmail.com", " Yahoo.com.mx ", "hotmail.co.uk", "", "anonymous", "mail.com", "OUTLOOK.es"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_frame(spark: SparkSession, sf_dir: str, with_customer: bool = False) -> DataFrame:
    """EV: events as transactions; ``with_customer`` adds the buyer's market segment by a join."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    base = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        seconds_since(F.col("ts"), EVENT_EPOCH).alias("seconds"),
        (F.col("event_type") == "error").cast("int").alias("is_positive"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("kind"),
        "user_id",
        k.alias("k"),
    )
    timed = derive_time(base, "seconds")
    frame = timed.select(
        "id", "seconds", "day", "hour", "weekday", "is_positive", "amount", "kind", "user_id",
        (F.col("k") % 5).cast("string").alias("channel"),
        F.element_at(F.array(*[F.lit(t) for t in DEVICE_TEXTS]), (F.col("k") % len(DEVICE_TEXTS) + 1).cast("int")).alias("device_text"),
        F.element_at(F.array(*[F.lit(t) for t in MAIL_DOMAINS]), (F.col("k") % len(MAIL_DOMAINS) + 1).cast("int")).alias("mail_domain"),
        F.when(F.col("day") >= HOLDOUT_FROM_DAY, DATASET_TEST).otherwise(DATASET_TRAIN).alias("dataset"),
    )
    if not with_customer:
        return frame
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    return frame.join(customer, "user_id", "left")


def leaning_score(key: Column, label: Column) -> Column:
    """A number from 0 to 1 with four decimals, from the key, that leans to the positives."""
    points = F.floor(F.lit(7000) * (key_hash(key) % 10_000) / F.lit(10_000.0)) + F.lit(3000) * label
    return points.cast("double") / F.lit(10_000.0)


def scored_events(spark: SparkSession, sf_dir: str, threshold: float = 0.5, with_customer: bool = False) -> DataFrame:
    """EV with a reproducible four-decimal score that leans towards the positives."""
    score = leaning_score(F.col("id"), F.col("is_positive"))
    scored = events_frame(spark, sf_dir, with_customer).withColumn("score", score)
    return scored.withColumn("alert", F.col("score") >= F.lit(float(threshold)))


ORDER_DIMS = {"mktsegment": "c_mktsegment", "orderpriority": "o_orderpriority", "orderstatus": "o_orderstatus"}
PART_DIMS = ("p_type", "p_brand", "p_name")


def lineitem_frame(spark: SparkSession, sf_dir: str, dims: Sequence[str] | None = None) -> DataFrame:
    """LI: lineitem with dimensions of its order, customer and part; only the tables of the wanted ``dims`` are joined."""
    dims = [*ORDER_DIMS, "linestatus", *PART_DIMS] if dims is None else dims
    frame = line_facts(spark, sf_dir)
    own = [c for c in frame.columns if c != "linestatus" or "linestatus" in dims]
    headed = [d for d in dims if d in ORDER_DIMS]
    if headed:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        if "mktsegment" in headed:
            # orders meet their customers first: each order is looked up once, not once per line
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
        wanted = orders.select("o_orderkey", *[F.col(ORDER_DIMS[d]).alias(d) for d in headed])
        frame = frame.join(wanted, frame.l_orderkey == wanted.o_orderkey)
    of_part = [d for d in dims if d in PART_DIMS]
    if of_part:
        part = table(spark, sf_dir, "part").select("p_partkey", *of_part)
        frame = frame.join(part, frame.l_partkey == part.p_partkey)
    return frame.select(*own, *headed, *of_part)


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LI without dimensions: lineitem alone, for operators that need no join."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_diff(F.col("l_shipdate").cast("date"), F.lit(SHIP_EPOCH).cast("date")).alias("day"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_positive"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("linestatus"),
    )


def documents_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DL: documents with their sparse labels; unlabelled documents carry nulls.

    ``doc_id`` is unique in both tables, so no key repeats on either side of the join.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return left_join_presence(docs, labels, "doc_id", "has_label")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DL with a dataset tag: documents of the first 15 sources train, the rest test (label withheld)."""
    number = F.substring("source", 4, 9).cast("int")
    tagged = documents_frame(spark, sf_dir).withColumn(
        "dataset", F.when(number < 15, DATASET_TRAIN).otherwise(DATASET_TEST)
    )
    return tagged


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EVS: cleaned events with derived categories and a sparse side table (labels by event id)."""
    events = events_frame(spark, sf_dir).select(
        "id", "is_positive", "seconds", "amount", "day", "hour", "weekday", "dataset", "channel",
        first_label(F.col("mail_domain")).alias("provider"),
        device_brand(F.col("device_text")).alias("brand"),
        F.col("user_id").cast("string").alias("user"),
    )
    side = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("side_quality"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("side_kind"),
    )
    return left_join_presence(events, side, "id", "has_side")


EVENT_NOT_FEATURES = ["id", "is_positive", "seconds", "day", "dataset"]


def raw_files(spark: SparkSession, sf_dir: str, target: str) -> None:
    """Events laid out as the raw CSV files the batch stages expect.

    The label leans on amount, channel and device, so that a model has something to find; every
    fourth event has an identity row, and the test files spell their identity columns with a dash.
    """
    events = events_frame(spark, sf_dir)
    draw = key_hash(F.col("id")) % 1000
    lean = (
        F.when(F.col("amount") > 80, 350).otherwise(10)
        + F.when(F.col("channel") == "3", 300).otherwise(0)
        + F.when(F.col("device_text").startswith("Moto"), 300).otherwise(0)
    )
    number = F.col("id") % 7
    facts = events.select(
        F.col("id").alias("TransactionID"),
        (draw < lean).cast("int").alias("isFraud"),
        F.col("seconds").alias("TransactionDT"),
        F.col("amount").alias("TransactionAmt"),
        F.col("channel").alias("ProductCD"),
        F.when(number == 0, "charge card").when(number < 4, "debit").otherwise("credit").alias("card6"),
        F.when(number > 0, number * 100).alias("card2"),
        F.when(F.col("id") % 20 == 0, number).alias("D7"),
        F.col("mail_domain").alias("P_emaildomain"),
        "dataset",
    )
    side = events.filter(F.col("id") % 4 == 0).select(
        F.col("id").alias("TransactionID"),
        F.col("weekday").alias("id_01"),
        F.when(F.col("hour") < 12, "mobile").otherwise("desktop").alias("DeviceType"),
        F.col("device_text").alias("DeviceInfo"),
        "dataset",
    )
    for name in (DATASET_TRAIN, DATASET_TEST):
        mine = facts.filter(F.col("dataset") == name).drop("dataset")
        extra = side.filter(F.col("dataset") == name).drop("dataset")
        if name == DATASET_TEST:
            mine, extra = mine.drop("isFraud"), extra.withColumnRenamed("id_01", "id-01")
        for df, kind in ((mine, "transaction"), (extra, "identity")):
            df.write.option("header", True).csv(f"{target}/{name}_{kind}.csv")
