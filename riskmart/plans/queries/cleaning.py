"""Queries: cleaning, projections, filters, joins, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.functions import text
from riskmart.operators import clean, joins, kpis, ranking
from riskmart.operators.features import temporal_split
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.registry import query
from riskmart.session import scratch_path
from riskmart.sources import readers, writers

CUBE_DIMS = ["channel", "segment"]
SLICE = {"channel": ["1", "3"], "segment": []}
SLICE_DAYS = (5, 20)


@query("normalize_names", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def normalize_names(spark, sf):
    raw = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("c-custkey"), F.col("c_name").alias("c-name"), "c_mktsegment"
    )
    return clean.normalize_names(raw)


@query("drop_audit", "SELECT p_partkey, p_name, p_brand FROM part")
def drop_audit(spark, sf):
    return clean.drop_audit(readers.ingest_audit(b.table(spark, sf, "part"))).select("p_partkey", "p_name", "p_brand")


@query(
    "dedup_by_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedup_by_key(spark, sf):
    line = b.table(spark, sf, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    kept = clean.dedup_by_key(line, ["l_orderkey", "l_linenumber"], order)
    return kept.withColumn("ship_day", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query("trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_strings(spark, sf):
    padded = b.table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("c_name"),
        F.concat(F.col("c_mktsegment"), F.lit("   ")).alias("c_mktsegment"),
    )
    return clean.trim_strings(padded)


@query(
    "email_provider",
    f"""WITH {s.EV} SELECT id, nullif(split_part(lower(trim(mail_domain)), '.', 1), '') AS provider FROM ev""",
)
def email_provider(spark, sf):
    return clean.email_provider(b.events_frame(spark, sf), "mail_domain", "provider").select("id", "provider")


@query(
    "host_label",
    r"""SELECT page_id, nullif(split_part(lower(trim(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))), '.', 1), '') AS label
FROM pages""",
)
def host_label(spark, sf):
    pages = b.table(spark, sf, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))
    return clean.email_provider(pages, "host", "label").select("page_id", "label")


@query("device_brand", f"WITH {s.EV}, d AS (SELECT id, lower(trim(device_text)) AS dt FROM ev) SELECT id, {s.BRAND_OF_DT} AS brand FROM d")
def device_brand(spark, sf):
    return clean.device_brand(b.events_frame(spark, sf), "device_text", "brand").select("id", "brand")


# Finish of a part by words of its name, first match wins.
FINISH_RULES = (("coloured", ("red", "blue"), ("green",)), ("sized", ("small", "large"), ()), ("hardware", (), ("bolt", "ring", "gear")))


@query(
    "rule_bucket",
    """SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') OR starts_with(p_name, 'blue') OR contains(p_name, 'green') THEN 'coloured'
  WHEN starts_with(p_name, 'small') OR starts_with(p_name, 'large') THEN 'sized'
  WHEN contains(p_name, 'bolt') OR contains(p_name, 'ring') OR contains(p_name, 'gear') THEN 'hardware'
  ELSE 'plain' END AS finish FROM part""",
)
def rule_bucket(spark, sf):
    return b.table(spark, sf, "part").select(
        "p_partkey", text.rule_bucket(F.col("p_name"), FINISH_RULES, "plain").alias("finish")
    )


@query(
    "collapse_rare",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'other' END AS o_orderpriority
FROM orders""",
)
def collapse_rare(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return clean.collapse_rare(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


def _profile_sql(columns: list[str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_fraction FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


DL_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", "has_label"]


@query("null_profile", f"WITH {s.DL} {_profile_sql(DL_COLUMNS, 'dl')}")
def null_profile(spark, sf):
    return clean.null_profile(b.documents_frame(spark, sf), DL_COLUMNS)


@query(
    "drop_sparse_columns",
    f"""WITH {s.DL} SELECT doc_id, lang, quality, toxic, dataset, CAST(CASE WHEN toxic = 5 THEN 1 END AS INTEGER) AS kept_empty FROM dl""",
)
def drop_sparse_columns(spark, sf):
    wide = b.labelled_documents(spark, sf).select(
        "doc_id", "lang", "quality", "toxic", "dataset",
        F.when(F.col("toxic") == 1, 1).alias("toxic_only"),
        F.when(F.col("quality") == 0, 1).alias("poor_only"),
        F.when(F.col("toxic") == 5, 1).alias("kept_empty"),
    )
    training = clean.filter_partition(wide, "dataset", "train")
    return clean.drop_sparse_columns(wide, training, 0.90, protected=["doc_id", "kept_empty"])[0]


@query("derive_time", f"WITH {s.EV} SELECT id, seconds, day, hour, weekday FROM ev")
def derive_time(spark, sf):
    return b.events_frame(spark, sf).select("id", "seconds", "day", "hour", "weekday")


@query(
    "label_missing",
    f"""WITH {s.DL} SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), '(sin dato)') AS quality,
  coalesce(CAST(toxic AS VARCHAR), '(sin dato)') AS toxic FROM dl""",
)
def label_missing(spark, sf):
    return clean.label_missing(
        b.documents_frame(spark, sf).select("doc_id", "lang", "quality", "toxic"), ["quality", "toxic", "absent"]
    )


@query("filter_partition", f"WITH {s.EV} SELECT id, day, amount FROM ev WHERE dataset = 'train'")
def filter_partition(spark, sf):
    path = scratch_path(spark, "events-by-dataset")
    writers.write_partitioned(b.events_frame(spark, sf).select("id", "day", "amount", "dataset"), path, "dataset")
    return clean.filter_partition(readers.read_table(spark, path), "dataset", "train").select("id", "day", "amount")


def event_cube(spark, sf):
    return kpis.daily_cube(b.events_frame(spark, sf, with_customer=True), CUBE_DIMS, "is_positive", "amount")


@query(
    "slice_filter",
    f"""WITH {s.EVC}, cube AS ({s.cube('evc', CUBE_DIMS)}) SELECT * FROM cube WHERE day BETWEEN 5 AND 20 AND channel IN ('1', '3')""",
)
def slice_filter(spark, sf):
    return clean.slice_filter(event_cube(spark, sf), SLICE_DAYS, SLICE)


@query(
    "min_support",
    f"""WITH {s.LI} SELECT p_brand, p_type, orderpriority, {s.bundle()} FROM li
GROUP BY p_brand, p_type, orderpriority HAVING count(*) >= 100""",
)
def min_support(spark, sf):
    grouped = kpis.metric_bundle(
        b.lineitem_frame(spark, sf, ["p_brand", "p_type", "orderpriority"]), ["p_brand", "p_type", "orderpriority"], "is_positive", "amount"
    )
    return clean.min_support(grouped, "transactions", 100)


@query("project_business", f"WITH {s.LI} SELECT l_orderkey, l_linenumber, amount, p_brand, mktsegment FROM li")
def project_business(spark, sf):
    return clean.project_business(
        b.lineitem_frame(spark, sf), ["l_orderkey", "l_linenumber", "amount"], ["p_brand", "device_brand", "mktsegment"]
    )


# ------------------------------------------------------------------------- joins and unions


@query("left_join_presence", f"WITH {s.DL} SELECT doc_id, lang, source, n_chars, quality, toxic, has_label FROM dl")
def left_join_presence(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = b.table(spark, sf, "labels")
    once = clean.dedup_by_key(docs, ["doc_id"]), clean.dedup_by_key(labels, ["doc_id"])
    return joins.left_join_presence(*once, "doc_id", "has_label")


@query(
    "semi_join_sample",
    """SELECT doc_id, quality, toxic FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents
  WHERE CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) < 345876451382054080)""",
)
def semi_join_sample(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "lang")
    return joins.semi_join_sample(docs, b.table(spark, sf, "labels"), "doc_id", 0.3, seed=42)[1].select(
        "doc_id", "quality", "toxic"
    )


@query("replay_day", f"WITH {s.EV} SELECT id, amount, channel, day, hour, seconds, row_number() OVER (ORDER BY seconds, id) AS position FROM ev WHERE day = 20")
def replay_day(spark, sf):
    events = b.events_frame(spark, sf)
    features = events.select("id", "amount", "channel")
    return ranking.with_position(joins.replay_day(features, events.select("id", "day", "hour", "seconds"), "id", 20, "seconds"))


@query("enrich_scores", f"WITH {s.SC} SELECT id, score, alert, day, hour, channel, segment FROM sc")
def enrich_scores(spark, sf):
    scores = b.scored_events(spark, sf).select("id", "score", "alert")
    facts = b.events_frame(spark, sf, with_customer=True)
    return joins.enrich_scores(scores, facts, "id", ["day", "hour", "channel", "segment", "device_brand"])


@query(
    "side_coverage",
    f"""WITH c AS (
  SELECT 'documents' AS facts, count(*) AS n_rows, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS covered FROM documents
  UNION ALL
  SELECT 'orders', count(*), count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM orders)
SELECT facts, n_rows, covered, {s.half_up('100 * covered', 'n_rows', 1)} AS covered_pct FROM c""",
)
def side_coverage(spark, sf):
    docs = joins.side_coverage(b.table(spark, sf, "documents"), b.table(spark, sf, "labels"), "doc_id")
    orders = joins.side_coverage(
        b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k")),
        b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")),
        "k",
    )
    return docs.withColumn("facts", F.lit("documents")).unionByName(orders.withColumn("facts", F.lit("orders")))


@query("union_missing", f"WITH {s.DL} SELECT doc_id, lang, n_chars, quality, toxic FROM dl")
def union_missing(spark, sf):
    docs = b.documents_frame(spark, sf)
    labelled = docs.filter("has_label").select("doc_id", "lang", "n_chars", "quality", "toxic")
    return joins.union_missing(labelled, docs.filter("NOT has_label").select("lang", "doc_id", "n_chars"))


@query(
    "union_scored",
    f"""WITH {s.SC} SELECT id, score, CASE WHEN dataset = 'test' THEN 'test_kaggle' ELSE 'validacion' END AS split
FROM sc WHERE dataset = 'test' OR day > {b.VALIDATION_FROM_DAY - 1}""",
)
def union_scored(spark, sf):
    scored = temporal_split(b.scored_events(spark, sf), b.VALIDATION_DAYS)
    return joins.union_scored(scored, ["validacion", "test_kaggle"]).select("id", "score", "split")
