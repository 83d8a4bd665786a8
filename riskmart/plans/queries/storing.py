"""Queries: sources and sinks, each written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskmart.functions.measures import exact_sum, money, units
from riskmart.operators import clean, joins, kpis
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.kpi import LI_SEG_SQL, li_segments
from riskmart.plans.queries.registry import query
from riskmart.session import scratch_path
from riskmart.sources import buckets, catalog, readers, writers
from riskmart.streaming import messages

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _file_name(column: str = "_source_file"):
    return F.element_at(F.split(column, "/"), -1)


@query("csv_scan", f"SELECT {', '.join(ORDERS)} FROM orders")
def csv_scan(spark, sf):
    path = scratch_path(spark, "orders-csv")
    b.table(spark, sf, "orders").select(*ORDERS).write.option("header", True).csv(path)
    # inference settles on the narrowest type that fits; keys are widened back
    return readers.read_csv(spark, path).select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), *ORDERS[2:]
    )


@query("ingest_audit", "SELECT o_orderkey, o_orderstatus, 'orders.parquet' AS file_name, true AS stamped FROM orders")
def ingest_audit(spark, sf):
    loaded = readers.ingest_audit(b.table(spark, sf, "orders"))
    return loaded.select(
        "o_orderkey", "o_orderstatus", _file_name().alias("file_name"), F.col("_ingest_ts").isNotNull().alias("stamped")
    )


@query(
    "ingest_once",
    f"""SELECT o_orderstatus, count(*) AS n_rows, {s.money(f"CAST(sum({s.units('o_totalprice')}) AS BIGINT)")} AS total FROM orders GROUP BY o_orderstatus""",
)
def ingest_once(spark, sf):
    """Two deliveries, each loaded twice: every order arrives once."""
    root = scratch_path(spark, "ingest")
    source, table, manifest = f"{root}/in", f"{root}/bronze/orders", f"{root}/manifest"
    orders = b.table(spark, sf, "orders").select(*ORDERS)
    for delivery in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        orders.filter(delivery).write.mode("append").option("header", True).csv(source)
        for _ in range(2):
            readers.ingest_once(spark, source, table, manifest, ORDERS_SCHEMA, pattern="*.csv")
    loaded = readers.read_table(spark, table)
    return loaded.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), money(exact_sum(units("o_totalprice"))).alias("total")
    )


@query("ingest_quarantine", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 3 UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 = 3 AND o_orderkey % 10 = 3")
def ingest_quarantine(spark, sf):
    """Five files of which one holds a price that is none: the others are loaded at once, the mended file by a later run."""
    root = scratch_path(spark, "quarantine")
    source, table, manifest = f"{root}/in", f"{root}/bronze/orders", f"{root}/manifest"
    orders = b.table(spark, sf, "orders").select(*ORDERS).withColumn("part", F.col("o_orderkey") % 5)
    spoiled = F.when((F.col("part") == 3) & (F.col("o_orderkey") % 10 == 8), F.lit("abc")).otherwise(F.col("o_totalprice").cast("string"))
    orders.withColumn("o_totalprice", spoiled).repartition("part").write.partitionBy("part").option("header", True).csv(source)
    lease = readers.Lease("nightly")

    def load():
        return readers.ingest_once(spark, source, table, manifest, ORDERS_SCHEMA, pattern="*.csv", set_misfits_aside=True, lease=lease)

    load()
    # the file is mended by leaving out its spoiled lines
    mended = readers.set_aside(spark, manifest).select("path").first()["path"]
    spark.read.option("header", True).csv(mended).filter("o_totalprice <> 'abc'").coalesce(1).write.option("header", True).csv(f"{source}/part=mended")
    load()
    return readers.read_table(spark, table).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("catalog_overwrite", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def catalog_overwrite(spark, sf):
    """A table by name is overwritten, and a second overwrite fails midway: the first one's rows are read."""
    root, name = scratch_path(spark, "catalog"), f"customers_{uuid.uuid4().hex}"
    table = catalog.NamedTable(name, root)
    customers = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    catalog.overwrite(customers.withColumn("old", F.lit(True)), table)
    catalog.overwrite(customers.filter("c_custkey % 2 = 0"), table)
    failing = customers.repartition(4).withColumn("c_name", F.when(F.col("c_custkey") % 100 == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("c_name")))
    try:
        catalog.overwrite(failing, table)
    except Exception as e:
        if "lost" not in str(e):
            raise
    return spark.table(name)


@query(
    "ingest_load_check",
    "SELECT 'orders.parquet' AS file_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem",
)
def ingest_load_check(spark, sf):
    loaded = readers.ingest_audit(b.table(spark, sf, "orders")).select("_source_file").unionByName(
        readers.ingest_audit(b.table(spark, sf, "lineitem")).select("_source_file")
    )
    return readers.ingest_load_check(loaded)


@query("table_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def table_scan(spark, sf):
    path = f"{sf.rstrip('/')}/customer.parquet"
    if not readers.table_exists(spark, path) or readers.table_exists(spark, path + ".absent"):
        raise AssertionError("existence test is wrong")
    return readers.read_table(spark, path).select("c_custkey", "c_name", "c_mktsegment")


@query("write_partitioned", f"WITH {s.EV} SELECT dataset, count(*) AS n_rows, min(day) AS first_day, max(day) AS last_day FROM ev GROUP BY dataset")
def write_partitioned(spark, sf):
    path = scratch_path(spark, "partitioned")
    events = b.events_frame(spark, sf).select("id", "day", "dataset")
    for _ in range(2):  # a rerun replaces
        writers.write_partitioned(events, path, "dataset")
    return readers.read_table(spark, path).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


@query("write_snapshot", f"WITH {s.EV} SELECT day, {s.bundle()} FROM ev GROUP BY day")
def write_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    daily = kpis.kpis_daily(b.events_frame(spark, sf), "is_positive", "amount")
    for _ in range(2):
        writers.write_snapshot(daily, path)
    return readers.read_table(spark, path)


@query("export_csv", f"WITH {LI_SEG_SQL} SELECT * FROM seg")
def export_csv(spark, sf):
    path = scratch_path(spark, "export")
    segments = li_segments(spark, sf)
    writers.export_csv(segments, path, ["segment", F.col("rate_pct").desc(), "value"])
    return readers.read_csv(spark, path, segments.schema)


@query("run_metrics_table", f"""WITH {s.LF}, g AS (SELECT {s.bundle()}, count(DISTINCT day) AS days FROM lf)
SELECT 'run-1' AS run_id, 'kpis' AS stage, m.metric, m.value FROM g, LATERAL (VALUES ('transactions', CAST(transactions AS DOUBLE)),
  ('positives', CAST(positives AS DOUBLE)), ('rate_pct', rate_pct), ('amount_total', amount_total), ('amount_positive', amount_positive),
  ('days', CAST(days AS DOUBLE))) AS m(metric, value)""")
def run_metrics_table(spark, sf):
    path = scratch_path(spark, "metrics")
    summary = kpis.global_kpis(b.line_facts(spark, sf), "is_positive", "amount")
    writers.append_run_metrics(writers.metrics_from_row(summary, "run-1", "kpis"), path)
    writers.append_run_metrics(writers.run_metrics(spark, "run-2", "model", {"trees": 60, "kind": "boosted"}), path)
    return readers.read_table(spark, path).filter(F.col("run_id") == "run-1").drop("detail")


@query(
    "bucketed_join",
    f"""WITH {s.EV} SELECT ev.id, CASE WHEN ev.id % 3 = 0 THEN amount + 1 ELSE amount END AS amount,
  CASE WHEN doc_id % 4 = 0 THEN CAST(7 AS INTEGER) ELSE quality END AS quality, doc_id IS NOT NULL AS has_side
FROM ev LEFT JOIN labels ON ev.id = doc_id""",
)
def bucketed_join(spark, sf):
    """Two deliveries of facts and side rows, the second replacing rows of the first: newest per key and the side join, without a shuffle."""
    root = scratch_path(spark, "bucketed")
    facts, side = (buckets.Buckets(f"{root}/{name}", "id", 8) for name in ("facts", "side"))
    events = b.events_frame(spark, sf).select("id", "amount")
    labels = b.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
    for table, rows, changed in (
        (facts, events, events.filter("id % 3 = 0").withColumn("amount", F.col("amount") + 1)),
        (side, labels, labels.filter("id % 4 = 0").withColumn("quality", F.lit(7))),
    ):
        for number, delivery in enumerate((rows, changed)):
            buckets.append(delivery.withColumn("delivered", F.lit(number)), table, f"delivery-{number}")
    newest = [
        clean.dedup_by_key(buckets.read(spark, t).drop(buckets.BATCH), ["id"], [F.col("delivered").desc()]).drop("delivered") for t in (facts, side)
    ]
    return joins.left_join_presence(*newest, "id")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "table_inventory",
    "WITH t AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
        f"(SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}') AS n_columns, true AS has_bytes"
        for t in TABLES
    )
    + ") SELECT * FROM t UNION ALL SELECT 'total', CAST(sum(n_rows) AS BIGINT), CAST(sum(n_columns) AS BIGINT), true FROM t",
)
def table_inventory(spark, sf):
    """Every table; files and bytes are beyond SQL on views, so the row says whether they are plausible and pytest checks them."""
    found = readers.table_inventory(spark, {t: f"{sf.rstrip('/')}/{t}.parquet" for t in TABLES})
    plausible = (F.col("n_files") >= 1) & (F.col("n_bytes") > F.col("n_rows") / 100)
    return found.select("table_name", "n_rows", "n_columns", plausible.alias("has_bytes"))


@query("message_sink", f"WITH {s.EV} SELECT CAST(id AS VARCHAR) AS key, id, day, amount, channel FROM ev")
def message_sink(spark, sf):
    """The message writer with a folder as its target; a topic differs only in the format name."""
    path = scratch_path(spark, "topic")
    events = b.events_frame(spark, sf).select("id", "day", "amount", "channel")
    writers.write_messages(messages.encode_messages(events, "id"), path, fmt="parquet")
    value = F.from_json("value", events.schema)
    return readers.read_table(spark, path).select("key", value.alias("m")).select("key", "m.*")
