"""Queries: feature engineering, models, scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.config import RiskConfig
from riskmart.operators import clean, evaluation, features, models
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.cleaning import DL_COLUMNS
from riskmart.plans.queries.registry import query
from riskmart.session import cut_lineage, scratch_path

LABEL, AMOUNT = "is_positive", "amount"
CONFIG = RiskConfig()

EVS = f"""{s.EV}, evs AS (
  SELECT id, is_positive, seconds, amount, day, hour, weekday, dataset, channel,
    nullif(split_part(lower(trim(mail_domain)), '.', 1), '') AS provider, CAST(user_id AS VARCHAR) AS "user",
    lower(trim(device_text)) AS dt, quality AS side_quality,
    CASE WHEN doc_id IS NULL THEN NULL WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS side_kind, doc_id IS NOT NULL AS has_side
  FROM ev LEFT JOIN labels ON id = doc_id)"""


# whether the number of users is within the cap on categories
_KEPT_USERS = f"""u AS (SELECT count(DISTINCT "user") <= 60 AS keep_user FROM evs WHERE dataset = 'train' AND day <= (SELECT max(day) - {b.VALIDATION_DAYS} FROM ev WHERE dataset = 'train'))"""


@query(
    "classify_columns",
    f"WITH {s.DL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS family, count({c}) AS filled FROM dl"
        for c, kind in [("lang", "categorical"), ("source", "categorical"), ("n_chars", "numeric"),
                        ("quality", "numeric"), ("toxic", "numeric"), ("has_label", "numeric")]
    ),
)
def classify_columns(spark, sf):
    docs = b.documents_frame(spark, sf)
    numeric, _ = features.classify_columns(docs, ["doc_id"])
    filled = clean.null_profile(docs, DL_COLUMNS[1:])
    family = F.when(F.col("column_name").isin(*numeric), "numeric").otherwise("categorical")
    return filled.select("column_name", family.alias("family"), (F.col("n_rows") - F.col("nulls")).alias("filled"))


@query(
    "cap_cardinality",
    f"WITH {s.LI} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) <= 60 AS kept FROM li"
        for c in b.LI_SEGMENTS
    ),
)
def cap_cardinality(spark, sf):
    return features.cardinality_report(b.lineitem_frame(spark, sf), b.LI_SEGMENTS, 60)


_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in DL_COLUMNS)


@query("null_count", f"WITH {s.DL} SELECT doc_id, {_NULLS} AS null_count FROM dl")
def null_count(spark, sf):
    return b.documents_frame(spark, sf).select("doc_id", features.null_count(DL_COLUMNS).alias("null_count"))


@query("log_amount", f"WITH {s.LF} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, amount, round(ln(1 + amount), 6) AS log_amount FROM lf")
def log_amount(spark, sf):
    return b.line_facts(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "amount",
        F.round(features.log_amount("amount"), 6).alias("log_amount"),
    )


_SPLIT = f"""CASE WHEN dataset = 'test' THEN 'test_kaggle'
  WHEN day > (SELECT max(day) - {b.VALIDATION_DAYS} FROM ev WHERE dataset = 'train') THEN 'validacion' ELSE 'entrenamiento' END"""


@query("temporal_split", f"WITH {s.EV} SELECT id, day, {_SPLIT} AS split FROM ev")
def temporal_split(spark, sf):
    return features.temporal_split(b.events_frame(spark, sf), b.VALIDATION_DAYS).select("id", "day", "split")


@query("bool_to_int", f"WITH {s.DL} SELECT doc_id, CAST(has_label AS INTEGER) AS has_label FROM dl")
def bool_to_int(spark, sf):
    return features.bool_to_int(b.documents_frame(spark, sf).select("doc_id", "has_label"))


@query("fill_sentinel", f"WITH {s.DL} SELECT doc_id, coalesce(quality, -999) AS quality, coalesce(toxic, -999) AS toxic FROM dl")
def fill_sentinel(spark, sf):
    return features.fill_sentinel(b.documents_frame(spark, sf).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query("fill_missing_level", f"""WITH {EVS} SELECT id, coalesce(provider, 'missing') AS provider, coalesce(side_kind, 'missing') AS side_kind FROM evs""")
def fill_missing_level(spark, sf):
    events = b.event_silver(spark, sf).select("id", "provider", "side_kind")
    return features.fill_missing_level(events, ["provider", "side_kind"])


def event_features(spark, sf, signal: bool = False):
    """The feature table of the events; with ``signal``, a number that leans to the positives gives the models something to find."""
    silver = b.event_silver(spark, sf)
    if signal:
        silver = silver.withColumn("lean", b.leaning_score(F.col("id"), F.col(LABEL)))
    lists = features.decide_features(silver, b.EVENT_NOT_FEATURES, 60, b.VALIDATION_DAYS)
    return features.feature_table(silver, lists, "id", LABEL, AMOUNT, b.VALIDATION_DAYS), lists


@query(
    "feature_table",
    f"""WITH {EVS}, f AS (SELECT *, {s.BRAND_OF_DT} AS brand FROM evs),
{_KEPT_USERS}
SELECT id, is_positive, amount, {_SPLIT} AS split, hour, weekday, coalesce(side_quality, -999) AS side_quality, CAST(has_side AS INTEGER) AS has_side,
  CAST(provider IS NULL AS INTEGER) + CAST(brand IS NULL AS INTEGER) + CAST(side_quality IS NULL AS INTEGER) + CAST(side_kind IS NULL AS INTEGER) AS null_count,
  round(ln(1 + amount), 6) AS log_amount, channel, coalesce(provider, 'missing') AS provider, coalesce(brand, 'missing') AS brand,
  coalesce(side_kind, 'missing') AS side_kind, (SELECT keep_user FROM u) AS user_kept FROM f""",
)
def feature_table(spark, sf):
    table, lists = event_features(spark, sf)
    # whether `user` is below the cap on categories depends on the table: the decision is a column of the result
    kept = F.lit("user" in lists.categorical)
    return table.drop("user").withColumns({"log_amount": F.round("log_amount", 6), "user_kept": kept})


@query(
    "stratified_sample",
    f"""WITH {s.LF}, k AS (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS key FROM lf)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, is_positive FROM k
WHERE is_positive = 1 OR CAST('0x' || substr(md5('42:' || key), 1, 15) AS BIGINT) < 230584300921369408""",
)
def stratified_sample(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    line = b.line_facts(spark, sf).select(*keys, LABEL)
    return features.stratified_sample(line, LABEL, F.concat_ws("-", *keys), 0.2, seed=42)


@query(
    "class_weights",
    f"""WITH {s.EV}, w AS (SELECT CAST(greatest(count(*) FILTER (WHERE is_positive = 0), 1) AS DOUBLE) / CAST(greatest(count(*) FILTER (WHERE is_positive = 1), 1) AS DOUBLE) AS w FROM ev)
SELECT id, is_positive, CASE WHEN is_positive = 1 THEN w ELSE CAST(1 AS DOUBLE) END AS weight FROM ev, w""",
)
def class_weights(spark, sf):
    return features.class_weights(b.events_frame(spark, sf).select("id", LABEL), LABEL)


# ------------------------------------------------------------------------- vector stages


@query(
    "index_categories",
    f"""WITH {s.LI}, c AS (SELECT p_brand, count(*) AS n FROM li GROUP BY p_brand)
SELECT p_brand, n, CAST(row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS DOUBLE) AS brand_index FROM c""",
)
def index_categories(spark, sf):
    lines = b.lineitem_frame(spark, sf, ["p_brand"]).select("p_brand")
    (indexer,) = models.index_categories(["p_brand"])
    indexed = indexer.fit(lines).transform(lines)
    return indexed.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.max("p_brand__index").alias("brand_index"))


_VECTOR = ["amount", "quantity", "discount"]


@query("assemble_vector", f"WITH {s.LF} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, amount AS v0, quantity AS v1, discount AS v2 FROM lf")
def assemble_vector(spark, sf):
    vectors = models.assemble_vector(_VECTOR, []).transform(b.line_facts(spark, sf))
    v = vector_to_array("features")
    return vectors.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[v[i].alias(f"v{i}") for i in range(3)])


@query(
    "scale_vector",
    f"""WITH {s.LF}, d AS (SELECT stddev_samp(amount) AS a, stddev_samp(quantity) AS q, stddev_samp(discount) AS d FROM lf)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(amount / a, 4) AS v0, round(quantity / q, 4) AS v1, round(discount / d.d, 4) AS v2 FROM lf, d""",
)
def scale_vector(spark, sf):
    vectors = models.assemble_vector(_VECTOR, []).transform(b.line_facts(spark, sf))
    v = vector_to_array("scaled")
    return models.scale_vector().fit(vectors).transform(vectors).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[F.round(v[i], 4).alias(f"v{i}") for i in range(3)]
    )


# ------------------------------------------------------------------------- models


_FITTED: dict[tuple, tuple] = {}


def fitted(spark, sf, kind: str):
    """(model, stored feature table) of ``kind``, fitted once per session and folder with the default settings."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITTED:
        table, lists = event_features(spark, sf, signal=True)
        stored = cut_lineage(table, "event-features")
        training = features.class_weights(clean.filter_partition(stored, "split", "entrenamiento"), LABEL)
        train = {"baseline": models.train_baseline, "gbt": models.train_gbt}[kind]
        model = train(training, features.model_inputs(lists, AMOUNT), list(lists.categorical), LABEL, "weight", CONFIG)
        _FITTED[key] = (model, stored)
    return _FITTED[key]


_SCORES: dict[tuple, DataFrame] = {}


def fitted_scores(spark, sf, kind: str) -> DataFrame:
    """The stored scores of the fitted model, written once, when a query first reads them."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _SCORES:
        model, stored = fitted(spark, sf, kind)
        _SCORES[key] = cut_lineage(models.with_score(model, stored).select("id", "split", LABEL, AMOUNT, "score"), f"{kind}-scores")
    return _SCORES[key]


def _in_range(score: str = "score"):
    """A probability with at most four decimals."""
    s = F.col(score)
    return (s >= 0.0) & (s <= 1.0) & (s == F.round(s, 4))


def _quality(spark, sf, kind: str):
    """Facts of the validation scores: their number, and whether they are probabilities that rank better than chance."""
    scores = fitted_scores(spark, sf, kind).filter(F.col("split") == "validacion")
    ranking = evaluation.areas(scores, "score", LABEL)
    facts = scores.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(LABEL) == 1, 1)).alias("positives"), F.min(_in_range()).alias("in_range"),
        F.count_distinct("score").alias("levels"),
    )
    rate = F.col("positives") / F.nullif(F.col("n_rows"), F.lit(0).cast("bigint"))
    better = (ranking.select("roc_auc").scalar() > 0.7) & (ranking.select("pr_auc").scalar() > rate * 1.5)
    return facts.select("n_rows", "positives", "in_range", (F.col("levels") > 10).alias("several_levels"), better.alias("beats_chance"))


_QUALITY_SQL = f"""WITH {s.VAL} SELECT count(*) AS n_rows, count(*) FILTER (WHERE is_positive = 1) AS positives, true AS in_range,
  true AS several_levels, true AS beats_chance FROM val"""


@query("train_baseline", _QUALITY_SQL)
def train_baseline(spark, sf):
    return _quality(spark, sf, "baseline")


@query("train_gbt", _QUALITY_SQL)
def train_gbt(spark, sf):
    return _quality(spark, sf, "gbt")


@query("class_probability", f"WITH {s.EV} SELECT id, true AS in_range, true AS one_minus_other FROM ev")
def class_probability(spark, sf):
    model, stored = fitted(spark, sf, "baseline")
    both = vector_to_array("probability")
    scored = model.transform(stored).select("id", models.class_probability().alias("p"), both[0].alias("q"))
    return scored.select("id", F.col("p").between(0.0, 1.0).alias("in_range"), (F.abs(F.col("p") + F.col("q") - 1) < 1e-9).alias("one_minus_other"))


_INPUTS = "hour weekday side_quality has_side null_count log_amount amount lean channel provider brand side_kind".split()


@query(
    "feature_importance",
    f"""WITH {EVS}, {_KEPT_USERS}, i AS (SELECT unnest({_INPUTS}) AS feature UNION ALL SELECT 'user' FROM u WHERE keep_user)
SELECT feature, true AS in_range, true AS sums_to_one, feature = 'lean' AS is_top FROM i""",
)
def feature_importance(spark, sf):
    model, stored = fitted(spark, sf, "gbt")
    listed = models.feature_importance(model, stored, top=1000)
    total, top = listed.agg(F.sum("importance")).scalar(), listed.agg(F.max_by("feature", "importance")).scalar()
    return listed.select(
        "feature", F.col("importance").between(0.0, 1.0).alias("in_range"), (F.abs(total - 1) < 1e-3).alias("sums_to_one"),
        (F.col("feature") == top).alias("is_top"),
    )


@query(
    "score_table",
    f"""WITH {s.EV}, f AS (SELECT id, {_SPLIT} AS split, is_positive, amount FROM ev)
SELECT *, true AS in_range, true AS alert_follows FROM f WHERE split IN ('validacion', 'test_kaggle')""",
)
def score_table(spark, sf):
    model, stored = fitted(spark, sf, "gbt")
    rows = clean.filter_partition(stored, "split", "validacion", "test_kaggle")
    table = models.score_table(model, rows, ["id", "split", LABEL, AMOUNT], 0.5)
    return table.select("id", "split", LABEL, AMOUNT, _in_range().alias("in_range"), (F.col("alert") == (F.col("score") >= 0.5)).alias("alert_follows"))


@query("alert_flag", f"WITH {s.SC} SELECT id, score, score >= CAST(8 AS DOUBLE) / 20 AS alert FROM sc")
def alert_flag(spark, sf):
    return models.flag_alerts(b.scored_events(spark, sf).select("id", "score"), 0.4)


@query("model_store", f"WITH {s.EV} SELECT count(*) AS n_rows, count(*) AS equal_scores FROM ev")
def model_store(spark, sf):
    """Scores of a saved and reloaded model next to those of the fitted one."""
    model, stored = fitted(spark, sf, "gbt")
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    before = models.with_score(model, stored, "before").select("id", "before")
    after = models.with_score(models.load_model(path), stored, "after").select("id", "after")
    same = F.count(F.when(F.col("before") == F.col("after"), 1))
    return before.join(after, "id").agg(F.count(F.lit(1)).alias("n_rows"), same.alias("equal_scores"))


