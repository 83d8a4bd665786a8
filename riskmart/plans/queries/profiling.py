"""Queries: profiles, distributions, correlations, report facts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskmart.operators import clean, evaluation, kpis, profile
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.cleaning import DL_COLUMNS
from riskmart.plans.queries.kpi import LI_SEG_SQL, _profile_sql, li_segments
from riskmart.plans.queries.registry import query

LABEL, AMOUNT = "is_positive", "amount"
NUMERICS = ["amount", "quantity", "discount", "tax", "day"]
CORRELATED = ["quantity", "discount", "tax", "log_amount", "net_log_amount", "is_positive"]


@query(
    "describe_numeric",
    f"WITH {s.LF} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean_value, round(stddev_samp({c}), 4) AS stddev_value, "
        f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM lf"
        for c in NUMERICS
    ),
)
def describe_numeric(spark, sf):
    return profile.describe_numeric(b.line_facts(spark, sf), NUMERICS)


_GROUPED = f"""{s.LF}, g AS (SELECT 'all' AS class, amount FROM lf UNION ALL SELECT CAST(is_positive AS VARCHAR), amount FROM lf)"""


@query(
    "percentiles_by_class",
    f"""WITH {_GROUPED} SELECT class, count(*) AS n, round(CAST(sum({s.units('amount')}) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1e4, 6) AS mean_value,
  min(amount) AS min_value, max(amount) AS max_value, round(quantile_cont(amount, 0.5), 6) AS p50,
  round(quantile_cont(amount, 0.99), 6) AS p99 FROM g GROUP BY class""",
)
def percentiles_by_class(spark, sf):
    return profile.percentiles_by_class(b.line_facts(spark, sf), AMOUNT, LABEL)


@query(
    "box_stats",
    f"""WITH {s.LF}, g AS (SELECT CAST(is_positive AS VARCHAR) AS class, quantity * quantity * quantity AS v FROM lf),
b AS (SELECT class, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM g GROUP BY class),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM b)
SELECT class, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(v) FILTER (WHERE v BETWEEN lo AND hi) AS low_whisker, max(v) FILTER (WHERE v BETWEEN lo AND hi) AS high_whisker,
  count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS outliers
FROM g JOIN f USING (class) GROUP BY class, f.q1, f.median, f.q3""",
)
def box_stats(spark, sf):
    q = F.col("quantity")
    return profile.box_stats(b.line_facts(spark, sf).withColumn("cubed", q * q * q), "cubed", LABEL)


@query(
    "amount_histogram",
    f"""WITH {s.LF}, x AS (SELECT is_positive AS label, ln(1 + amount) AS x FROM lf),
e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 49 AS w FROM x),
c AS (SELECT label, CAST(least(floor((x - lo) / w), 48) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY ALL)
SELECT label, bin, n, round(CAST(n AS DOUBLE) / (CAST(sum(n) OVER (PARTITION BY label) AS DOUBLE) * w), 6) AS density FROM c, e""",
)
def amount_histogram(spark, sf):
    return profile.amount_histogram(b.line_facts(spark, sf), AMOUNT, LABEL)


@query(
    "score_histogram",
    f"""WITH {s.VAL}, c AS (SELECT is_positive AS label, CAST({s.units('score')} // 250 * 250 AS DOUBLE) / 1e4 AS bin_start, count(*) AS n
  FROM val GROUP BY ALL)
SELECT label, bin_start, n, {s.half_up('100 * n', 'CAST(sum(n) OVER (PARTITION BY label) AS BIGINT)', 4)} AS share_pct FROM c""",
)
def score_histogram(spark, sf):
    return profile.score_histogram(validation(spark, sf), "score", LABEL)


def validation(spark, sf, threshold: float = 0.5):
    """Scored events of the last labelled days."""
    scored = b.scored_events(spark, sf, threshold)
    labelled = clean.filter_partition(scored, "dataset", "train")
    cutoff = kpis.cutoff_day(clean.filter_partition(b.events_frame(spark, sf), "dataset", "train"), b.VALIDATION_DAYS)
    return labelled.filter(F.col("day") > cutoff.scalar())


def _correlation_frame(spark, sf):
    net = F.col("amount") * (F.lit(1.0) - F.col("discount"))
    return b.line_facts(spark, sf).withColumns({"log_amount": F.log1p("amount"), "net_log_amount": F.log1p(net)})


_CORR = (
    f"{s.LF}, n AS (SELECT *, ln(1 + amount) AS log_amount, ln(1 + amount * (1 - discount)) AS net_log_amount FROM lf), m AS ("
    + " UNION ALL ".join(
        f"SELECT '{x}' AS left_column, '{y}' AS right_column, round(corr({x}, {y}), 6) AS r FROM n"
        for x, y in combinations(CORRELATED, 2)
    )
    + ")"
)


@query("correlation_matrix", f"WITH {_CORR} SELECT * FROM m")
def correlation_matrix(spark, sf):
    return profile.correlation_matrix(_correlation_frame(spark, sf), CORRELATED)


@query("redundant_pairs", f"WITH {_CORR} SELECT * FROM m WHERE abs(r) > 0.9")
def redundant_pairs(spark, sf):
    return profile.redundant_pairs(correlation_matrix(spark, sf))


_NULLS = f"{s.DL}, p AS ({_profile_sql(DL_COLUMNS, 'dl')})"


@query(
    "null_buckets",
    f"""WITH {_NULLS} SELECT count(*) FILTER (WHERE null_fraction > 0.9) AS over_90, count(*) FILTER (WHERE null_fraction > 0.5) AS over_50,
  count(*) FILTER (WHERE null_fraction = 0) AS without_nulls, count(*) FILTER (WHERE null_fraction > 0) AS with_nulls,
  {s.half_up('CAST(sum(nulls) AS BIGINT) * 100', 'CAST(sum(n_rows) AS BIGINT)', 1)} AS null_cells_pct FROM p""",
)
def null_buckets(spark, sf):
    return profile.null_buckets(clean.null_profile(b.documents_frame(spark, sf), DL_COLUMNS))


@query(
    "duplicate_count",
    """SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""",
)
def duplicate_count(spark, sf):
    return profile.duplicate_count(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "time_span",
    f"""WITH {s.EV}, t AS (SELECT min(seconds) AS lo, max(seconds) AS hi, count(*) AS n FROM ev)
SELECT lo AS first_second, hi AS last_second, round(CAST(hi - lo AS DOUBLE) / 86400, 4) AS span_days,
  round(CAST(n AS DOUBLE) / (CAST(hi - lo AS DOUBLE) / 86400), 4) AS rows_per_day FROM t""",
)
def time_span(spark, sf):
    return profile.time_span(b.events_frame(spark, sf), "seconds")


_AREAS = f"{s.VAL}, {s.areas('val')}"


@query("roc_auc", f"WITH {_AREAS} SELECT roc_auc FROM roc")
def roc_auc(spark, sf):
    return evaluation.roc_auc(validation(spark, sf), "score", LABEL)


@query("pr_auc", f"WITH {_AREAS} SELECT pr_auc FROM prc")
def pr_auc(spark, sf):
    return evaluation.pr_auc(validation(spark, sf), "score", LABEL)


@query(
    "prevalence_lift",
    f"""WITH {_AREAS}, base AS (SELECT CAST(count(*) FILTER (WHERE is_positive = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate FROM val)
SELECT round(rate, 6) AS base_rate, pr_auc, round(pr_auc / rate, 4) AS lift FROM base, prc""",
)
def prevalence_lift(spark, sf):
    return evaluation.prevalence_lift(validation(spark, sf), "score", LABEL)


@query(
    "findings",
    f"""WITH {LI_SEG_SQL}, {s.DL}, p AS ({_profile_sql(DL_COLUMNS, 'dl')}),
a AS (SELECT round(quantile_cont(amount, 0.5), 6) AS p50, max(amount) AS mx FROM li),
t AS (SELECT {s.bundle()} FROM li)
SELECT 'global_rate_pct' AS fact, CAST(NULL AS VARCHAR) AS subject, rate_pct AS value FROM t
UNION ALL SELECT 'dropped_columns', NULL, CAST(count(*) FILTER (WHERE null_fraction > 0.5) AS DOUBLE) FROM p
UNION ALL SELECT 'half_null_columns', NULL, CAST(count(*) FILTER (WHERE null_fraction > 0.5) AS DOUBLE) FROM p
UNION ALL SELECT 'median_amount', NULL, p50 FROM a
UNION ALL SELECT 'max_amount', NULL, mx FROM a
UNION ALL SELECT 'max_over_median', NULL, round(mx / p50, 4) FROM a
UNION ALL (SELECT 'riskiest', segment || '=' || value, rate_pct FROM seg ORDER BY rate_pct DESC, segment DESC, value DESC LIMIT 1)
UNION ALL (SELECT 'least_risky', segment || '=' || value, rate_pct FROM seg WHERE segment = 'p_type' ORDER BY rate_pct, value LIMIT 1)""",
)
def findings(spark, sf):
    facts = b.line_facts(spark, sf)
    nulls = clean.null_profile(b.documents_frame(spark, sf), DL_COLUMNS)
    dropped = clean.sparse_columns(nulls, 0.5).count()  # one row per column at most
    return profile.findings(
        kpis.global_kpis(facts, LABEL, AMOUNT),
        profile.null_buckets(nulls),
        profile.percentiles_by_class(facts, AMOUNT, LABEL),
        li_segments(spark, sf),
        "p_type",
        dropped,
    )
