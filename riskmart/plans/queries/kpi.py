"""Queries: KPIs, slices, alerts, moving windows, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.config import DATASET_TRAIN
from riskmart.operators import clean, kpis, ranking
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.cleaning import CUBE_DIMS, DL_COLUMNS, SLICE, SLICE_DAYS, event_cube
from riskmart.plans.queries.registry import query

LABEL, AMOUNT = "is_positive", "amount"
EV_SEGMENTS = ["channel", "segment", "kind", "hour", "weekday"]
MONITOR_DAY = 20

CUBE_SQL = f"{s.EVC}, cube AS ({s.cube('evc', CUBE_DIMS)}), chosen AS (SELECT * FROM cube WHERE day BETWEEN 5 AND 20 AND channel IN ('1', '3'))"


def li_segments(spark, sf, at_least=100):
    return kpis.segment_risk(b.lineitem_frame(spark, sf), b.LI_SEGMENTS, LABEL, AMOUNT, at_least)


def ev_segments(spark, sf):
    return kpis.segment_risk(b.events_frame(spark, sf, with_customer=True), EV_SEGMENTS, LABEL, AMOUNT)


LI_SEG_SQL = f"{s.LI}, seg AS ({s.segments('li', b.LI_SEGMENTS, 100)})"


@query("segment_risk", f"WITH {LI_SEG_SQL} SELECT * FROM seg")
def segment_risk(spark, sf):
    return li_segments(spark, sf)


@query("metric_bundle", f"WITH {s.LI} SELECT p_brand, {s.bundle()} FROM li GROUP BY p_brand")
def metric_bundle(spark, sf):
    return kpis.metric_bundle(b.lineitem_frame(spark, sf, ["p_brand"]), ["p_brand"], LABEL, AMOUNT)


@query("kpis_daily", f"WITH {s.EV} SELECT day, {s.bundle()} FROM ev GROUP BY day")
def kpis_daily(spark, sf):
    return kpis.kpis_daily(b.events_frame(spark, sf), LABEL, AMOUNT)


@query("daily_cube", f"WITH {s.LI} {s.cube('li', b.LI_DIMS)}")
def daily_cube(spark, sf):
    return kpis.daily_cube(b.lineitem_frame(spark, sf, b.LI_DIMS), b.LI_DIMS, LABEL, AMOUNT)


@query("global_kpis", f"WITH {s.LF} SELECT {s.bundle()}, count(DISTINCT day) AS days FROM lf")
def global_kpis(spark, sf):
    return kpis.global_kpis(b.line_facts(spark, sf), LABEL, AMOUNT)


@query(
    "riskiest_value",
    f"""WITH {LI_SEG_SQL} SELECT segment, value AS riskiest, rate_pct FROM seg
QUALIFY row_number() OVER (PARTITION BY segment ORDER BY rate_pct DESC, value DESC) = 1""",
)
def riskiest_value(spark, sf):
    return kpis.riskiest_value(li_segments(spark, sf))


@query(
    "dataset_summary",
    f"""WITH {s.DL} SELECT dataset, count(*) AS n_rows, count(*) FILTER (WHERE toxic = 1) AS positives,
  {s.half_up('100 * count(*) FILTER (WHERE toxic = 1)', 'count(*)', 2)} AS rate_pct,
  {s.half_up('100 * count(*) FILTER (WHERE has_label)', 'count(*)', 1)} AS coverage_pct FROM dl GROUP BY dataset""",
)
def dataset_summary(spark, sf):
    return kpis.dataset_summary(b.labelled_documents(spark, sf), "toxic", "has_label")


def _distinct_sql(columns, source):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM {source}" for c in columns)


@query("distinct_profile", f"WITH {s.LI} {_distinct_sql(b.LI_SEGMENTS, 'li')}")
def distinct_profile(spark, sf):
    return kpis.distinct_profile(b.lineitem_frame(spark, sf), b.LI_SEGMENTS)


@query("cutoff_day", f"WITH {s.EV} SELECT max(day) - 7 AS cutoff_day FROM ev WHERE dataset = 'train'")
def cutoff_day(spark, sf):
    return kpis.cutoff_day(clean.filter_partition(b.events_frame(spark, sf), "dataset", DATASET_TRAIN), b.VALIDATION_DAYS)


@query(
    "class_balance",
    f"""WITH {s.LF}, c AS (SELECT is_positive AS label, count(*) AS n_rows FROM lf GROUP BY 1)
SELECT label, n_rows, {s.half_up('100 * n_rows', 'CAST(sum(n_rows) OVER () AS BIGINT)', 4)} AS share_pct FROM c""",
)
def class_balance(spark, sf):
    return kpis.class_balance(b.line_facts(spark, sf), LABEL)


# ------------------------------------------------------------------------- slices


@query(
    "reaggregate_slice",
    f"""WITH {CUBE_SQL}, d AS ({s.daily('chosen')})
SELECT day, transactions, positives, {s.half_up('100 * positives', 'transactions', 3)} AS rate_pct,
  {s.money('au')} AS amount_total, {s.money('pu')} AS amount_positive FROM d""",
)
def reaggregate_slice(spark, sf):
    return kpis.reaggregate_slice(clean.slice_filter(event_cube(spark, sf), SLICE_DAYS, SLICE))


_TOTALS = f"""SELECT CAST(sum(transactions) AS BIGINT) AS n, CAST(sum(positives) AS BIGINT) AS p,
  CAST(sum({s.units('amount_total')}) AS BIGINT) AS au, CAST(sum({s.units('amount_positive')}) AS BIGINT) AS pu"""


@query(
    "headline",
    f"""WITH {CUBE_SQL}, g AS ({_TOTALS} FROM cube), t AS ({_TOTALS} FROM chosen)
SELECT t.n AS transactions, t.p AS positives, round({s.pct('t.p', 't.n')}, 4) AS rate_pct,
  round({s.pct('t.p', 't.n')} - {s.pct('g.p', 'g.n')}, 4) AS delta_pp, {s.money('t.au')} AS amount_total,
  {s.money('t.pu')} AS amount_positive, round({s.pct('t.pu', 't.au')}, 4) AS amount_share_pct FROM t, g""",
)
def headline(spark, sf):
    cube = event_cube(spark, sf)
    return kpis.headline(cube, clean.slice_filter(cube, SLICE_DAYS, SLICE))


_LIFT_SQL = f"""{CUBE_SQL}, t AS ({_TOTALS} FROM chosen),
v AS (SELECT segment AS value, CAST(sum(transactions) AS BIGINT) AS transactions, CAST(sum(positives) AS BIGINT) AS positives,
  CAST(sum({s.units('amount_positive')}) AS BIGINT) AS pu FROM chosen GROUP BY segment HAVING sum(transactions) >= 100)
SELECT value, transactions, positives, round({s.pct('positives', 'transactions')}, 4) AS rate_pct, {s.money('v.pu')} AS amount_positive,
  round({s.pct('positives', 'transactions')} / {s.pct('t.p', 't.n')}, 4) AS lift FROM v, t"""


@query("segment_lift", f"WITH {_LIFT_SQL}")
def segment_lift(spark, sf):
    return kpis.segment_lift(clean.slice_filter(event_cube(spark, sf), SLICE_DAYS, SLICE), "segment")


@query(
    "hour_profile",
    f"""WITH {s.EVC}, seg AS ({s.segments('evc', ['hour'], 100)})
SELECT CAST(value AS INTEGER) AS hour, transactions, positives, rate_pct, row_number() OVER (ORDER BY CAST(value AS INTEGER)) AS position FROM seg""",
)
def hour_profile(spark, sf):
    return ranking.with_position(kpis.hour_profile(ev_segments(spark, sf)))


@query(
    "filter_options",
    f"""WITH {s.DL}, o AS (SELECT DISTINCT 'lang' AS dimension, lang AS value FROM dl
UNION ALL SELECT DISTINCT 'quality', coalesce(CAST(quality AS VARCHAR), '(sin dato)') FROM dl
UNION ALL SELECT DISTINCT 'toxic', coalesce(CAST(toxic AS VARCHAR), '(sin dato)') FROM dl)
SELECT *, row_number() OVER (ORDER BY dimension, value = '(sin dato)', value) AS position FROM o""",
)
def filter_options(spark, sf):
    return ranking.with_position(kpis.filter_options(b.documents_frame(spark, sf), ["lang", "quality", "toxic"]))


# ------------------------------------------------------------------------- alerts


def monitored(spark, sf):
    """Scored events of the monitored day."""
    return b.scored_events(spark, sf).filter(F.col("day") == MONITOR_DAY)


_CARDS = f"""count(*) AS processed, count(*) FILTER (WHERE alert) AS alerts,
  count(*) FILTER (WHERE alert AND is_positive = 1) AS true_alerts"""
_ALERT_UNITS = f"coalesce(CAST(sum({s.units('amount')}) FILTER (WHERE alert) AS BIGINT), 0)"


@query("alert_cards", f"WITH {s.SC} SELECT {_CARDS}, {s.money(_ALERT_UNITS)} AS alert_amount FROM sc WHERE day = {MONITOR_DAY}")
def alert_cards(spark, sf):
    return kpis.alert_cards(monitored(spark, sf), LABEL, AMOUNT)


@query(
    "alerts_hour_matrix",
    f"""WITH {s.SC}, spine AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))
SELECT spine.hour, count(*) FILTER (WHERE is_positive = 0) AS false_alarms, count(*) FILTER (WHERE is_positive = 1) AS true_alerts
FROM spine LEFT JOIN sc ON sc.hour = spine.hour AND alert AND day = {MONITOR_DAY} GROUP BY spine.hour""",
)
def alerts_hour_matrix(spark, sf):
    return kpis.alerts_hour_matrix(monitored(spark, sf), LABEL)


@query(
    "cumulative_by_hour",
    f"""WITH {s.SC}, spine AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24)),
c AS (SELECT spine.hour, count(id) AS processed, count(*) FILTER (WHERE alert) AS alerts,
  count(*) FILTER (WHERE alert AND is_positive = 1) AS true_alerts, {_ALERT_UNITS} AS au
  FROM spine LEFT JOIN sc ON sc.hour <= spine.hour AND day = {MONITOR_DAY} GROUP BY spine.hour)
SELECT hour, processed, alerts, true_alerts, {s.money('au')} AS alert_amount FROM c""",
)
def cumulative_by_hour(spark, sf):
    return kpis.cumulative_by_hour(monitored(spark, sf), LABEL, AMOUNT)


# ------------------------------------------------------------------------- moving windows

_DAILY_SQL = f"{s.EVC}, cube AS ({s.cube('evc', CUBE_DIMS)}), d AS ({s.daily()})"
_WINDOW = "OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def _daily(spark, sf):
    return kpis.reaggregate_slice(event_cube(spark, sf))


@query(
    "rolling_rate",
    f"WITH {_DAILY_SQL} SELECT day, round({s.pct(f'sum(positives) {_WINDOW}', f'sum(transactions) {_WINDOW}')}, 6) AS rolling_rate_pct FROM d",
)
def rolling_rate(spark, sf):
    return kpis.rolling_rate(_daily(spark, sf))


@query(
    "rolling_mean_of_rates",
    f"""WITH {_DAILY_SQL}, r AS (SELECT day, {s.half_up('100 * positives', 'transactions', 3)} AS rate FROM d)
SELECT day, round(avg(rate) {_WINDOW}, 6) AS rolling_mean_rate_pct FROM r""",
)
def rolling_mean_of_rates(spark, sf):
    return kpis.rolling_mean_of_rates(_daily(spark, sf))


@query(
    "rolling_amount_share",
    f"WITH {_DAILY_SQL} SELECT day, round({s.pct(f'sum(pu) {_WINDOW}', f'sum(au) {_WINDOW}')}, 6) AS rolling_amount_share_pct FROM d",
)
def rolling_amount_share(spark, sf):
    return kpis.rolling_amount_share(_daily(spark, sf))


_GAPS_SQL = f"{_DAILY_SQL}, g AS (SELECT * FROM d WHERE day % 4 <> 3 AND day NOT BETWEEN 9 AND 13)"
_CALENDAR = "OVER (ORDER BY day RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)"


def _both_frames(measure: str, expression) -> str:
    return f"{expression(_WINDOW)} AS {measure}_rows, {expression(_CALENDAR)} AS {measure}_days"


@query(
    "rolling_calendar",
    f"""WITH {_GAPS_SQL}, r AS (SELECT *, {s.half_up('100 * positives', 'transactions', 3)} AS rate FROM g) SELECT day,
  {_both_frames('rate', lambda w: f"round({s.pct(f'sum(positives) {w}', f'sum(transactions) {w}')}, 6)")},
  {_both_frames('mean_rate', lambda w: f"round(avg(rate) {w}, 6)")},
  {_both_frames('share', lambda w: f"round({s.pct(f'sum(pu) {w}', f'sum(au) {w}')}, 6)")} FROM r""",
)
def rolling_calendar(spark, sf):
    """The three moving figures over a daily table with missing days: over seven rows and over seven calendar days."""
    daily = _daily(spark, sf).filter((F.col("day") % 4 != 3) & ~F.col("day").between(9, 13))
    out = None
    for measure, fn in (("rate", kpis.rolling_rate), ("mean_rate", kpis.rolling_mean_of_rates), ("share", kpis.rolling_amount_share)):
        for frame, calendar in (("rows", False), ("days", True)):
            part = fn(daily, calendar=calendar).toDF("day", f"{measure}_{frame}")
            out = part if out is None else out.join(part, "day")
    return out


# ------------------------------------------------------------------------- order and top-k


@query("ordered_output", f"WITH {LI_SEG_SQL} SELECT *, row_number() OVER (ORDER BY segment, rate_pct DESC, value) AS position FROM seg")
def ordered_output(spark, sf):
    return ranking.with_position(ranking.ordered_output(li_segments(spark, sf), "segment", F.col("rate_pct").desc(), "value"))


@query("top_segments", f"WITH {LI_SEG_SQL} SELECT * FROM seg WHERE segment = 'p_name' ORDER BY rate_pct DESC, value LIMIT 12")
def top_segments(spark, sf):
    return ranking.top_segments(li_segments(spark, sf).filter(F.col("segment") == "p_name"), 12)


@query(
    "top_segments_per_panel",
    f"""WITH {LI_SEG_SQL}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY rate_pct DESC, value) AS INTEGER) AS rank
  FROM seg WHERE segment IN ('p_brand', 'p_name', 'mktsegment')) SELECT * FROM r WHERE rank <= 8""",
)
def top_segments_per_panel(spark, sf):
    return ranking.top_segments_per_panel(li_segments(spark, sf), ["p_brand", "p_name", "mktsegment"], 8)


def _profile_sql(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_fraction FROM {source}"
        for c in columns
    )


@query(
    "top_null_columns",
    f"WITH {s.DL}, p AS ({_profile_sql(DL_COLUMNS, 'dl')}) SELECT * FROM p ORDER BY null_fraction DESC, column_name LIMIT 3",
)
def top_null_columns(spark, sf):
    return ranking.top_null_columns(clean.null_profile(b.documents_frame(spark, sf), DL_COLUMNS), 3)


_REAL = "CASE WHEN is_positive = 1 THEN 'Sí' ELSE 'No' END AS was_positive"


@query(
    "latest_alerts",
    f"WITH {s.SC} SELECT id, seconds, hour, amount, score, {_REAL} FROM sc WHERE alert ORDER BY seconds DESC, hour DESC, id DESC LIMIT 10",
)
def latest_alerts(spark, sf):
    latest = ranking.latest_alerts(b.scored_events(spark, sf), LABEL, "id", time="seconds")
    return latest.select("id", "seconds", "hour", "amount", "score", "was_positive")


@query(
    "alert_queue",
    f"WITH {s.SC} SELECT id, hour, amount, score, channel, {_REAL}, row_number() OVER (ORDER BY score DESC, id) AS position FROM sc WHERE alert AND day = {MONITOR_DAY}",
)
def alert_queue(spark, sf):
    queue = ranking.alert_queue(b.scored_events(spark, sf), MONITOR_DAY, LABEL, "id")
    return ranking.with_position(queue.select("id", "hour", "amount", "score", "channel", "was_positive"))
