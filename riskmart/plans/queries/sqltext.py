"""SQL fragments shared by the oracle statements (DuckDB dialect)."""

from __future__ import annotations

from riskmart.plans import bindings as b


def units(x: str) -> str:
    return f"CAST(floor({x} * 1e4 + 5e-1) AS BIGINT)"


def money(u: str) -> str:
    return f"(CAST(({u}) + 50 - (({u}) + 50) % 100 AS DOUBLE) / 1e4)"


def half_up(num: str, den: str, digits: int) -> str:
    return f"(CAST((({num}) * {2 * 10**digits} + ({den})) // (2 * nullif({den}, 0)) AS DOUBLE) / 1e{digits})"


def ratio_or_zero(num: str, den: str, digits: int) -> str:
    return f"coalesce({half_up(num, den, digits)}, CAST(0 AS DOUBLE))"


def pct(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN 1e2 * CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


def _items(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# The brand of a device text ``dt``, written out by hand
BRAND_OF_DT = """CASE WHEN dt = '' THEN NULL WHEN starts_with(dt, 'sm-') OR starts_with(dt, 'gt-') OR contains(dt, 'samsung') THEN 'samsung'
  WHEN contains(dt, 'ios device') OR contains(dt, 'macos') OR contains(dt, 'iphone') THEN 'apple'
  WHEN starts_with(dt, 'moto') OR starts_with(dt, 'xt') OR contains(dt, 'motorola') THEN 'motorola'
  WHEN starts_with(dt, 'lg') OR contains(dt, 'lg-') THEN 'lg'
  WHEN starts_with(dt, 'ale-') OR starts_with(dt, 'ane-') OR contains(dt, 'huawei') THEN 'huawei'
  WHEN starts_with(dt, 'mi ') OR contains(dt, 'redmi') OR contains(dt, 'xiaomi') THEN 'xiaomi'
  WHEN contains(dt, 'pixel') OR contains(dt, 'nexus') THEN 'google'
  WHEN contains(dt, 'windows') OR contains(dt, 'trident') THEN 'windows'
  WHEN contains(dt, 'linux') THEN 'linux' ELSE 'otro' END"""

EV = f"""ev0 AS (
  SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS seconds,
         CAST(event_type = 'error' AS INTEGER) AS is_positive, value AS amount, event_type AS kind, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
ev AS (
  SELECT id, seconds, CAST(seconds // 86400 AS INTEGER) AS day, CAST((seconds // 3600) % 24 AS INTEGER) AS hour,
         CAST((seconds // 86400) % 7 AS INTEGER) AS weekday, is_positive, amount, kind, user_id,
         CAST(k % 5 AS VARCHAR) AS channel,
         list_extract({_items(b.DEVICE_TEXTS)}, k % {len(b.DEVICE_TEXTS)} + 1) AS device_text,
         list_extract({_items(b.MAIL_DOMAINS)}, k % {len(b.MAIL_DOMAINS)} + 1) AS mail_domain,
         CASE WHEN seconds // 86400 >= {b.HOLDOUT_FROM_DAY} THEN 'test' ELSE 'train' END AS dataset
  FROM ev0)"""

EVC = EV + """,
evc AS (SELECT ev.*, c_mktsegment AS segment FROM ev LEFT JOIN customer ON user_id = c_custkey)"""

SC = EVC + """,
sc AS (
  SELECT *, score >= CAST(5 AS DOUBLE) / 10 AS alert FROM (
    SELECT *, CAST((7000 * (CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10000)) // 10000
                   + 3000 * is_positive AS DOUBLE) / 1e4 AS score
    FROM evc))"""

# validation window of the labelled days
VAL = SC + f""",
val AS (SELECT * FROM sc WHERE dataset = 'train' AND day > {b.VALIDATION_FROM_DAY - 1})"""

LI = """li AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS day,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_positive, l_extendedprice AS amount, l_quantity AS quantity,
         l_discount AS discount, l_tax AS tax, c_mktsegment AS mktsegment, o_orderpriority AS orderpriority,
         o_orderstatus AS orderstatus, l_linestatus AS linestatus, p_type, p_brand, p_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey)"""

LF = """lf AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS day,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_positive, l_extendedprice AS amount, l_quantity AS quantity,
         l_discount AS discount, l_tax AS tax, l_linestatus AS linestatus
  FROM lineitem)"""

DL = """dl AS (
  SELECT d.doc_id, lang, source, n_chars, quality, toxic, l.doc_id IS NOT NULL AS has_label,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) < 15 THEN 'train' ELSE 'test' END AS dataset
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def bundle(label: str = "is_positive", amount: str = "amount") -> str:
    pos = f"count(*) FILTER (WHERE {label} = 1)"
    u = units(amount)
    return f"""count(*) AS transactions, {pos} AS positives,
  {half_up(f"100 * {pos}", f"count({label})", 3)} AS rate_pct,
  {money(f"coalesce(sum({u}), 0)")} AS amount_total,
  {money(f"coalesce(sum({u}) FILTER (WHERE {label} = 1), 0)")} AS amount_positive"""


def segments(source: str, dims: list[str], at_least: int, label: str = "is_positive", amount: str = "amount") -> str:
    parts = [
        f"SELECT '{d}' AS segment, coalesce(CAST({d} AS VARCHAR), '(sin dato)') AS value, {bundle(label, amount)} "
        f"FROM {source} GROUP BY 2 HAVING count(*) >= {at_least}"
        for d in dims
    ]
    return " UNION ALL ".join(parts)


def cube(source: str, dims: list[str], label: str = "is_positive", amount: str = "amount") -> str:
    u = units(amount)
    keys = ", ".join(f"coalesce(CAST({d} AS VARCHAR), '(sin dato)') AS {d}" for d in dims)
    return f"""SELECT day, {keys}, count(*) AS transactions, count(*) FILTER (WHERE {label} = 1) AS positives,
  {money(f"sum({u})")} AS amount_total,
  {money(f"coalesce(sum({u}) FILTER (WHERE {label} = 1), 0)")} AS amount_positive
  FROM {source} GROUP BY ALL"""


def daily(source: str = "cube") -> str:
    """Cube rows to daily sums."""
    return f"""SELECT day, CAST(sum(transactions) AS BIGINT) AS transactions, CAST(sum(positives) AS BIGINT) AS positives,
  CAST(sum({units("amount_total")}) AS BIGINT) AS au, CAST(sum({units("amount_positive")}) AS BIGINT) AS pu
  FROM {source} GROUP BY day"""


def areas(source: str, score: str = "score", prefix: str = "") -> str:
    """CTEs ``<prefix>roc(roc_auc)`` and ``<prefix>prc(pr_auc)`` over distinct scores of a source."""
    return f"""{prefix}counts AS (SELECT {units(score)} AS points, count(*) FILTER (WHERE is_positive = 1) AS pos,
  count(*) FILTER (WHERE is_positive = 0) AS neg FROM {source} GROUP BY 1),
{prefix}swept AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
  CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg
  FROM {prefix}counts WINDOW w AS (ORDER BY points DESC)),
{prefix}pr AS (SELECT *, tp / (tp + fp) AS precision FROM {prefix}swept),
{prefix}steps AS (SELECT pos / all_pos * (precision + coalesce(lag(precision) OVER (ORDER BY points DESC), precision)) / 2 AS step
  FROM {prefix}pr),
{prefix}roc AS (SELECT round(sum(neg * (2 * tp - pos)) / (2 * max(all_pos) * max(all_neg)), 4) AS roc_auc FROM {prefix}swept),
{prefix}prc AS (SELECT round(sum(step), 4) AS pr_auc FROM {prefix}steps)"""
