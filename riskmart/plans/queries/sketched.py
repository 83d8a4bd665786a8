"""Queries: quantiles and distinct counts of slices, read from stored daily sketches.

Estimates are no business of SQL; the rows say whether each lies within the error the sketch states, next to counts that SQL takes exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.operators import kpis, sketches
from riskmart.plans import bindings as b
from riskmart.plans.queries import sqltext as s
from riskmart.plans.queries.registry import query
from riskmart.session import cut_lineage

LABEL, AMOUNT = "is_positive", "amount"
SLICES = {"all days": (0, 10_000), "days 5 to 12": (5, 12), "day 7": (7, 7)}
PROBS = (0.25, 0.5, 0.99)
_SLICE_VALUES = ", ".join(f"('{name}', {a}, {z})" for name, (a, z) in SLICES.items())


def _sliced(daily, name):
    return daily.filter(F.col("day").between(*SLICES[name]))


def _union(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "percentile_sketches",
    f"""WITH {s.EV}, w(slice, a, z) AS (VALUES {_SLICE_VALUES}),
g AS (SELECT 'all' AS class, day, amount FROM ev UNION ALL SELECT CAST(is_positive AS VARCHAR), day, amount FROM ev)
SELECT slice, class, p.prob, count(*) AS n, min(amount) AS min_value, max(amount) AS max_value, true AS within
FROM w JOIN g ON day BETWEEN a AND z, (VALUES {", ".join(f"(CAST({p} AS DOUBLE))" for p in PROBS)}) p(prob) GROUP BY slice, class, p.prob""",
)
def percentile_sketches(spark, sf):
    """Percentiles of three slices of days from one stored table of daily sketches; ``within``: the exact rank of the value is that near."""
    events = b.events_frame(spark, sf).select("day", LABEL, AMOUNT)
    stored = cut_lineage(sketches.daily_quantiles(events, AMOUNT, LABEL), "daily-quantiles")
    found = []
    for name in SLICES:
        wide = sketches.percentiles_from_sketches(_sliced(stored, name), PROBS)
        points = F.array(*[F.struct(F.lit(p).alias("prob"), F.col(f"p{round(100 * p):02d}").alias("value")) for p in PROBS])
        long = wide.select(F.lit(name).alias("slice"), "class", "n", "min_value", "max_value", F.inline(points))
        facts = _sliced(events, name).select(F.explode(F.array(F.lit("all"), F.col(LABEL).cast("string"))).alias("class"), AMOUNT)
        ranked = long.join(facts, "class").groupBy("slice", "class", "prob", "n", "min_value", "max_value").agg(
            F.count(F.when(F.col(AMOUNT) < F.col("value"), 1)).alias("below"), F.count(F.when(F.col(AMOUNT) <= F.col("value"), 1)).alias("upto")
        )
        # twice the error at 99 %: the sketch draws at random, and the rows must not change from run to run
        slack = F.lit(2 * sketches.rank_error()) * F.col("n") + 1
        target = F.col("prob") * F.col("n")
        near = (F.col("below") <= target + slack) & (F.col("upto") >= target - slack)
        found.append(ranked.select("slice", "class", "prob", "n", "min_value", "max_value", near.alias("within")))
    return _union(found)


@query(
    "box_sketches",
    f"""WITH {s.EV} SELECT CAST(is_positive AS VARCHAR) AS class, count(*) AS n, true AS ordered, true AS outliers_within FROM ev GROUP BY is_positive""",
)
def box_sketches(spark, sf):
    """Quartiles, fences and outliers from stored sketches; the outliers are counted again on the facts."""
    events = b.events_frame(spark, sf).select("day", LABEL, AMOUNT)
    stored = cut_lineage(sketches.daily_quantiles(events, AMOUNT, LABEL), "daily-quantiles")
    box = sketches.box_from_sketches(stored)
    facts = events.select(F.col(LABEL).cast("string").alias("class"), AMOUNT)
    beyond = (F.col(AMOUNT) < F.col("low_fence")) | (F.col(AMOUNT) > F.col("high_fence"))
    counted = facts.join(box, "class").groupBy("class", "n", "q1", "median", "q3", "outliers").agg(F.count(F.when(beyond, 1)).alias("exact"))
    near = F.abs(F.col("exact") - F.col("outliers")) <= F.lit(4 * sketches.rank_error() + 1 / sketches.BOX_STEPS) * F.col("n") + 1
    return counted.select("class", "n", ((F.col("q1") <= F.col("median")) & (F.col("median") <= F.col("q3"))).alias("ordered"), near.alias("outliers_within"))


@query(
    "distinct_sketches",
    f"""WITH {s.EV}, w(slice, a, z) AS (VALUES {_SLICE_VALUES}),
e AS (SELECT slice, channel, user_id FROM w JOIN ev ON day BETWEEN a AND z UNION ALL SELECT slice, 'all', user_id FROM w JOIN ev ON day BETWEEN a AND z)
SELECT slice, channel, count(*) AS transactions, count(DISTINCT user_id) AS users, true AS users_within, true AS devices_within FROM e GROUP BY slice, channel""",
)
def distinct_sketches(spark, sf):
    """Distinct users and devices of slices of the stored cube, per channel and over all, within three standard deviations of the exact count."""
    events = b.events_frame(spark, sf).select("day", "channel", LABEL, AMOUNT, "user_id", "device_text")
    names = {"users": "user_id", "devices": "device_text"}
    cube = cut_lineage(sketches.cube_with_distinct(events, ["channel"], LABEL, AMOUNT, names), "cube-distinct")
    own_and_all = F.explode(F.array("channel", F.lit("all")))
    found = []
    for name in SLICES:
        estimated = sketches.slice_distinct(_sliced(cube, name).withColumn("channel", own_and_all), list(names), ["channel"])
        facts = _sliced(events, name).withColumn("channel", own_and_all)
        exact = facts.groupBy("channel").agg(*[F.countDistinct(c).alias(f"{n}_exact") for n, c in names.items()])
        near = {n: F.abs(F.col(n) - F.col(f"{n}_exact")) <= F.lit(3 * sketches.distinct_error()) * F.col(f"{n}_exact") + 1 for n in names}
        found.append(estimated.join(exact, "channel").select(
            F.lit(name).alias("slice"), "channel", "transactions", F.col("users_exact").alias("users"), *[near[n].alias(f"{n}_within") for n in names]
        ))
    return _union(found)


@query(
    "distinct_profile_approximate",
    f"WITH {s.LI} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, true AS within FROM li" for c in b.LI_SEGMENTS),
)
def distinct_profile_approximate(spark, sf):
    """The profile without a shuffle of values, next to the exact one: within three times the asked deviation."""
    facts, rsd = b.lineitem_frame(spark, sf), 0.01
    near = kpis.distinct_profile(facts, b.LI_SEGMENTS, approximate=True, rsd=rsd).withColumnRenamed("distinct_values", "estimate")
    joined = kpis.distinct_profile(facts, b.LI_SEGMENTS).join(near, "column_name")
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    return joined.select("column_name", "distinct_values", (off <= F.lit(3 * rsd) * F.col("distinct_values") + 1).alias("within"))
