"""Joins and unions. The join strategy is left to the optimizer and its runtime statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.hashing import keep_fraction
from riskmart.functions.measures import half_up


def left_join_presence(facts: DataFrame, side: DataFrame, key: str, flag: str = "has_side") -> DataFrame:
    """Every fact with the side row of its key, and whether there was one.

    Presence is read off the side's own key after the join. Both inputs must hold one row per key (see ``dedup_by_key``), so rows
    never fan out.
    """
    other = [c for c in side.columns if c != key]
    matched = facts.alias("f").join(side.alias("s"), F.col(f"f.{key}") == F.col(f"s.{key}"), "left")
    return matched.select("f.*", *[F.col(f"s.`{c}`") for c in other], F.col(f"s.{key}").isNotNull().alias(flag))


def semi_join_sample(
    facts: DataFrame, side: DataFrame, key: str, fraction: float, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Sample facts by key, keep exactly the side rows whose fact survived."""
    sampled = facts.filter(keep_fraction(F.col(key), fraction, seed))
    # the same draw on the side key trims it before the join
    kept = side.filter(keep_fraction(F.col(key), fraction, seed)).join(
        sampled.select(key), key, "left_semi"
    )
    return sampled, kept


def rows_of_day(features: DataFrame, times: DataFrame, key: str, day: int) -> DataFrame:
    """Feature rows of one day with their time columns; the day filter reaches the scan of the times."""
    return features.join(times.filter(F.col("day") == day), key)


def replay_day(features: DataFrame, times: DataFrame, key: str, day: int, seconds: str) -> DataFrame:
    """Feature rows of one day in the order in which they happened."""
    return rows_of_day(features, times, key, day).orderBy(seconds, key)


def enrich_scores(scores: DataFrame, facts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Attach business columns to scored rows; only the needed fact columns are read."""
    wanted = [c for c in columns if c in facts.columns and c not in scores.columns]
    return scores.join(facts.select(key, *wanted), key, "left")


def side_coverage(facts: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Share of fact rows whose key occurs in the side table."""
    # facts are counted per key first, so a key with very many facts joins as one row
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    present = side.select(key).distinct().withColumn("_hit", F.lit(True))
    n = F.coalesce(F.sum("_n"), F.lit(0))
    covered = F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0))
    return (
        per_key.join(present, key, "left")
        .agg(n.alias("n_rows"), covered.alias("covered"))
        .select("n_rows", "covered", half_up(F.col("covered") * 100, F.col("n_rows"), 1).alias("covered_pct"))
    )


def union_missing(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def union_scored(scored: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Validation and holdout together: one scan over both partitions instead of a union of two."""
    return scored.filter(F.col("split").isin(*splits))
