"""Mixing sources to target weights by weighted fair queueing.

Targets are words per source, by weight, never above ``max_passes`` times what the source has. Every source offers its documents in
``max_passes`` passes, each in its own shuffled order. A copy finishes at the words its source has offered so far divided by the source's
target. All copies are range-sorted by finish and taken from the front until the total budget is used; so each source has given its
target when the budget ends, to within a document, and the order of finish is an order to train in.

Nulls: a null text has no words; a null source is a source of its own, last in order. Every text of an id in a source has its own place
in the queue, also under a null id; rows that agree in id, source and text share one. In the result an id and source have one row, in
which sizes and words taken add up, and so do all rows with a null id. Empty tables give no rows. Texts
without words are never short of their target: they take nothing. Shuffles depend on id, source, pass and, for null ids, the text alone,
so reruns agree. Only ``doc_id``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.text import WORD_PATTERN, fresh
from riskmart.session import cut_lineage


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat over the sources in code point order; the budget is ``budget_pct`` per cent of all words."""

    weights: tuple[int, ...] = (3, 1, 2)
    budget_pct: int = 150
    max_passes: int = 2


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, mark, size``: the words of every row; ``mark`` is a hash of its text."""
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN), F.lit(0))).cast("bigint")
    return docs.select(*_place(), words.alias("size"))


def _place(docs: str | None = None) -> list[Column]:
    """What rows that share a place in the queue agree in."""
    doc_id, source, text = (F.col(c if docs is None else f"{docs}.{c}") for c in ("doc_id", "source", "text"))
    return [doc_id.cast("bigint").alias("doc_id"), source.cast("string").alias("source"), F.xxhash64(text).alias("mark")]


def queue(df: DataFrame, order: Sequence[str], value: str, out: str, name: str, by: str | None = None) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` up to and with the row, in ``order``, per ``by`` (or over all rows).

    Rows are range-partitioned, numbered by range and written once, so that the ranges are final. A running total is the total of the
    ranges before, plus a running sum inside the range: no task holds a whole queue, and windows without partitions run over ranges only.
    ``order`` begins with ``by``, if that is given, and settles every tie but those between equal rows.
    """
    lanes = [] if by is None else [by]
    ranges = cut_lineage(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    held = ranges.groupBy(*lanes, "part").agg(F.sum(value).alias("held"))
    earlier = Window.partitionBy(*lanes).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(*lanes, "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    inside = F.sum(value).over(Window.partitionBy(*lanes, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = F.col("r.part") == F.col("s.part")
    for lane in lanes:
        same = same & F.col(f"r.{lane}").eqNullSafe(F.col(f"s.{lane}"))
    placed = ranges.withColumn("inside", inside).alias("r").join(starts.alias("s"), same)
    return placed.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("s.start") + F.col("r.inside")).alias(out))


def targets(sized: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``source, source_size, target``: one row per source.

    The shares that stop at their cap and give the excess back end at one level: target = min(cap, level * weight). Sources in
    order of cap / weight are capped up to the first whose level, with all before it capped, is within its own cap; the levels of those
    after it are lower. The windows
    run over one row per source, in one task: the number of sources is taken to fit there (millions do).
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in config.weights]), (F.col("rank") % len(config.weights) + 1).cast("int"))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * config.max_passes).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * config.budget_pct / F.lit(100.0)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    levels = weighed.select("source", "source_size", "weight", "cap", level.alias("level"))
    fits = levels.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    final = fits.withColumn("final", F.max(F.when(F.col("fits"), F.col("level"))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap").cast("double")))
    return final.select("source", "source_size", target.alias("target"))


def offered(sized: DataFrame, goal: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Every copy on offer, in global order of finish: ``doc_id, source, mark, size, pass, finish, until``.

    ``until`` counts the words of all copies up to and with this one.
    """
    shuffle = F.md5(F.concat_ws("|", "source", "pass", F.coalesce("doc_id", "mark")))
    copies = sized.withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(config.max_passes)]))).withColumn("draw", shuffle)
    queued = queue(copies, ["source", "pass", "draw", "doc_id", "mark", "size"], "size", "offered", "mix-queues", by="source")
    with_goal = queued.alias("q").join(goal.alias("g"), F.col("q.source").eqNullSafe(F.col("g.source")))
    finish = F.when(F.col("g.target") > 0, F.col("offered") / F.col("g.target")).otherwise(F.lit(0.0))
    finished = with_goal.select("doc_id", "q.source", "mark", "size", "pass", finish.alias("finish"))
    return queue(finished, ["finish", "source", "pass", "doc_id", "mark", "size"], "size", "until", "mix-finish")


def mixture(docs: DataFrame, config: MixConfig = MixConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, copies in the mix): a copy is in if it ends at most half its size beyond the budget."""
    sized = cut_lineage(sizes(docs).groupBy("doc_id", "source", "mark").agg(F.sum("size").alias("size")), "mix-sizes")
    goal = cut_lineage(targets(sized, config).coalesce(1), "mix-targets")
    size, cap = F.sum("source_size"), F.sum(F.col("source_size") * config.max_passes)
    budget = goal.agg(F.least(size * config.budget_pct / F.lit(100.0), cap.cast("double")).alias("budget")).scalar()
    return sized, goal, offered(sized, goal, config).filter(F.col("until") - F.col("size") / 2 <= budget)


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: one row per id and source; ``taken`` counts repeats."""
    sized, goal, taken = mixture(docs, config)
    words = taken.groupBy("doc_id", "source").agg(F.sum("size").alias("taken"))
    same = F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("s.source").eqNullSafe(F.col("t.source"))
    whole = sized.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    joined = whole.alias("s").join(words.alias("t"), same, "left")
    full = joined.join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    return full.select("s.doc_id", "s.source", "s.size", "g.source_size", "g.target", F.coalesce("t.taken", F.lit(0).cast("bigint")).alias("taken"))


def mixed_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix itself: the columns of ``docs`` once per copy taken, with its ``mix_pass`` and its place ``mix_finish`` in the order of
    training (with leading underscores if ``docs`` has such columns)."""
    copies = mixture(docs, config)[2]
    same = reduce(and_, [place.eqNullSafe(F.col(f"t.{c}")) for place, c in zip(_place("d"), ("doc_id", "source", "mark"))])
    joined = docs.alias("d").join(copies.alias("t"), same)
    return joined.select("d.*", F.col("t.pass").alias(fresh(docs, "mix_pass")), F.col("t.finish").alias(fresh(docs, "mix_finish")))
