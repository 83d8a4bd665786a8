"""Fuzzy line dedup by MinHash, in DataFrame expressions alone.

Every line is cut into shingles of ``shingle`` characters (UTF-16 units). Their hash, XORed with a random mask and hashed again (XOR alone ties
the values of small sets together), is turned by 0, 16, 32 and 48 bits: each minimum is one MinHash value, and four that come from one hash are led by
bits of their own. Equal lines, by a 128-bit hash, fall
together in the same aggregate. ``bands`` of ``rows`` values are the keys of candidate buckets. A bucket links its lines to its least line, so candidates grow with
the lines, not with their pairs. Candidates are verified by exact Jaccard similarity. Buckets that still hold more than one
component then compare each line outside the component of the least line with the lines of other components: no candidate
link is lost to the first step. Distributed union-find joins the links, and of each component one line stays: the first in
the document of least id.

Lines without a word are never dropped. Nulls: a null text is empty; rows with a null id keep all their lines and never are the
reason that another line goes, rows that repeat an id are read as one document of equal lines. Empty texts have one blank line. Other columns
are not read, and ``dedup_lines`` gives them back unchanged.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.components import components
from riskmart.llm.text import fresh, let
from riskmart.session import cut_lineage


@dataclass(frozen=True)
class LineConfig:
    """At similarity 0.8 a pair shares a bucket with probability 1 - (1 - 0.8 ** rows) ** bands = 0.993, at 0.9 with 0.9999.

    ``broadcast_ids``: candidate ids are broadcast only up to this number (16 bytes each), else joined.
    """

    shingle: int = 8
    rows: int = 3
    bands: int = 7
    similarity: float = 0.8
    broadcast_ids: int = 1_000_000
    #: lines outside the main component of a bucket that one task compares with the bucket
    block: int = 128
    #: shingles that one row takes through the aggregation
    stride: int = 4


def mask(k: int) -> int:
    """The k-th random mask, from a rule."""
    return int(np.frombuffer(hashlib.blake2b(f"minhash {k}".encode(), digest_size=8).digest(), dtype=np.int64)[0])


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, pos, line, h1, h2``: every line; h1 and h2 are two seeds of its hash."""
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line")
    )
    return split.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit("second"), "line"))


def _has_word(text: str = "line") -> Column:
    return F.btrim(text, F.lit(" \t\u000b\f\r\n")) != ""


def _wide(line: str) -> Column:
    """Two bytes per character, so that a shingle is found at once."""
    return F.encode(line, "UTF-16BE")


def _shingle_hash(wide: Column, at: Column, config: LineConfig) -> Column:
    return F.xxhash64(F.substring(wide, at * 2 + 1, F.lit(2 * config.shingle)))


def _last_start(line: Column, config: LineConfig) -> Column:
    """Where the last shingle of a wide line begins; a line shorter than a shingle is its own and only one."""
    return F.greatest((F.octet_length(line) / 2).cast("int") - config.shingle, F.lit(0))


def _turned(h: Column, bits: int) -> Column:
    return F.shiftleft(h, bits).bitwiseOR(F.shiftrightunsigned(h, 64 - bits)) if bits else h


def signatures(every_line: DataFrame, config: LineConfig) -> DataFrame:
    """``h1, h2, keeper, n, k0, k1 ...``: one row per different line, ``n`` times found, with the key of its bucket in each band; ``keeper`` is
    the least id that holds it.

    The minima of a line are whole within its task, and so are those of its copies there: what is shuffled is one row per line and task.
    A row takes ``stride`` shingles; at the end of a line the last one repeats, which changes no minimum.
    """
    values, each = config.rows * config.bands, range(config.stride)
    hashes = range(-(-values // 4))  # four values from each
    wide = every_line.filter(_has_word()).select("doc_id", "h1", "h2", _wide("line").alias("wide"))
    last = _last_start(F.col("wide"), config)
    rows = wide.select("doc_id", "h1", "h2", "wide", last.alias("last"), F.explode(F.sequence(F.lit(0), last, F.lit(config.stride))).alias("at"))
    shingles = [_shingle_hash(F.col("wide"), F.least(F.col("at") + j, F.col("last")), config).alias(f"s{j}") for j in each]
    hashed = rows.select("doc_id", "h1", "h2", "at", *shingles)
    hashed = hashed.select("doc_id", "h1", "h2", "at", *[F.xxhash64(F.col(f"s{j}").bitwiseXOR(F.lit(mask(i)))).alias(f"s{j}_{i}") for i in hashes for j in each])

    def value(k: int) -> Column:
        turned = [_turned(F.col(f"s{j}_{k // 4}"), 16 * (k % 4)) for j in each]
        return F.least(*turned) if config.stride > 1 else turned[0]

    least = hashed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("keeper"), F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("n"),
        *[F.min(value(k)).alias(f"m{k}") for k in range(values)],
    )
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{b * config.rows + r}") for r in range(config.rows)]).alias(f"k{b}") for b in range(config.bands)]
    return least.select("h1", "h2", "keeper", "n", *keys)


def _buckets(signed: DataFrame, bands: range) -> DataFrame:
    """``bucket, id, least, n``: the lines in buckets of more than one line, with the least id and the size of the bucket."""
    members = signed.select(F.explode(F.array(*[F.col(f"k{b}") for b in bands])).alias("bucket"), F.col("h1").alias("id"))
    # combined in each task before the shuffle; most buckets hold one line and end here
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).filter("n > 1")
    return cut_lineage(members.join(sizes, "bucket").select("bucket", "id", "least", "n"), "line-buckets")


def _shingles(line: str, config: LineConfig) -> Column:
    """The different shingle hashes of a line; the line is widened once, as a variable, not once per shingle."""
    starts = lambda wide: F.sequence(F.lit(1), _last_start(wide, config) * 2 + 1, F.lit(2))
    hashed = lambda wide: F.transform(starts(wide), lambda at: F.xxhash64(F.substring(wide, at, F.lit(2 * config.shingle))))
    # outside the lambdas, where it is compiled
    return F.array_distinct(let(_wide(line), hashed))


def _similar(a: Column, b: Column, config: LineConfig) -> Column:
    """Jaccard similarity of two sets of at least ``similarity``; sets too unequal in size are not intersected."""
    sizes = F.size(a) + F.size(b)
    # c / (sizes - c) >= t, with c at most the smaller size
    need = F.lit(config.similarity / (1.0 + config.similarity)) * sizes - F.lit(1e-9)
    # what is left of one set without the other takes one hash table, the intersection two
    return (F.least(F.size(a), F.size(b)) >= need) & (F.size(a) - F.size(F.array_except(a, b)) >= need)


def _texts(ids: DataFrame, every_line: DataFrame, config: LineConfig) -> DataFrame:
    """``h1, line`` for the ids ``h1``: the lines are not shuffled unless they are wanted."""
    few = ids.limit(config.broadcast_ids + 1).count() <= config.broadcast_ids
    wanted = every_line.select("h1", "line").join(F.broadcast(ids) if few else ids, "h1", "left_semi")
    return cut_lineage(wanted.groupBy("h1").agg(F.first("line").alias("line")), "line-texts")


def _verified(pairs: DataFrame, texts: DataFrame, config: LineConfig) -> DataFrame:
    """The ``a, b`` of ``pairs`` (ids h1) whose lines have at least the asked Jaccard similarity.

    A line ``b`` is cut into shingles once for ``block`` of its pairs, not for each; pairs of one line are dealt to several tasks.
    """
    blocks = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / config.block).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("block"))
    ones = dealt.join(texts.withColumnRenamed("h1", "a"), "a")
    hubs = blocks.join(texts.withColumnRenamed("h1", "b"), "b").select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "line")
    ones = ones.repartition("b", "block").select("a", "b", "block", _shingles("line", config).alias("set_a"))
    hubs = hubs.repartition("b", "block").select("b", "block", _shingles("line", config).alias("set_b"))
    # Spark would size the sets by the lines
    both = ones.join(hubs.hint("merge"), ["b", "block"])
    return both.filter(_similar(F.col("set_a"), F.col("set_b"), config)).select("a", "b")


def _links_across(in_buckets: DataFrame, rooted: DataFrame, texts: DataFrame, config: LineConfig) -> DataFrame:
    """Links between lines that share a bucket and lie in different components, where the bucket's least line is in another component
    than one of them.

    The join compares each such line with its bucket and returns links only; a pair is compared in the first bucket both share. Large
    buckets are dealt to several tasks.
    """
    placed = in_buckets.join(rooted.select("id", F.col("root").alias("own")), "id", "left")
    placed = placed.join(rooted.select(F.col("id").alias("least"), F.col("root").alias("main")), "least", "left")
    placed = placed.select("bucket", "id", "bands", F.coalesce("own", "id").alias("own"), F.coalesce("main", "least").alias("main"))
    outside = placed.filter("own <> main").groupBy("bucket").agg(F.count(F.lit(1)).alias("n_outside"))
    mixed = cut_lineage(placed.join(outside, "bucket"), "line-mixed")
    full = mixed.join(texts.withColumnRenamed("h1", "id"), "id").withColumn("blocks", F.ceil(F.col("n_outside") / config.block).cast("int"))
    deal = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rest = full.filter("own <> main").select(
        "bucket", deal.alias("block"), F.col("id").alias("a"), F.col("own").alias("own_a"), F.col("bands").alias("bands_a"), "line",
    )
    every = full.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("id").alias("b"), F.col("own").alias("own_b"),
        "main", F.col("bands").alias("bands_b"), "line",
    )
    # lines are dealt to the blocks and cut into shingles there: the sets are eight times as large
    rest = rest.repartition("bucket", "block").withColumn("set_a", _shingles("line", config)).drop("line")
    every = every.repartition("bucket", "block").withColumn("set_b", _shingles("line", config)).drop("line")
    first_shared = F.array_min(F.array_intersect("bands_a", "bands_b"))
    # of two lines outside, one direction is enough
    ordered = (F.col("own_b") == F.col("main")) | (F.col("a") < F.col("b"))
    new = (F.col("own_a") != F.col("own_b")) & ordered & (first_shared == F.col("r.bucket"))
    at = (F.col("r.bucket") == F.col("e.bucket")) & (F.col("r.block") == F.col("e.block"))
    return rest.alias("r").join(every.alias("e"), at & new & _similar(F.col("set_a"), F.col("set_b"), config)).select("a", "b")


def line_classes(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """``h1, h2, root, keeper``: the lines that occur more than once or have a near copy, their class and the id it stays in."""
    every_line = lines(docs)
    signed = cut_lineage(signatures(every_line, config), "line-signatures")
    # three bands after the other: the rows of all need not lie on disk at once
    some = [range(b, min(b + 3, config.bands)) for b in range(0, config.bands, 3)]
    in_buckets = reduce(DataFrame.union, [_buckets(signed, bands) for bands in some])
    pairs = cut_lineage(in_buckets.select(F.col("id").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct(), "line-candidates")
    texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), every_line, config)
    star = cut_lineage(_verified(pairs, texts, config), "line-links")
    # a bucket of two has been compared whole
    own = in_buckets.groupBy("id").agg(F.collect_set("bucket").alias("bands"))  # at most one per band
    larger = in_buckets.filter("n > 2").join(own, "id")
    across = cut_lineage(_links_across(larger, components(star, "line-first"), texts, config), "line-across")
    rooted = components(star.union(across), "line-classes")
    joined = signed.join(rooted, signed["h1"] == rooted["id"], "left").filter("n > 1 or root is not null")
    joined = joined.select("h1", "h2", "keeper", F.coalesce("root", "h1").alias("root"))
    keepers = joined.groupBy("root").agg(F.min("keeper").alias("least_keeper"))
    return joined.join(keepers, "root").select("h1", "h2", "root", F.col("least_keeper").alias("keeper"))


def line_decisions(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """``doc_id, n_lines, dropped``: per id, its lines and the positions (from 0) of those that go, in order."""
    classes = cut_lineage(line_classes(docs, config), "line-classes")
    spots = lines(docs).filter("doc_id is not null").select("doc_id", "pos", "h1", "h2", _has_word().alias("word"))
    joined = spots.join(classes, ["h1", "h2"], "left")
    spot = F.when(F.col("word") & F.col("root").isNotNull(), F.struct("root", "pos", "keeper"))
    per_doc = joined.groupBy("doc_id").agg(F.max("pos").alias("last"), F.collect_set(spot).alias("spots"))

    def gone(ordered: Column) -> Column:
        """In order of class and place, all but the first of a class go: each is compared with the one before it."""
        again = lambda s, i: (i > 0) & (F.element_at(ordered, F.greatest(i, F.lit(1)))["root"] == s["root"])
        return F.filter(ordered, lambda s, i: (s["keeper"] != F.col("doc_id")) | again(s, i))

    dropped = F.transform(let(F.sort_array("spots"), gone), lambda s: s["pos"])
    return per_doc.select("doc_id", (F.col("last") + 1).alias("n_lines"), F.sort_array(dropped).alias("dropped"))


def _without(text: Column, dropped: Column) -> Column:
    """The text without the lines at the sorted places ``dropped``: the stretches between them are cut out and put together."""

    def stretches(x: Column) -> Column:
        bounds = F.concat(F.array(F.lit(-1)), F.filter(F.array_distinct(x["dropped"]), lambda p: p < F.size(x["lines"])), F.array(F.size(x["lines"])))
        return let(bounds, lambda at: F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(at) - 1),
            lambda k: F.slice(x["lines"], F.element_at(at, k) + 2, F.element_at(at, k + 1) - F.element_at(at, k) - 1),
        )))

    return F.array_join(let(F.struct(F.split(text, "\n", -1).alias("lines"), dropped.alias("dropped")), stretches), "\n")


def dedup_lines(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """``docs`` with all columns and without the dropped lines: in ``text``, and in ``n_chars`` if there is such a column.

    A document that loses its last line with a word goes.
    """
    gone = line_decisions(docs, config).filter(F.size("dropped") > 0).select("doc_id", "dropped")
    joined = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").cast("bigint") == F.col("g.doc_id"), "left")
    text = F.when(F.col("g.dropped").isNull(), F.col("d.text")).otherwise(_without(F.col("d.text"), F.col("g.dropped")))
    mark = fresh(docs, "touched")
    left = joined.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns], F.col("g.dropped").isNotNull().alias(mark))
    left = left.filter(~F.col(mark) | _has_word("text")).drop(mark)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left
