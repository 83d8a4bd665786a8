"""SimHash near-duplicates by segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts is its place in a grid. The Manhattan distance
of two places is a lower bound of the Hamming distance of the fingerprints. The 32 coordinates are dealt to six blocks: two places
within Manhattan distance 3 agree in all coordinates of at least three blocks, so the range join is an equi-join on the grid cells of
the 20 choices of three blocks. Inside a cell the Manhattan bound is tested first, then the Hamming distance.

Equal fingerprints are one row from the start. A cell returns a spanning forest of its links, not all pairs; a cell with more than ``block``
fingerprints is split into pairs of blocks, which are tasks of their own.

Nulls: a null text has no words and the fingerprint zero, linked like any other. A null id gets the component of its fingerprint and is never its
least id. Rows that repeat an id are linked by that id only if their fingerprints are; each row of the input gives a row. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.components import components
from riskmart.llm.groups import group_bounds, whole_groups
from riskmart.llm.text import fresh, id_and_bytes, utf8
from riskmart.session import cut_lineage

EVEN = 0x5555555555555555


@dataclass(frozen=True)
class SimHashConfig:
    shingle: int = 3
    distance: int = 3
    seed: int = 42
    block: int = 512
    #: shingles hashed at a time: bounds the memory a very long text takes
    chunk: int = 65_536


def fingerprint(data: bytes, config: SimHashConfig = SimHashConfig()) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64; no words: 0."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return 0
    n, k, seed = max(len(words) - config.shingle + 1, 1), config.shingle, config.seed
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, config.chunk):
        part = words[at : min(at + config.chunk, n) + k - 1]
        count = min(config.chunk, n - at)
        shingles = map(b" ".join, zip(*[part[j:] for j in range(k)])) if len(words) >= k else [b" ".join(words)]
        hashes = np.fromiter((xxh64_intdigest(s, seed) for s in shingles), dtype=np.uint64, count=count)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``doc_id, fp, text_hash`` (bigint with the bits of the fingerprint), one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(d, config) for d in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), batch.column(2)], ["doc_id", "fp", "text_hash"])

    return id_and_bytes(docs).withColumn("text_hash", F.xxhash64("data")).mapInArrow(run, "doc_id bigint, fp bigint, text_hash bigint")


def blocks(config: SimHashConfig = SimHashConfig()) -> list[int]:
    """Bit masks of ``distance + 3`` blocks of whole two-bit segments."""
    n = config.distance + 3
    return [sum(0b11 << (2 * s) for s in range(32) if s * n // 32 == b) for b in range(n)]


def _cells(fp: Column, config: SimHashConfig) -> Column:
    """array<struct<grid, cell>>: the cell of every choice of three blocks.

    The counts of all segments fit one bigint: each takes the two bits of its segment, 1 if the bits differ and 2 if both are set.
    """
    low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
    counts = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    out = []
    for g, chosen in enumerate(combinations(blocks(config), 3)):
        mask = int(np.uint64(sum(chosen)).view(np.int64))
        out.append(F.struct(F.lit(g).alias("grid"), counts.bitwiseAND(F.lit(mask)).alias("cell")))
    return F.array(*out)


def _links(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """True where the Manhattan bound of the segment counts and then the Hamming distance are within ``distance``."""
    even = np.uint64(EVEN)
    one = np.uint64(1)
    ca, cb = (a & even) + ((a >> one) & even), (b & even) + ((b >> one) & even)
    bound = np.zeros(np.broadcast(a, b).shape, dtype=np.int64)
    for s in range(0, 64, 2):
        bound += np.abs(((ca >> np.uint64(s)) & np.uint64(3)).astype(np.int8) - ((cb >> np.uint64(s)) & np.uint64(3)).astype(np.int8))
        if s % 16 == 14 and not (bound <= distance).any():
            return np.zeros(bound.shape, dtype=bool)
    return (bound <= distance) & (np.bitwise_count(a ^ b) <= distance)


def _forest(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of two blocks (or within one), without those that close a circle."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for x in a:
        near = b[_links(np.uint64(x), b, distance)]
        for y in near.tolist():
            u, v = root(int(x)), root(y)
            if u != v:
                parent[v] = u
                edges.append((int(x), y))
    return edges


def fingerprint_links(distinct: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``a, b``: links between different fingerprints that connect all that are within ``distance``."""
    cells = distinct.select("fp", F.inline(_cells(F.col("fp"), config)))
    sizes = cells.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = cells.join(sizes, ["grid", "cell"])
    # block pairs (i <= j) of a crowded cell: each fingerprint goes to the pairs its own block is part of
    n_blocks = F.ceil(F.col("n") / config.block).cast("int")
    own = F.pmod(F.xxhash64("fp"), n_blocks).cast("int")
    dealt = crowded.withColumn("blocks", n_blocks).withColumn("own", own).select(
        "grid", "cell", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    dealt = dealt.select("grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    key = ["grid", "cell", "i", "j"]
    sorted_cells = dealt.repartition(*key).sortWithinPartitions(*key, "own", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: np.ndarray) -> list[tuple[int, int]]:
            """Links of the whole cells in ``rows`` (columns grid, cell, i, j, own, fp)."""
            starts, lengths = group_bounds(rows, 4)
            fp = np.ascontiguousarray(rows[:, 5]).view(np.uint64)
            out: list[tuple[int, int]] = []
            pairs = starts[lengths == 2]
            if len(pairs):
                hit = pairs[_links(fp[pairs], fp[pairs + 1], config.distance)]
                out += zip(fp[hit].tolist(), fp[hit + 1].tolist())
            for s, n in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist()):
                i, j = rows[s, 2], rows[s, 3]
                own_block, group = rows[s : s + n, 4], fp[s : s + n]
                if i == j:
                    out += _forest(group, group, config.distance)
                else:
                    out += _forest(group[own_block == i], group[own_block == j], config.distance)
            return out

        for rows in whole_groups(batches, 4):  # a group is at most two blocks
            yield as_batch(links(rows))

    def as_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(pairs, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

    return sorted_cells.mapInArrow(run, "a bigint, b bigint").distinct()


def _classes(docs: DataFrame, config: SimHashConfig) -> DataFrame:
    """``doc_id, fp, text_hash, root, component_id``: ``root`` tells components apart that have the same least id."""
    found = cut_lineage(fingerprints(docs, config), "simhash-fingerprints")
    # combined in each task: a fingerprint of a third of all rows is one row per task
    distinct = cut_lineage(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    linked = components(fingerprint_links(distinct.select("fp"), config), "simhash")
    rooted = distinct.join(linked, distinct["fp"] == linked["id"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return found.join(classes, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def near_duplicates(docs: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """``doc_id, fp, component_id``, one row per row of ``docs``: the least id reachable over links, itself included."""
    return _classes(docs, config).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, config: SimHashConfig = SimHashConfig()) -> DataFrame:
    """Of each component one row of ``docs`` with its least id, with all columns.

    Rows that repeat an id stay apart if their texts are in different components; in one component the one of least text hash stays.
    Rows with a null id stay.
    """
    least = _classes(docs, config).filter("doc_id = component_id")
    stays = least.groupBy("root").agg(F.min(F.struct("text_hash", "doc_id")).alias("s")).select("s.doc_id", "s.text_hash").distinct()
    rank, mark = fresh(docs, "rank"), fresh(docs, "text_hash")
    order = Window.partitionBy("doc_id", mark).orderBy("text")
    single = docs.filter(F.col("doc_id").isNotNull()).withColumn(mark, F.xxhash64(utf8("text"))).withColumn(rank, F.row_number().over(order))
    at = (F.col("d.doc_id").cast("bigint") == F.col("s.doc_id")) & (F.col(f"d.`{mark}`") == F.col("s.text_hash"))
    kept = single.filter(F.col(rank) == 1).alias("d").join(stays.alias("s"), at, "left_semi").drop(rank, mark)
    return kept.union(docs.filter(F.col("doc_id").isNull()))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
