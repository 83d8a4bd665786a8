"""Fuzzy passages that repeat across documents, by collinear chaining of shared word k-mers.

Of every ``window`` k-mers in a row the one of least hash is a seed, so two texts that share a run of window + k - 1 words share a seed. Every seed is
tied to its first document, the one of least id; each other occurrence is matched with that one and with its holder before it in order of ids, which
keeps matches at most twice as many as occurrences, not as their pairs. One shuffle sorts the occurrences; a walk over them finds both. Passages with first documents come first; chains with holders before are
aligned if their words are not in those. The matches of a document with another are chained under gap costs (a Fenwick tree finds
the best predecessor), chains are extended over the words around them and aligned, and what has at least ``min_words`` words and
``identity`` of them in common order is a passage. A chain that has not is cut at its largest gap, and so are its parts, until each is a passage or too short.

Two holders an occurrence are not all. For what those rounds leave, a third one is whole: where a document has words outside its passages, every two of its
shared seeds that lie about as far apart as the ends of the shortest chain are one key, and under it the document is matched with every other one of lower id. This grows with
the pairs of documents that share such a stretch and no passage found before; it is one join, spread over all tasks.

A passage is kept in the document of least id and reported in every other one. Nulls: null texts have no words; rows with a null id cannot be
named and are left out. Rows that repeat an id are one document; its passages within itself are not reported. Ties between
occurrences in the first document go to the first position. Empty texts and tables give nothing; texts of any length are read whole. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.chaining import chains, common_words, extension, segments
from riskmart.llm.groups import group_bounds, whole_groups
from riskmart.llm.text import id_and_bytes
from riskmart.session import cut_lineage, scratch_path, scratch_scope

CACHED_WORDS = 300_000
CHAIN = "doc_id bigint, other_id bigint, x0 bigint, x1 bigint, y0 bigint, y1 bigint, runs binary"
CHAIN_ROUND = CHAIN + ", later boolean"
PASSAGE = "doc_id bigint, start bigint, end bigint, other_id bigint, other_start bigint, other_end bigint, identity double"


@dataclass(frozen=True)
class SubstringConfig:
    k: int = 5
    window: int = 12
    min_words: int = 50
    identity: float = 0.8
    gap_cost: float = 0.5
    #: requests for stretches of one document that one row carries
    batch: int = 500
    #: a seed with about one in so many of all occurrences (there are no more such seeds than that) is dealt to several tasks, by ranges of ids
    hot: int = 2000
    ranges: int = 64
    #: one document in so many is counted to find them
    sample: int = 16
    #: rows of 16 bytes, each the mask of 64 ids, that are sent to every task at most
    most_blocks: int = 1_000_000

    @property
    def margin(self) -> int:
        """Words of a common run that may lie before its first or after its last seed."""
        return self.window + self.k


class Seeds:
    """Seeds of texts; remembers the hashes of a bounded number of words."""

    def __init__(self, config: SubstringConfig):
        self.config, self.known = config, {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(positions, seeds) of a text; stuttering text has a seed in every ``window`` words."""
        k, n = self.config.k, len(words) - self.config.k + 1
        if n < 1:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        h = self.word_hashes(words)
        mixed = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            mixed = (mixed ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        w = min(self.config.window, n)
        at = np.unique(np.lib.stride_tricks.sliding_window_view(mixed, w).argmin(axis=1) + np.arange(n - w + 1))
        seeds = mixed[at]
        # in a run of one k-mer every position is its least: keep one in ``window``, told apart by its place in the run
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = seeds[1:] != seeds[:-1]
        offset = at - at[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        kept = offset % self.config.window == 0
        seeds = seeds + (offset // self.config.window).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return at[kept].astype(np.int64), seeds[kept].view(np.int64)


def seed_table(docs: DataFrame, config: SubstringConfig) -> DataFrame:
    """``seed, doc_id, pos``: every occurrence of a seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Seeds(config)
        names = ["seed", "doc_id", "pos"]
        for batch in batches:
            ids, data = batch.column(0).to_pylist(), batch.column(1)
            for low in range(0, len(ids), 256):
                parts = []
                for k in range(low, min(low + 256, len(ids))):
                    at, seeds = finder.find(data[k].as_py().split())
                    parts.append((seeds, np.full(len(at), ids[k], dtype=np.int64), at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)

    named = id_and_bytes(docs).filter("doc_id is not null")
    return named.mapInArrow(run, "seed bigint, doc_id bigint, pos int")


def hot_seeds(seeds: DataFrame, config: SubstringConfig) -> list[int]:
    """The seeds that would make one task long, estimated on a sample of documents; at most ``hot``. Which they are changes no result."""
    sampled = seeds.filter(F.pmod(F.xxhash64("doc_id"), F.lit(config.sample)) == 0)
    counts = cut_lineage(sampled.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "passage-sample")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r.seed for r in counts.filter(F.col("n") > max(total // config.hot, config.hot // config.sample)).select("seed").collect()]


def id_ranges(occurrences: DataFrame, config: SubstringConfig) -> Column:
    """The range of ids that an occurrence of a hot seed is dealt to."""
    at = [i / config.ranges for i in range(1, config.ranges)]
    bounds = occurrences.agg(F.percentile_approx("doc_id", at, 1000)).first()[0] or []
    return F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b < F.col("doc_id")))


def packed(x: Column, y: Column, later: int) -> Column:
    """Both positions and the round in one number, in order of x, then y."""
    return F.shiftleft(x.cast("bigint"), 32).bitwiseOR(F.shiftleft(y.cast("bigint"), 1)).bitwiseOR(F.lit(later).cast("bigint"))


def hot_matches(seeds: DataFrame, config: SubstringConfig) -> DataFrame:
    """``seed_matches`` of hot seeds: first documents by aggregation, holders before by ranges of ids.

    The first holder of a range takes the last one of the ranges before.
    """
    origins = seeds.groupBy("seed").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    place = F.struct(F.col("doc_id").alias("id"), (-F.col("pos")).alias("minus"))
    dealt = seeds.withColumn("part", id_ranges(seeds, config))
    lower = Window.partitionBy("seed", "part").orderBy("doc_id").rangeBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("inside", F.max(place).over(lower))
    last = dealt.groupBy("seed", "part").agg(F.max(place).alias("last"))
    # one row per hot seed and range
    until = Window.partitionBy("seed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = last.select("seed", "part", F.max("last").over(until).alias("ahead"))
    placed = within.join(ahead, ["seed", "part"], "left").join(origins, "seed").withColumn("before", F.coalesce("inside", "ahead"))
    other, x = F.col("first.doc_id"), F.col("pos")
    found = F.array(
        F.when(F.col("doc_id") != other, F.struct(other.alias("other_id"), packed(x, F.col("first.pos"), 0).alias("at"))),
        F.when(F.col("before.id") != other, F.struct(F.col("before.id").alias("other_id"), packed(x, -F.col("before.minus"), 1).alias("at"))),
    )
    return placed.select("doc_id", F.inline(F.array_compact(found)))


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of occurrences sorted by seed, document and position. What is held is one batch and, of the seed at its end, three places."""
    names = ["doc_id", "other_id", "at"]
    held = np.zeros((0, 3), dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        rows = np.concatenate([held[held[:, 0] == rows[0, 0]], rows])
        skip, n = len(rows) - batch.num_rows, len(rows)
        seed, doc, pos = rows.T
        new_seed, new_doc = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        new_seed[1:] = seed[1:] != seed[:-1]
        new_doc[1:] = new_seed[1:] | (doc[1:] != doc[:-1])
        first = np.maximum.accumulate(np.where(new_seed, np.arange(n), 0))
        starts = np.flatnonzero(new_doc)
        run = np.cumsum(new_doc) - 1
        before = starts[np.maximum(run - 1, 0)]  # where the document before begins
        x, here = pos << 32, np.arange(n) >= skip
        to_first = here & (doc != doc[first])
        to_before = to_first & (before > first) & (doc[before] != doc[first])
        columns = [
            np.concatenate([doc[to_first], doc[to_before]]), np.concatenate([doc[first][to_first], doc[before][to_before]]),
            np.concatenate([(x | pos[first] << 1)[to_first], (x | pos[before] << 1 | 1)[to_before]]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        end = n - 1
        keep = sorted({int(first[end]), int(starts[run[end]]), *([int(before[end])] if before[end] >= first[end] else [])})
        held = rows[keep]


def seed_matches(seeds: DataFrame, config: SubstringConfig) -> DataFrame:
    """``doc_id, other_id, at``: each occurrence of a shared seed, with the seed's place in its first document and, in the later round, in the
    holder before if that is another one; ``at`` packs both positions and the round.

    One shuffle deals the seeds, and one walk over each task's sorted share finds all its matches.
    """
    hot = hot_seeds(seeds, config)
    cold = seeds.filter(~F.col("seed").isin(hot)) if hot else seeds
    order = ["seed", "doc_id", "pos"]
    found = cold.select(*order).repartition("seed").sortWithinPartitions(*order).mapInArrow(walked, "doc_id bigint, other_id bigint, at bigint")
    return found.union(hot_matches(seeds.filter(F.col("seed").isin(hot)), config)) if hot else found


def least_chain(config: SubstringConfig) -> int:
    """Words of the shortest chain: a passage of ``min_words`` may begin and end up to a margin beyond its outer seeds."""
    return max(config.k, config.min_words - 2 * config.margin)


def seed_pairs(seeds: DataFrame, told: DataFrame, config: SubstringConfig) -> DataFrame:
    """``key, doc_id, x, x2, open``: two shared seeds of a document, at ``x`` and ``x2``, that are as far apart as the ends of a shortest chain or up to
    two windows more, so every longer run of matches on one diagonal has such a pair.

    ``open``: not both seeds lie in passages ``told`` of the document, and one of them is so frequent that first holder and holder before may not be all.
    """
    holders = seeds.groupBy("seed").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
    shared = holders.filter("low < high").select("seed", (F.col("n") > 3).cast("bigint").alias("many"))
    zero = F.lit(0).cast("bigint")
    occurrences = seeds.join(shared, "seed").select("doc_id", F.col("pos").cast("bigint").alias("pos"), zero.alias("end"), "seed", "many")
    spans = told.select("doc_id", F.col("start").alias("pos"), "end", zero.alias("seed"), zero.alias("many")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = least_chain(config) - config.k
        high = low + 2 * config.window
        names = ["key", "doc_id", "x", "x2", "open"]
        for rows in whole_groups(batches, 1):
            for s, n in zip(*group_bounds(rows, 1)):
                group = rows[s : s + n]
                is_span = group[:, 2] > 0
                doc, pos, seed, many = group[0, 0], *group[~is_span][:, [1, 3, 4]].T
                # a document whose words are fewer than a passage's side may have has none
                if not len(pos) or pos[-1] + config.margin < config.identity * config.min_words:
                    continue
                starts, ends = group[is_span, 1], np.maximum.accumulate(group[is_span, 2])
                span = np.searchsorted(starts, pos, side="right") - 1
                inside = (span >= 0) & (pos + config.k <= ends[np.maximum(span, 0)]) if len(starts) else np.zeros(len(pos), dtype=bool)
                first, last = np.searchsorted(pos, pos + low), np.searchsorted(pos, pos + high, side="right")
                counts = last - first
                i = np.repeat(np.arange(len(pos)), counts)
                j = np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts) + first[i]
                keys = (seed.view(np.uint64)[i] * np.uint64(0x9E3779B97F4A7C15) ^ seed.view(np.uint64)[j]).view(np.int64)
                unsettled = ~(inside[i] & inside[j]) & ((many[i] | many[j]) > 0)
                columns = [keys, np.full(len(i), doc), pos[i], pos[j], unsettled]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    mixed = occurrences.unionByName(spans).repartition("doc_id").sortWithinPartitions("doc_id", "pos")
    return mixed.mapInArrow(run, "key bigint, doc_id bigint, x bigint, x2 bigint, open boolean")


def remaining_matches(seeds: DataFrame, told: DataFrame, config: SubstringConfig) -> DataFrame:
    """``doc_id, other_id, at``: the matches of unsettled pairs of seeds with all documents of lower id that hold the same pair, however many there are."""
    pairs = cut_lineage(seed_pairs(seeds, told, config), "passage-seed-pairs")
    wanted = pairs.filter("open").drop("open")
    held = pairs.select("key", F.col("doc_id").alias("other_id"), F.col("x").alias("y"), F.col("x2").alias("y2"))
    both = wanted.join(held, "key").filter("other_id < doc_id")
    ends = F.array(packed(F.col("x"), F.col("y"), 1), packed(F.col("x2"), F.col("y2"), 1))
    return both.select("doc_id", "other_id", F.explode(ends).alias("at"))


def _single_runs(ids: np.ndarray, runs: np.ndarray, later: bool, names: list[str]) -> pa.RecordBatch:
    """Chains of one run each."""
    n, size = len(runs), runs.shape[1] * 8
    flat = np.ascontiguousarray(runs, dtype=np.int64)
    data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * size).astype(np.int32)), pa.py_buffer(flat.tobytes())])
    columns = [pa.array(np.ascontiguousarray(c)) for c in (*ids.T, *flat.T)]
    return pa.RecordBatch.from_arrays([*columns, data, pa.array(np.full(n, later))], names)


def chain_table(matches: DataFrame, config: SubstringConfig) -> DataFrame:
    """Chains long enough to belong to a passage; ``later`` are those that only matches with holders before give. A group is one document with
    another: its size is bounded by the document's."""

    least = least_chain(config)
    names, types = ["doc_id", "other_id", "x0", "x1", "y0", "y1", "runs", "later"], [pa.int64()] * 6 + [pa.binary(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed_rows in whole_groups(batches, 2):
            at, out = packed_rows[:, 2], []
            starts, lengths = group_bounds(packed_rows, 2)
            ids, group = packed_rows[starts, :2], np.repeat(np.arange(len(starts)), lengths)
            x, y, is_later = at >> 32, (at & 0xFFFFFFFF) >> 1, (at & 1) == 1
            first, second = (
                segments(group[some], x[some], y[some], config.k, 2 * config.window) for some in (~is_later, np.isin(group, group[is_later]))
            )
            # most pairs of documents have one run in one round: its own chain
            rounds = [(first, False), (second, True)]
            owners = np.concatenate([first[0], second[0]])
            alone = np.bincount(owners, minlength=len(ids)) == 1
            for (owner, runs), later in rounds:
                mine = alone[owner] & (runs[:, 1] - runs[:, 0] >= least)
                if mine.any():
                    yield _single_runs(ids[owner[mine]], runs[mine], later, names)
            several: dict[int, set] = {}
            for (owner, runs), later in rounds:
                left = ~alone[owner]
                owner, runs = owner[left], runs[left]
                for s, n in zip(*group_bounds(owner[:, None], 1)):
                    some, seen = runs[s : s + n], several.setdefault(int(owner[s]), set())
                    if some[:, 1].max() - some[:, 0].min() < least:
                        continue
                    for chain in chains(some, config.gap_cost):
                        x0, x1, y0, y1 = chain[0, 0], chain[-1, 1], chain[0, 2], chain[-1, 3]
                        if x1 - x0 >= least and (x0, x1, y0, y1) not in seen:
                            seen.add((x0, x1, y0, y1))
                            out.append((*ids[owner[s]], x0, x1, y0, y1, np.ascontiguousarray(chain).tobytes(), later))
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    pair = ["doc_id", "other_id"]
    return matches.repartition(*pair).sortWithinPartitions(*pair, "at").mapInArrow(run, CHAIN_ROUND)


def untold(found: DataFrame, told: DataFrame, config: SubstringConfig) -> DataFrame:
    """The chains of ``found`` with more words outside the passages ``told`` of their document than a seed's margin, or with none inside."""
    spans = told.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    both = found.join(spans, "doc_id", "left")
    zero = F.struct(F.col("x0").alias("reach"), F.lit(0).cast("bigint").alias("inside"))

    def step(acc: Column, span: Column) -> Column:
        low, high = F.greatest(span["start"], acc["reach"]), F.least(span["end"], F.col("x1"))
        return F.struct(F.greatest(acc["reach"], high).alias("reach"), (acc["inside"] + F.greatest(high - low, F.lit(0))).alias("inside"))

    inside = F.coalesce(F.aggregate("spans", zero, step, lambda acc: acc["inside"]), F.lit(0))
    return both.filter((inside == 0) | (F.col("x1") - F.col("x0") - inside > config.margin)).select(*found.columns)


def taking_part(docs: DataFrame, found: DataFrame, config: SubstringConfig) -> DataFrame:
    """``doc_id, data`` of the documents in ``found``; of all documents if their ids take more than ``most_blocks`` rows of 64.

    The ids are a table of bit masks whose size is known before it is sent to every task, so texts that take no part are not shuffled.
    """
    texts = id_and_bytes(docs)
    ids = found.select(F.explode(F.array("doc_id", "other_id")).alias("id"))
    blocks = ids.groupBy(F.shiftright("id", 6).alias("block")).agg(F.expr("bit_or(shiftleft(1L, cast(id & 63 AS int)))").alias("bits"))
    blocks = cut_lineage(blocks, "passage-ids")
    if blocks.count() > config.most_blocks:
        return texts
    within = (F.shiftright("doc_id", 6) == F.col("block")) & (F.getbit("bits", F.col("doc_id").bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1)
    return texts.join(F.broadcast(blocks), within, "left_semi")


def stretches(docs: DataFrame, found: DataFrame, config: SubstringConfig) -> DataFrame:
    """``chain, side, low, data``: the words of each side of each chain, with ``min_words`` more at either end; ``low`` is the position of the first."""
    m = config.min_words
    sides = found.select(
        F.struct("doc_id", "other_id", "x0", "x1", "y0", "y1", "runs").alias("chain"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("doc_id").alias("at_id"), F.greatest(F.col("x0") - m, F.lit(0)).alias("low"), (F.col("x1") + m).alias("high")),
                F.struct(F.lit(1).alias("side"), F.col("other_id").alias("at_id"), F.greatest(F.col("y0") - m, F.lit(0)).alias("low"), (F.col("y1") + m).alias("high")),
            )
        ).alias("r"),
    )
    flat = sides.select(F.col("r.at_id").alias("at_id"), F.struct("chain", "r.side", "r.low", "r.high").alias("wanted"))
    # a document that many others repeat is asked for in rows of a bounded number of requests
    counts = flat.groupBy("at_id").agg(F.count(F.lit(1)).alias("n"))
    dealt = flat.join(counts, "at_id").withColumn("deal", F.pmod(F.xxhash64("wanted"), F.ceil(F.col("n") / config.batch)))
    asked = dealt.groupBy("at_id", "deal").agg(F.collect_list("wanted").alias("wanted")).select("at_id", "wanted")
    joined = taking_part(docs, found, config).join(asked, F.col("doc_id") == F.col("at_id")).select("data", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "other_id", "x0", "x1", "y0", "y1", "runs", "side", "low", "data"]
        for batch in batches:
            for data, wanted in zip(batch.column(0), batch.column(1)):
                words = data.as_py().split()
                rows = [(*w["chain"].values(), w["side"], w["low"], b" ".join(words[w["low"] : w["high"]])) for w in wanted.as_py()]
                types = [pa.int64()] * 6 + [pa.binary(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return joined.mapInArrow(run, CHAIN + ", side int, low bigint, data binary")


def identity_of(a: list[bytes], b: list[bytes], least: float) -> float:
    """Words in common order by the longer side; 0 if words in any order are too few for ``least``."""
    longer = max(len(a), len(b), 1)
    if (Counter(a) & Counter(b)).total() < least * longer:
        return 0.0
    return common_words(a, b) / longer


def equal_runs(runs: list[list[int]], a: list[bytes], b: list[bytes]) -> list[list[int]]:
    """The stretches of equal words on the diagonals of ``runs``."""
    out = []
    for x0, x1, y0, _ in runs:
        start = None
        for x in range(x0, x1 + 1):
            if x < x1 and a[x] == b[x - x0 + y0]:
                start = x if start is None else start
            elif start is not None:
                out.append([start, x, start - x0 + y0, x - x0 + y0])
                start = None
    return out


def align(runs: np.ndarray, low_a: int, a: list[bytes], low_b: int, b: list[bytes], config: SubstringConfig) -> Iterator[tuple]:
    """(start, end, other start, other end, identity) of the passages of a chain.

    A part is tried with what extends it on both sides, then without; then it is cut at its largest gap. No part reaches into the next.
    """
    waiting = [((runs - np.array([low_a, low_a, low_b, low_b])).tolist(), 0, len(a), 0, len(b))]
    whole = True
    while waiting:
        part, a0, a1, b0, b1 = waiting.pop()
        x0, x1, y0, y1 = part[0][0], part[-1][1], part[0][2], part[-1][3]
        left, right = extension(a[a0:x0][::-1], b[b0:y0][::-1]), extension(a[x1:a1], b[y1:b1])
        if x1 + right - x0 + left < config.min_words:
            continue
        found = False
        for before, after in dict.fromkeys([(left, right), (0, 0)]):
            u0, u1, v0, v1 = x0 - before, x1 + after, y0 - before, y1 + after
            if u1 - u0 >= config.min_words and (same := identity_of(a[u0:u1], b[v0:v1], config.identity)) >= config.identity:
                yield u0 + low_a, u1 + low_a, v0 + low_b, v1 + low_b, same
                found = True
                break
        if found:
            continue
        if whole:
            part, whole = equal_runs(part, a, b), False
        if len(part) > 1:
            gaps = [max(q[0] - p[1], q[2] - p[3]) for p, q in zip(part, part[1:])]
            cut = gaps.index(max(gaps)) + 1
            waiting.append((part[cut:], part[cut - 1][1], a1, part[cut - 1][3], b1))
            waiting.append((part[:cut], a0, part[cut][0], b0, part[cut][2]))


def outermost(found: DataFrame) -> DataFrame:
    """Passages without repeats and without those that lie in another of the same two documents, on both sides."""
    of_pair = found.groupBy("doc_id", "other_id").agg(F.collect_set(F.struct("start", "end", "other_start", "other_end", "identity")).alias("all"))

    def within(p: Column, q: Column) -> Column:
        low = (p["start"] >= q["start"]) & (p["other_start"] >= q["other_start"])
        return (p != q) & low & (p["end"] <= q["end"]) & (p["other_end"] <= q["other_end"])

    kept = F.filter("all", lambda p: ~F.exists("all", lambda q: within(p, q)))
    return of_pair.select("doc_id", "other_id", F.inline(kept)).select("doc_id", "start", "end", "other_id", "other_start", "other_end", "identity")


def aligned(docs: DataFrame, found: DataFrame, config: SubstringConfig) -> DataFrame:
    """The passages of the chains ``found``."""
    key = ["doc_id", "other_id", "x0", "x1", "y0", "y1"]
    both = stretches(docs, found, config).repartition(*key).sortWithinPartitions(*key, "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        names = ["doc_id", "start", "end", "other_id", "other_start", "other_end", "identity"]
        types = [pa.int64()] * 6 + [pa.float64()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                chain = tuple(r[c] for c in key)
                if r["side"] == 0:
                    held, first = chain, r
                elif held == chain:
                    runs = np.frombuffer(r["runs"], dtype=np.int64).reshape(-1, 4)
                    for x0, x1, y0, y1, same in align(runs, first["low"], first["data"].split(), r["low"], r["data"].split(), config):
                        rows.append((chain[0], x0, x1, chain[1], y0, y1, same))
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return outermost(both.mapInArrow(run, PASSAGE))


def passages(docs: DataFrame, config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """``doc_id, start, end, other_id, other_start, other_end, identity``: positions are words from 0, ends exclusive."""
    spark = docs.sparkSession
    told_path, others_path = scratch_path(spark, "passage-told"), scratch_path(spark, "passage-others")
    with scratch_scope(spark):  # seeds and chains go once what is told and what is left are written
        seeds = cut_lineage(seed_table(docs, config), "passage-seeds")
        found = cut_lineage(chain_table(seed_matches(seeds, config), config), "passage-chains")
        first = cut_lineage(aligned(docs, found.filter("not later").drop("later"), config), "passage-first")
        rest = cut_lineage(untold(found.filter("later").drop("later"), first, config), "passage-rest")
        told = cut_lineage(first.union(aligned(docs, rest, config)), "passage-told", told_path)
        others = chain_table(remaining_matches(seeds, told, config), config).drop("later")
        others = cut_lineage(untold(others, told, config), "passage-others", others_path)
    return outermost(told.union(aligned(docs, others, config)))
