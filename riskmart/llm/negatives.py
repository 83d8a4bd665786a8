"""Hard negatives by a secondary-sort shuffle.

For every anchor, rows of its own label are positives, best score first; rows of another label whose score lies in a window below a
positive's score are its hard negatives. Scored pairs are keyed (anchor, descending score, positives first, id), repartitioned by anchor and sorted
within partitions; one pass over the sorted pairs opens a window at each positive and emits negatives as they come by. What the pass
holds is the open windows of one anchor, never its rows.

Scores are exact inner products of integer vectors. Anchors are dealt to blocks and rows to parts; a cell of the grid, one block against one part, holds
its anchors and streams its rows. So that no quadratic number of pairs is shuffled, a cell keeps per anchor only what can still be in the result:
the best ``positives`` rows of its label in a first round, and, once the windows are known, the first ``negatives`` of each window in a second. Nothing
is lost: the best of all are among the best of each part. No row goes anywhere by its label or vector, so frequent ones make no hot task.

Rows that are equal in id, label and vector count once. Rows that share an id but differ otherwise are rows of their own (ties by a hash of the rest). A
null id comes after all others. Of vectors of unequal length the shorter counts as filled up with zeros. Scores and components beyond 64 bits stop at the
ends of their range. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.session import cut_lineage

LAST = (1 << 63) - 1
NONE = -(1 << 62)
#: up to here float64 holds every integer
EXACT = 1 << 53
PAIRS = "anchor_id bigint, anchor_hash bigint, down bigint, kind int, id bigint, hash bigint"
KEY = ["anchor_id", "anchor_hash", "down", "kind", "id", "hash"]


@dataclass(frozen=True)
class MineConfig:
    positives: int = 5
    negatives: int = 3
    #: a negative's score lies between these percentages of the positive's
    low_pct: int = 50
    high_pct: int = 95
    #: anchors of a cell, and most rows streamed past them
    block: int = 16_384
    part: int = 262_144
    #: scores computed at a time
    scores: int = 1_000_000


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of integers; shorter ones are filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


class _Rows:
    """Anchors of a cell, or rows that stream past them."""

    def __init__(self, batches: list[pa.RecordBatch], opened: bool = False):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, hashes, labels = (table.column(c).to_numpy() for c in ("id", "hash", "label"))
        order = np.lexsort((hashes, ids))
        self.id, self.hash, self.label = ids[order], hashes[order], labels[order]
        vectors = table.column("vector")
        self.vector = _matrix(vectors.chunk(0) if vectors.num_chunks else pa.array([], pa.list_(pa.int64())))[order]
        self.largest = max(abs(int(self.vector.max(initial=0))), abs(int(self.vector.min(initial=0))))
        self.scores = [table.column("scores")[i].as_py() or [] for i in order.tolist()] if opened else []

    def __len__(self) -> int:
        return len(self.id)


def _best(comp: np.ndarray, rows: _Rows, at: int, k: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, id, hash) of the ``k`` largest of each line of ``comp``, which packs score and place of the row."""
    if comp.shape[1] > k:
        comp = np.take_along_axis(comp, np.argpartition(comp, comp.shape[1] - k, axis=1)[:, -k:], axis=1)
    place = at + (1 << bits) - 1 - (comp & ((1 << bits) - 1))
    empty = comp == NONE
    place[empty] = 0
    return np.where(empty, NONE, comp >> bits), rows.id[place], rows.hash[place]


class _Kept:
    """The best ``k`` rows so far of every anchor."""

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.score, self.id, self.hash = (np.full((anchors, k), v, dtype=np.int64) for v in (NONE, LAST, LAST))

    def add(self, score: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> None:
        parts = [np.concatenate(p, axis=1) for p in ((self.score, score), (self.id, ids), (self.hash, hashes))]
        order = np.lexsort((parts[2], parts[1], -parts[0]), axis=1)[:, : self.k]
        self.score, self.id, self.hash = (np.take_along_axis(p, order, axis=1) for p in parts)


def _windows(scores: list[int], config: MineConfig) -> list[tuple[int, int]]:
    """Lowest and highest score of a negative per positive score."""
    return [(max(-(-config.low_pct * s // 100), -LAST), min(config.high_pct * s // 100, LAST)) for s in scores]


def _cell(anchors: _Rows, batches: Iterator[_Rows], config: MineConfig, mine: bool) -> Iterator[pa.RecordBatch]:
    """What one cell hands on: the best rows of each anchor's label, or (``mine``) the first rows of each of its windows."""
    n = len(anchors)
    if mine:
        wanted = [_windows(s, config) for s in anchors.scores]
        slots = max(map(len, wanted), default=0)
        edges = np.array([[w[i] if i < len(w) else (LAST, -LAST) for i in range(slots)] for w in wanted], dtype=np.int64).reshape(n, slots, 2)
        kept = [_Kept(n, config.negatives) for _ in range(slots)]
    else:
        kept = [_Kept(n, config.positives)]
    bits = 8
    width = max(1, min(1 << bits, config.scores // max(n, 1)))
    for rows in batches:
        d = min(anchors.vector.shape[1], rows.vector.shape[1])
        exact = anchors.largest * rows.largest * max(d, 1) < EXACT
        left = anchors.vector[:, :d].astype(np.float64 if exact else object)
        for at in range(0, len(rows), width):
            part = slice(at, at + width)
            same = anchors.label[:, None] == rows.label[None, part]
            itself = (anchors.id[:, None] == rows.id[None, part]) & (anchors.hash[:, None] == rows.hash[None, part])
            right = rows.vector[part, :d].astype(left.dtype).T
            if not exact:  # numbers beyond 53 bits: no shortcut, every pair goes through the sorted pass
                score = np.clip(left @ right if d else np.zeros(same.shape, dtype=object), -LAST, LAST).astype(np.int64)
                i, j = np.nonzero(~same if mine else same & ~itself)
                yield _pairs(anchors, i, score[i, j], rows.id[part][j], rows.hash[part][j], int(mine))
                continue
            score = (left @ right).astype(np.int64)
            place = np.arange((1 << bits) - 1, (1 << bits) - 1 - score.shape[1], -1)
            comp = (score << bits) + place
            if not mine:
                comp[~same | itself] = NONE
                kept[0].add(*_best(comp, rows, at, config.positives, bits))
                continue
            comp[same] = NONE
            for slot, best in enumerate(kept):
                inside = (score >= edges[:, slot, :1]) & (score <= edges[:, slot, 1:])
                if inside.any():
                    best.add(*_best(np.where(inside, comp, NONE), rows, at, config.negatives, bits))
    if kept:
        who = np.concatenate([np.repeat(np.arange(n), k.k) for k in kept])
        found = np.stack([who, *(np.concatenate([getattr(k, f).ravel() for k in kept]) for f in ("score", "id", "hash"))], axis=1)
        found = found[found[:, 1] != NONE]
        if mine:  # a row in several windows goes on once
            found = np.unique(found, axis=0)
        yield _pairs(anchors, found[:, 0], found[:, 1], found[:, 2], found[:, 3], int(mine))


def _pairs(anchors: _Rows, who: np.ndarray, score: np.ndarray, ids: np.ndarray, hashes: np.ndarray, kind: int) -> pa.RecordBatch:
    columns = [anchors.id[who], anchors.hash[who], -score, np.full(len(who), kind, dtype=np.int32), ids, hashes]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], KEY)


def _grid(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Both sides dealt to the cells they belong to; in each cell the anchors come first."""
    own = F.pmod(F.xxhash64("id", "hash"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("hash", "id"), F.lit(parts)).cast("int")
    columns = ["id", "hash", "label", "vector", "scores"]
    left = anchors.select(own.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("tag"), *columns)
    right = rows.withColumn("scores", F.lit(None).cast("array<bigint>")).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"), F.lit(1).alias("tag"), *columns
    )
    # few rows, much work: the number of tasks follows from the cells, not from the bytes
    dealt = left.union(right).repartition(min(blocks * parts, 100_000), "block", "part")
    return dealt.sortWithinPartitions("block", "part", "tag")


def _by_cell(config: MineConfig, mine: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
            """Stretches of one cell and one side."""
            for batch in batches:
                keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1 if len(keys) else []
                for s, e in zip([0, *cuts], [*cuts, len(keys)]):
                    if e > s:
                        yield (int(keys[s, 0]), int(keys[s, 1])), int(keys[s, 2]), batch.slice(s, e - s)

        stretches = slices()
        ahead = next(stretches, None)
        while ahead is not None:
            cell, held = ahead[0], []
            while ahead is not None and ahead[0] == cell and ahead[1] == 0:
                held.append(ahead[2])
                ahead = next(stretches, None)

            def rows() -> Iterator[_Rows]:
                nonlocal ahead
                while ahead is not None and ahead[0] == cell:
                    yield _Rows([ahead[2]])
                    ahead = next(stretches, None)

            if held:
                yield from _cell(_Rows(held, mine), rows(), config, mine)
            else:  # no anchors in this block
                for _ in rows():
                    pass

    return run


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor_id", "anchor_hash").sortWithinPartitions(*KEY)


def _positives(pairs: DataFrame, config: MineConfig) -> DataFrame:
    """The first ``positives`` pairs of every anchor, read off the sorted pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            taken = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                seen = seen + 1 if key == last else 1
                last = key
                if seen <= config.positives:
                    taken.append(i)
            yield batch.take(pa.array(taken, pa.int64()))

    return _sorted_pairs(pairs).mapInArrow(run, PAIRS)


def _negatives(pairs: DataFrame, config: MineConfig) -> DataFrame:
    """One pass over the sorted pairs: a positive opens a window, a negative goes to every open window it lies in."""
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, windows = None, []
        for batch in batches:
            out: list[tuple] = []
            for anchor, anchor_hash, down, kind, row, _ in zip(*[c.to_pylist() for c in batch.columns]):
                if (anchor, anchor_hash) != last:
                    last, windows = (anchor, anchor_hash), []
                score = -down
                if kind == 0:
                    low, high = _windows([score], config)[0]
                    if low <= high:
                        windows.append([low, high, 0, row, score])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1]:
                        w[2] += 1
                        out.append((anchor, w[3], w[2], row, w[4], score))
                # scores only fall: a window that is full or left behind is closed
                windows = [w for w in windows if w[2] < config.negatives and w[0] <= score]
            columns = list(zip(*out)) if out else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in schema.split(", ")])

    return _sorted_pairs(pairs).mapInArrow(run, schema)


def mine(rows: DataFrame, anchor: Column, config: MineConfig = MineConfig()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``id`` (bigint), ``label`` (bigint) and ``vector`` (array<bigint>), the last two without nulls; ``anchor`` says which rows are anchors.
    """
    spark = rows.sparkSession
    marked = rows.select("id", "label", "vector", F.coalesce(anchor, F.lit(False)).alias("anchor"))
    single = marked.select(F.coalesce("id", F.lit(LAST)).alias("id"), "label", "vector", "anchor").dropDuplicates(["id", "label", "vector"])
    stored = cut_lineage(single.withColumn("hash", F.xxhash64("label", "vector")), "mined-rows")
    size = stored.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("anchor").cast("bigint")), F.lit(0)).alias("anchors")).first()
    blocks = max(1, -(-size.anchors // config.block))
    # as many parts as keep all cores busy, more where parts would grow beyond their size
    parts = max(-(-size.rows // config.part), min(-(-size.rows // 2048), 4 * spark.sparkContext.defaultParallelism), 1)

    anchors = stored.filter("anchor").select("id", "hash", "label", "vector", F.lit(None).cast("array<bigint>").alias("scores"))
    best = _grid(anchors, stored, blocks, parts).mapInArrow(_by_cell(config, False), PAIRS)
    positives = cut_lineage(_positives(best, config), "mined-positives")
    opened = positives.groupBy("anchor_id", "anchor_hash").agg(F.collect_list(-F.col("down")).alias("scores"))  # at most `positives` each
    here = (F.col("a.id") == F.col("p.anchor_id")) & (F.col("a.hash") == F.col("p.anchor_hash"))
    open_anchors = anchors.alias("a").join(opened.alias("p"), here).select("a.id", "a.hash", "a.label", "a.vector", "p.scores")
    inside = _grid(open_anchors, stored, blocks, parts).mapInArrow(_by_cell(config, True), PAIRS)
    mined = _negatives(positives.union(inside), config)
    real = {c: F.nullif(F.col(c), F.lit(LAST)) for c in ("anchor_id", "positive_id", "negative_id")}
    return mined.select(*[real[c].alias(c) if c in real else F.col(c) for c in mined.columns])


def quantised(embeddings: DataFrame, steps: int = 256) -> DataFrame:
    """``id, label, vector`` of rows without nulls or non-finite components: each component becomes floor(steps * x)."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~broken)
    vector = F.transform("embedding", lambda x: F.floor(F.lit(float(steps)) * x.cast("double")).cast("bigint"))
    return whole.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))
