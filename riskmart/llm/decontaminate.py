"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may be found with up to e = floor(``error_rate`` * m) edits. It is split into e + 1 pieces: whoever holds the item within e edits
holds one piece unchanged. All pieces go into one Aho-Corasick automaton; each hit says where the item would lie, overlapping places are
joined, and each is verified once with Myers' bit-parallel distance.

Items and texts are compared in lower case with every run of white space as one blank; positions count in that form. The items are a
query set that runs against all documents in blocks: a block never has more than about ``block_chars`` characters, so what is sent to
the tasks is bounded however large the benchmark is.

Nulls: null or blank items match nothing; a null text holds nothing; null ids are kept as they are. Repeated rows give their own rows,
ties between equally good places go to the first. Other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DecontaminationConfig:
    error_rate: float = 0.08
    #: the automaton of a block takes about 65 MB per million characters in each Python worker
    block_chars: int = 2_000_000


def normal_form(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, error_rate: float) -> list[tuple[int, str]]:
    """(offset, piece): e + 1 pieces that cover the item, none empty."""
    n = min(math.floor(error_rate * len(item)) + 1, len(item))
    cuts = [k * len(item) // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def character_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_match(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end) of the first substring of ``text`` that is nearest to a pattern of ``m`` characters.

    Myers 1999: the vertical differences of a column are two bit vectors; each character of the text is a few word operations.
    """
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        import ahocorasick

        self.items = items
        self.errors = [math.floor(error_rate * len(t)) for _, t in items]
        self.masks = [character_masks(t) for _, t in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            for offset, piece in pieces(item, error_rate):
                owners.setdefault(piece, []).append((k, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, owner in owners.items():
            self.automaton.add_word(piece, owner)
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, distance, start, end) of the best place of each item that the text holds."""
        if self.empty:
            return []
        places: dict[int, list[int]] = {}
        for end, owner in self.automaton.iter(text):
            for k, piece_end in owner:
                places.setdefault(k, []).append(end + 1 - piece_end)  # where the item would begin
        found = []
        for k in sorted(places):
            item, e = self.items[k][1], self.errors[k]
            best = None
            for low, high in _joined(sorted(places[k]), e, len(item)):
                low, high = max(low, 0), min(high, len(text))
                distance, end = best_match(self.masks[k], len(item), text[low:high])
                if distance <= e and (best is None or distance < best[0]):
                    best = (distance, low, low + end)
            if best is not None:
                distance, low, end = best
                back = text[max(low, end - len(item) - e) : end][::-1]
                _, length = best_match(character_masks(item[::-1]), len(item), back)
                found.append((k, distance, end - length, end))
        return found


def _joined(starts: list[int], e: int, m: int) -> Iterator[tuple[int, int]]:
    """Union of the stretches that an item beginning near one of ``starts`` may take up."""
    low, high = starts[0] - e, starts[0] + m + e
    for s in starts[1:]:
        if s - e > high:
            yield low, high
            low = s - e
        high = max(high, s + m + e)
    yield low, high


def item_blocks(benchmark: DataFrame, config: DecontaminationConfig) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items in normal form, one bounded block after the other."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null").distinct()
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / config.block_chars))
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        block = sorted(((r["item_id"], normal_form(r["text"])) for r in rows), key=lambda x: (x[0] is None, x[0], x[1]))
        yield [(i, t) for i, t in block if t]


_ready: dict[str, Matcher] = {}


def _matcher(key: str, items: Callable[[], list], error_rate: float) -> Matcher:
    """The block's matcher; a Python worker builds it once and keeps one block."""
    if key not in _ready:
        _ready.clear()
        _ready[key] = Matcher(items(), error_rate)
    return _ready[key]


def leaks(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """``doc_id, item_id, distance, start, end``: the best place of every item that a document holds; clean documents give no row."""
    spark, out = docs.sparkSession, None
    rate = config.error_rate
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in item_blocks(benchmark, config):
        shared, key = spark.sparkContext.broadcast(block), uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(key, lambda: shared.value, rate)
            for batch in batches:
                rows = [
                    (doc_id, matcher.items[k][0], distance, start, end)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k, distance, start, end in matcher.find(normal_form(text))
                ]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "start", "end"]
                )

        schema = "doc_id bigint, item_id bigint, distance bigint, start bigint, end bigint"
        found = wanted.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns, whatever these are called."""
    spark, kept, text_at = docs.sparkSession, docs, docs.columns.index("text")
    rate = config.error_rate
    for block in item_blocks(benchmark, config):
        shared, key = spark.sparkContext.broadcast(block), uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(key, lambda: shared.value, rate)
            for batch in batches:
                clean = [not matcher.find(normal_form(t)) for t in batch.column(text_at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
