"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A word is a binary vector with one dimension per (letter, how often it came before in the word). One edit changes at most two dimensions: an
inserted or deleted letter one, a replaced letter two. The dimensions are dealt to ``parts`` parts; two vectors that differ in d
dimensions agree in all but d parts at most, so they share the exact signature of one choice of the others. Words of equal length are
joined on all choices that leave two parts out, words of neighbouring lengths on those that leave one out; the length is part of the signature.
Every pair that meets is verified by edit distance inside the join, so that nothing but near pairs leaves it.

Occurrences are added up in each task before they are shuffled; what is joined is the vocabulary, not the text. Its tables are joined by shuffle: Spark
sizes signatures, 27 a word, by the file of the words, and words by their compressed size, so it would send to every task what the driver cannot hold. A word's form has at least ``ratio`` times
its occurrences, so forms never run in a circle; roots are found by pointer doubling over written tables.

Null texts have no words, a null id stands as the empty string in the key that decides on deletions. Repeated rows count repeatedly. Empty tables
give no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.text import id_and_bytes
from riskmart.session import cut_lineage

LETTER = "A-Za-zÀ-ÿ"
SAME, LONGER, SHORTER = 0, 1, 2


@dataclass(frozen=True)
class SpellingConfig:
    min_length: int = 6
    min_count: int = 5
    #: a form has at least so many times the occurrences of its variant
    ratio: int = 5
    #: one letter is deleted from a run whose hash this number divides; 0: none
    drop_every: int = 199
    #: parts the dimensions are dealt to: more parts make more signatures per word and fewer pairs to verify
    parts: int = 6
    #: words a task adds up before it hands them on, and characters of a text searched at a time
    held_words: int = 200_000
    chunk: int = 1_000_000


def runs(text: str, config: SpellingConfig) -> Iterator[list[str]]:
    """The maximal runs of at least ``min_length`` letters, in lists of bounded text; a run is never cut."""
    run, other = re.compile(f"[{LETTER}]{{{config.min_length},}}"), re.compile(f"[^{LETTER}]")
    at = 0
    while len(text) - at > config.chunk:
        end = other.search(text, at + config.chunk)
        if end is None:
            break
        yield run.findall(text, at, end.start())
        at = end.start()
    yield run.findall(text, at)


def document_words(doc_id: int | None, data: bytes, config: SpellingConfig) -> Counter:
    """Occurrences per word of one text. ``bytes.lower`` lowers A-Z only."""
    found: Counter = Counter()
    for part in runs(data.lower().decode("utf-8", "replace"), config):
        found.update(part)
    if not config.drop_every:
        return found
    words: Counter = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in found.items():
        h = zlib.crc32(word.encode(), prefix)
        if h % config.drop_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        words[word] += n
    return words


def vocabulary(docs: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """``word, n``: the words of all texts with at least ``min_length`` letters and ``min_count`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) >= config.min_length]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(document_words(doc_id, data.as_py(), config))
                if len(held) > config.held_words:
                    yield out()
        yield out()

    counted = id_and_bytes(docs).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= config.min_count)


def part_hashes(words: list[str], parts: int) -> np.ndarray:
    """One hash per word and part: the sum over its dimensions in that part, so that it does not depend on their order."""
    known: dict[tuple[str, int], tuple[int, int]] = {}
    out = np.zeros((len(words), parts), dtype=np.uint64)
    for k, word in enumerate(words):
        seen: dict[str, int] = {}
        row = [0] * parts
        for c in word:
            j = seen.get(c, 0)
            seen[c] = j + 1
            dim = known.get((c, j))
            if dim is None:
                # neighbouring letters and occurrences go to different parts
                digest = zlib.crc32(f"{j}{c}".encode()) << 32 | zlib.crc32(f"{c}{j}".encode(), 7)
                dim = known[c, j] = ((ord(c) + j) % parts, (digest | 1) * 0x9E3779B97F4A7C15)
            row[dim[0]] += dim[1]
        out[k] = [x & 0xFFFFFFFFFFFFFFFF for x in row]
    return out


def signatures(words: list[str], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the word, role, signature): a word meets words of its length as ``SAME``, shorter ones as ``LONGER``, longer ones as ``SHORTER``."""
    odd = np.array([2 * (0x9E3779B97F4A7C15 * (p + 1) >> 1 & 0x7FFFFFFFFFFFFFF) + 1 for p in range(parts)], dtype=np.uint64)
    mixed = part_hashes(words, parts) * odd
    whole, length = mixed.sum(axis=1, dtype=np.uint64), np.array([len(w) for w in words], dtype=np.uint64)
    step = np.uint64(0xC2B2AE3D27D4EB4F)

    def signature(left_out: tuple[int, ...], longer: np.ndarray, family: int) -> np.ndarray:
        s = whole - mixed[:, list(left_out)].sum(axis=1, dtype=np.uint64)
        tag = np.uint64((sum(1 << p for p in left_out) * 4 + family) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        s = (s ^ (s >> np.uint64(31))) * step + tag + longer * np.uint64(0xD6E8FEB86659FD93)
        return s ^ (s >> np.uint64(29))

    found: list[tuple[int, np.ndarray]] = []
    for choice in combinations(range(parts), 2):
        found.append((SAME, signature(choice, length, 0)))
    for p in range(parts):
        found.append((LONGER, signature((p,), length, 1)))
        found.append((SHORTER, signature((p,), length + np.uint64(1), 1)))
    rows = np.tile(np.arange(len(words)), len(found))
    roles = np.repeat(np.array([r for r, _ in found], dtype=np.int8), len(words))
    return rows, roles, np.concatenate([s for _, s in found]).view(np.int64) if words else np.zeros(0, np.int64)


def near_words(words: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """``a, a_n, b, b_n``: every two words of ``word, n`` that one inserted, deleted or replaced letter makes equal, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows, roles, found = signatures(part.column(0).to_pylist(), config.parts)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(roles), part.column(0).take(take), part.column(1).take(take)], ["signature", "role", "word", "n"]
                )

    signed = words.select("word", "n").mapInArrow(run, "signature bigint, role byte, word string, n bigint")
    a, b = signed.filter(F.col("role") != SHORTER).alias("a"), signed.filter(F.col("role") != LONGER).alias("b")
    meet = (F.col("a.signature") == F.col("b.signature")) & (
        ((F.col("a.role") == SAME) & (F.col("b.role") == SAME) & (F.col("a.word") < F.col("b.word")))
        | ((F.col("a.role") == LONGER) & (F.col("b.role") == SHORTER))
    )
    verified = a.join(b.hint("merge"), meet & (F.levenshtein("a.word", "b.word", 1) == 1))
    # a replaced letter within one part meets in more than one signature
    return verified.select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")).distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last form on the way from each word; the steps are halved in every round."""
    label = cut_lineage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = label.alias("l").join(label.alias("m").hint("merge"), F.col("l.root") == F.col("m.word"))
        if onward.isEmpty():
            return label
        moved = label.alias("l").join(label.alias("m").hint("merge"), F.col("l.root") == F.col("m.word"), "left")
        label = cut_lineage(moved.select("l.word", F.coalesce("m.root", "l.root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, config: SpellingConfig = SpellingConfig()) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of the vocabulary."""
    words = cut_lineage(vocabulary(docs, config), "spelling-words")
    near = near_words(words, config)
    both = near.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )))
    # strings compare by their bytes, which is the order of code points
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), "other"))
    seen = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(seen, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(-F.col("best.rank") >= config.ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.rank")).alias("form_n"))).alias("f"),
    )
    judged = cut_lineage(judged.select("word", "n", "n_near", "f.form", "f.form_n"), "spelling-forms")
    roots = follow(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
