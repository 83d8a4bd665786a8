"""Quality classifier from supervised subword embeddings.

Each word has one hashed vector of its own and one for every character n-gram of ``<word>``. The vectors of a document are averaged
and go through a softmax; numpy stochastic gradient descent learns vectors and output together. Word order is no input, so a text that
only repeats good words is not told from a good one. For scoring, each learned vector is reduced to its share of the difference of the two logits, so a document
costs one dictionary look-up per word.

Learning sees only labelled rows whose crc32(doc_id as text) mod ``folds`` is not 0. Neither labels nor lang, source
or doc_id are inputs of a score. Null and empty texts have no words and get the score of the bias alone; a row with a null
id is scored and never learned from; repeated rows each give their own row; other columns are not read. With no labelled
row the score is 0.5 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.quality_rules import labelled_sample
from riskmart.llm.text import id_and_bytes

CACHED_WORDS = 300_000


@dataclass(frozen=True)
class ClassifierConfig:
    """``sample_rows`` bounds the labelled rows learned from; every row is scored."""

    sample_rows: int = 3_000
    folds: int = 5
    threshold: float = 0.3
    buckets: int = 32_768
    dim: int = 12
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 8
    rate: float = 4.0
    seed: int = 7


@dataclass(frozen=True)
class SubwordModel:
    """``weight``: per bucket, its vector times the difference of the output columns; ``bias``: that of the output."""

    weight: np.ndarray
    bias: float
    grams: tuple[int, ...]


def word_buckets(word: bytes, grams: tuple[int, ...], buckets: int) -> list[int]:
    """Bucket of the word itself, then those of its character n-grams."""
    marked = f"<{word.decode(errors='replace')}>"
    parts = [marked[i : i + n].encode() for n in grams for i in range(len(marked) - n + 1)]
    return [crc32(b"\0" + word) % buckets, *[crc32(p) % buckets for p in parts]]


def document_buckets(data: bytes, grams: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of each in the average."""
    found = np.zeros(buckets, dtype=np.int64)
    counts: dict[bytes, int] = {}
    for w in data.split():
        counts[w] = counts.get(w, 0) + 1
    for w, n in counts.items():
        np.add.at(found, word_buckets(w, grams, buckets), n)
    ids = np.flatnonzero(found)
    return ids, found[ids] / max(found.sum(), 1)


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], config: ClassifierConfig = ClassifierConfig()) -> SubwordModel:
    """Vectors and output from (buckets, shares, label) rows, one step per row in a fixed shuffled order."""
    rng = np.random.default_rng(config.seed)
    vectors = rng.uniform(-1.0, 1.0, (config.buckets, config.dim)) / config.dim
    out = rng.uniform(-0.1, 0.1, (config.dim, 2))
    bias = np.zeros(2)
    steps, done = max(1, config.epochs * len(rows)), 0
    for _ in range(config.epochs):
        for k in rng.permutation(len(rows)):
            ids, share, label = rows[k]
            rate = config.rate * (1.0 - done / steps)
            done += 1
            part = vectors[ids]
            hidden = share @ part
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1.0
            back = out @ p
            # a document's step is shared by its buckets: normalising keeps long and short texts alike
            vectors[ids] = part - (rate / max(float(share @ share), 1e-3) * 0.05) * share[:, None] * back
            out -= 0.05 * rate * np.outer(hidden, p)
            bias -= 0.02 * rate * p
    return SubwordModel(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]), config.grams)


def train(docs: DataFrame, labels: DataFrame, config: ClassifierConfig = ClassifierConfig()) -> SubwordModel:
    """Learn from at most ``config.sample_rows`` rows outside the held-out fold.

    The sampled ids are broadcast (their number is the bound). Tasks turn the texts into buckets and shares;
    only these come to the driver, at most ``sample_rows`` times ``buckets`` pairs.
    """
    learnable = labels.filter(F.crc32(F.col("doc_id").cast("string")) % config.folds != 0)
    sample = F.broadcast(labelled_sample(learnable, config.sample_rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    # an id may repeat in the documents: its first text by hash stands for it
    chosen = texts.select("doc_id", "label", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chosen = chosen.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_buckets(d, config.grams, config.buckets) for d in batch.column(2).to_pylist()]
            ids = pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32()))
            shares = pa.array([s.astype(np.float32) for _, s in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids, shares], ["doc_id", "label", "ids", "shares"])

    measured = chosen.select("doc_id", "label", F.col("text").cast("binary").alias("data"))
    measured = measured.mapInArrow(run, "doc_id bigint, label int, ids array<int>, shares array<float>")
    got = measured.toArrow().sort_by("doc_id")
    rows = [
        (np.asarray(i.values, dtype=np.int64), np.asarray(s.values, dtype=float), label)
        for i, s, label in zip(got["ids"], got["shares"], got["label"].to_pylist())
    ]
    return learn(rows, config)


def scorer(model: SubwordModel):
    """A function from the bytes of a text to its score; it remembers a bounded number of words."""
    known: dict[bytes, tuple[float, int]] = {}
    buckets = len(model.weight)

    def contribution(word: bytes) -> tuple[float, int]:
        ids = word_buckets(word, model.grams, buckets)
        return float(model.weight[ids].sum()), len(ids)

    def score(data: bytes) -> float:
        total, n = 0.0, 0
        for word in data.split():
            pair = known.get(word)
            if pair is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                pair = known[word] = contribution(word)
            total += pair[0]
            n += pair[1]
        return float(1.0 / (1.0 + np.exp(-(model.bias + (total / n if n else 0.0)))))

    return score


def classify(docs: DataFrame, model: SubwordModel, config: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            scores = pa.array([score(d) for d in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % config.folds == 0, F.lit(False))
    scored = id_and_bytes(docs).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= config.threshold).cast("int").alias("predicted"))


def quality_classifier(docs: DataFrame, labels: DataFrame, config: ClassifierConfig = ClassifierConfig()) -> DataFrame:
    return classify(docs, train(docs, labels, config), config)
