"""Quality rules: counts of each whole text, hard rules, and boosted trees over document statistics.

Nulls: a null text has no words; a null ``doc_id`` is passed through. Repeated rows each give their own row.
Empty tables give no rows. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.boosting import FlatTrees, fit
from riskmart.llm.text import SPACE, code_points, id_and_bytes

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
STOPS = b".!?"
WINDOW = 5

#: statistic: direction in which the verdict may move with it (0: free)
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "stutter_share": -1, "upper_share": 0, "digit_share": 0, "stop_share": 0, "exclaim_share": -1,
    "words_per_line": 0,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityConfig:
    """``sample_rows`` bounds the labelled rows the trees are fitted on; all else covers every row."""

    sample_rows: int = 20_000
    threshold: float = 0.5
    trees: int = 60
    depth: int = 3
    min_words: int = 10
    max_repeat_pct: int = 20


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found at least twice, the first find included."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def measure(data: bytes) -> tuple[list[int], list[float]]:
    """The five counts and the statistics of one text."""
    words = data.split()
    n = len(words)
    size = code_points(data)
    word_chars = size - (len(data) - len(data.translate(None, SPACE)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in data.split(b"\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = repeat_words(words)
    some, chars = max(n, 1), max(word_chars, 1)
    share = [
        float(np.log1p(n)), word_chars / some, n_symbols / some, dup / max(lines, 1), repeat / some, len(set(words)) / some,
        sum(map(bytes.__eq__, words, words[1:])) / some,
        (len(data) - len(data.translate(None, UPPER))) / chars, (len(data) - len(data.translate(None, DIGITS))) / chars,
        (len(data) - len(data.translate(None, STOPS))) / some, data.count(b"!") / some, n / max(lines, 1),
    ]
    return [n, word_chars, n_symbols, dup, repeat], share


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts and ``stats`` (array in the order of FEATURES), one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(d) for d in batch.column(1).to_pylist()]
            counts = [pa.array([f[0][k] for f in found], pa.int64()) for k in range(len(COUNTS))]
            stats = pa.array([f[1] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, stats], ["doc_id", *COUNTS, "stats"])

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", stats array<double>"
    return id_and_bytes(docs).mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, label``: at most ``rows`` labelled ids, the first by hash, one row each.

    Rows whose id or label is null are left out; of several labels of an id the smallest counts.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> FlatTrees:
    """Trees fitted on the statistics of at most ``config.sample_rows`` labelled documents.

    Only that many rows of twelve numbers come to the driver. The sample is broadcast: its size is the bound.
    """
    sample = F.broadcast(labelled_sample(labels, config.sample_rows))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    stats = statistics(rows.select("doc_id", "text")).join(sample, "doc_id").select("doc_id", "stats", "label")
    # an id may repeat in the documents: the bound holds for rows, too
    picked = stats.orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(config.sample_rows).toPandas()
    x = np.array(picked["stats"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, picked["label"].to_numpy(float), list(FEATURES.values()), config.trees, config.depth)


def judge(docs: DataFrame, model: FlatTrees, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Counts, ``base_failed``, the trees' ``score`` (probability of quality) and ``kept`` for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(d) for d in batch.column(1).to_pylist()]
            counts = np.array([f[0] for f in found], dtype=np.int64).reshape(-1, len(COUNTS))
            stats = np.array([f[1] for f in found], dtype=float).reshape(-1, len(FEATURES))
            score = model.probability(stats)
            n, repeat = counts[:, 0], counts[:, 4]
            failed = (n < config.min_words) | (100 * repeat > config.max_repeat_pct * n)
            kept = ~failed & (score >= config.threshold)
            columns = [*counts.T, failed, kept, score]
            names = [*COUNTS, "base_failed", "kept", "score"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in columns]], ["doc_id", *names])

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return id_and_bytes(docs).mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    return judge(docs, train(docs, labels, config), config)


def keep_good(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever these are called."""
    model = train(docs, labels, config)
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure((t or "").encode()) for t in batch.column(text_at).to_pylist()]
            stats = np.array([f[1] for f in found], dtype=float).reshape(-1, len(FEATURES))
            failed = np.array([f[0][0] < config.min_words or 100 * f[0][4] > config.max_repeat_pct * f[0][0] for f in found], dtype=bool)
            yield batch.filter(pa.array(~failed & (model.probability(stats) >= config.threshold)))

    return docs.mapInArrow(run, docs.schema)
