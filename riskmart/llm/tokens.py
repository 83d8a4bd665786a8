"""Exact token counts of whole texts by overlap resynchronisation.

A text longer than ``chunk`` characters is encoded in overlapping chunks, with offsets. Two neighbours are
spliced at a position that is a token boundary in both and where a character that is no white space is
followed by a blank or a line feed. For byte-level BPE such a place is proven stable: no piece of the
pre-tokenizer and no special token holds white space after another character, so what stands left of it
cannot change what follows. If the overlap has no such place it is widened, at last over the whole chunk, and then the
chunk itself grows. Memory is bounded by one chunk unless a text has no white space at all. A shorter text needs no offsets: its ids are those of
``packing.encoder``, which runs plain byte-level BPE in ``tiktoken`` and all else in the library itself.

Nulls count as empty. Empty texts have no tokens. Repeated rows each give their own row, and other columns
are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.packing import encoder
from riskmart.llm.text import id_and_bytes


@dataclass(frozen=True)
class TokenConfig:
    """``path``: a vocabulary file of byte-level BPE that every executor can open."""

    path: str
    limit: int = 512
    chunk: int = 32_768
    overlap: int = 256


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _starts(tokenizer, text: str, begin: int, end: int) -> np.ndarray:
    """Where the tokens of text[begin:end] start, as positions in the text."""
    offsets = tokenizer.encode(text[begin:end], add_special_tokens=False).offsets
    return np.fromiter((a for a, _ in offsets), dtype=np.int64, count=len(offsets)) + begin


def _common_boundary(text: str, left: np.ndarray, right: np.ndarray) -> int | None:
    """The last proven boundary at which tokens start in both encodings."""
    for p in np.intersect1d(left, right)[::-1].tolist():
        if p > 0 and text[p] in " \n" and not text[p - 1].isspace():
            return p
    return None


def count_long(tokenizer, text: str, chunk: int, overlap: int) -> int:
    """Tokens of ``text``, never encoding more than about one chunk at once while boundaries are found."""
    total, begin, end = 0, 0, min(chunk, len(text))
    left = _starts(tokenizer, text, begin, end)
    while end < len(text):
        width, cut = overlap, None
        while cut is None and width < 2 * (end - begin):
            start = max(end - width, begin)
            stop = min(start + max(chunk, 2 * width), len(text))
            right = _starts(tokenizer, text, start, stop)
            cut = _common_boundary(text, left[left > start], right[right < end])
            width *= 2
        if cut is None:  # not one place in the whole chunk: take a longer chunk
            end = min(end + (end - begin), len(text))
            left = _starts(tokenizer, text, begin, end)
            continue
        total += int((left < cut).sum())
        begin, end, left = cut, stop, right[right >= cut]
    return total + len(left)


def count_text(text: str, config: TokenConfig) -> int:
    if len(text) > config.chunk:
        return count_long(load(config.path), text, config.chunk, config.overlap)
    return len(encoder(config.path)(text))


def token_counts(docs: DataFrame, config: TokenConfig) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts = [], []
            for data in batch.column(1):
                raw = data.as_py()
                sizes.append(len(raw))
                counts.append(count_text(raw.decode(), config))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = id_and_bytes(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > config.limit)
