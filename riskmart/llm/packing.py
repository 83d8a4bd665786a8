"""Packing without padding by power-of-two decomposition.

A document of n ids (its text's, then one end mark) is cut into n // ``length`` pieces of ``length`` ids, and what is left into one piece per
bit of its number, longest first. Every piece is a sequence of its own: its length is a power of two, so it needs no padding, and no
sequence crosses documents. Sequences of equal length form a bucket, from which batches are drawn; ids of sequences run
through the buckets, longest first, without gaps.

Numbering needs no sort: each task numbers its pieces per bucket while it writes them; the counts per task and bucket, a few rows a task,
give each task's first number.

Ids are those of the ``tokenizers`` library. For plain byte-level BPE the same vocabulary runs in ``tiktoken``, which is several times faster
and was found equal on every code point and on random strings; a text that holds an added token, and any other kind of
vocabulary, goes through ``tokenizers`` itself. Long texts are encoded in parts, cut where white space follows another
character: no piece of the pre-tokenizer and no added token reaches across. Memory is bounded by the largest text and its ids.

Nulls count as empty. An empty text is the end mark alone. Repeated rows and repeated or null ids each give their own pieces. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.text import id_and_bytes
from riskmart.session import cut_lineage

#: fixed value: how byte-level BPE cuts a text before merging
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n])")
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, part bigint, rank bigint"


@dataclass(frozen=True)
class PackConfig:
    """``path``: a vocabulary file of ``tokenizers`` that every executor can open. ``length``: the longest sequence, a power of two."""

    path: str
    length: int = 2048
    end_id: int = 1
    #: characters encoded at a time
    chunk: int = 500_000

    def __post_init__(self) -> None:
        if self.length < 1 or self.length & (self.length - 1):
            raise ValueError("length must be a power of two")


def _byte_alphabet() -> dict[str, int]:
    """The characters byte-level vocabularies write bytes as: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> ids (uint32), as ``tokenizers`` gives them without added special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)

    def by_library(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not spec.get("normalizer") and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))
    plain = plain and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex")
    plain = plain and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    if not plain:
        return by_library
    import tiktoken

    added = [t["content"] for t in spec.get("added_tokens", [])]
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in word): i for word, i in model["vocab"].items() if word not in added}
    fast = tiktoken.Encoding("pack", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(a in text for a in added):
            return by_library(text)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)

    return encode


def document_ids(text: str, config: PackConfig) -> np.ndarray:
    """All ids of a document, its end mark included."""
    encode, parts, at = encoder(config.path), [], 0
    while len(text) - at > config.chunk:
        found = SAFE_CUT.search(text, at + config.chunk)
        if found is None:
            break
        parts.append(encode(text[at : found.start()]))
        at = found.start()
    parts.append(encode(text[at:] if at else text))
    return np.concatenate([*parts, np.array([config.end_id], dtype=np.uint32)])


def piece_lengths(n: int, longest: int) -> list[int]:
    """``n`` as whole pieces of ``longest``, then the powers of two of what is left, falling."""
    return [longest] * (n // longest) + [1 << k for k in reversed(range(longest.bit_length() - 1)) if n >> k & 1]


def pieces(docs: DataFrame, config: PackConfig) -> DataFrame:
    """``PIECES``: the ids (little-endian uint32) of every piece, and its rank among those of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), dict.fromkeys((1 << k for k in range(config.length.bit_length())), 0)
        columns: list[list] = [[] for _ in range(8)]
        held = 0

        def flush() -> pa.RecordBatch:
            types = [pa.binary() if i == 3 else pa.int64() for i in range(8)]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in PIECES.split(", ")])
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = document_ids(data.as_py().decode("utf-8", "replace"), config).astype("<u4", copy=False).tobytes()
                start, total = 0, len(raw) // 4
                for n in piece_lengths(total, config.length):
                    ids = raw[4 * start : 4 * (start + n)]
                    for c, v in zip(columns, (doc_id, start, n, ids, zlib.crc32(ids), total, part, ranks[n])):
                        c.append(v)
                    ranks[n] += 1
                    start += n
                held += len(raw)
                if held > 8_000_000:
                    yield flush()
                    held = 0
        if columns[0]:
            yield flush()

    return id_and_bytes(docs).mapInArrow(run, PIECES)


def pack(docs: DataFrame, config: PackConfig) -> DataFrame:
    """``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece, which is one sequence."""
    stored = cut_lineage(pieces(docs, config), "packed-pieces")
    counts = stored.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # a row per task and bucket, in one window per bucket; then one row per bucket
    per_bucket = counts.groupBy("length").agg(F.sum("n").alias("n"))
    longer = Window.orderBy(F.col("length").desc())
    first = per_bucket.select("length", (F.sum("n").over(longer) - F.col("n")).alias("bucket_first"))
    earlier = Window.partitionBy("length").orderBy("part")
    base = counts.select("length", "part", (F.sum("n").over(earlier) - F.col("n")).alias("part_first")).join(first, "length")
    numbered = stored.join(base, ["length", "part"])
    return numbered.select(
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.col("bucket_first") + F.col("part_first") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as a table with a folder per length, in order of their ids; a batch of one folder needs no padding."""
    ordered = packed.repartitionByRange("sequence_id").sortWithinPartitions("sequence_id")
    ordered.write.mode("errorifexists").partitionBy("length").parquet(path)
