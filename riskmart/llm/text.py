"""Byte-level text rules shared by the operators that run in Arrow batches.

A word is a maximal run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. Those six are exactly what ``bytes.split()`` without arguments splits at, and none of them occurs
inside a multi-byte UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
#: the same words for SQL expressions
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def code_points(data: bytes) -> int:
    """Code points of valid UTF-8."""
    return len(data) if data.isascii() else len(data.translate(None, CONTINUATION))


def utf8(text: Column | str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.cast("binary"), F.lit("").cast("binary"))


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, data``: the only two columns an operator on whole texts reads."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("data"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with as many leading underscores as it takes not to clash with a column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
