"""Reproducible pseudo-random draws: a function of the key only, never of the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: Column) -> Column:
    """32-bit unsigned draw from the md5 of the key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


DRAW_BITS = 60


def keep_fraction(key: Column, fraction: float, seed: int = 0) -> Column:
    """True for about ``fraction`` of the keys; the same keys on every run with the same seed.

    The draw has 60 bits of the md5, so fractions near 0 or 1 are kept apart from them.
    """
    salted = key.cast("string") if seed == 0 else F.concat(F.lit(f"{seed}:"), key.cast("string"))
    draw = F.conv(F.substring(F.md5(salted), 1, DRAW_BITS // 4), 16, 10).cast("bigint")
    return draw < F.lit(int(round(fraction * (1 << DRAW_BITS))))
