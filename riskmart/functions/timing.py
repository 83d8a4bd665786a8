"""Relative time: days, hours and weekdays counted from an epoch, never calendar dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.config import SECONDS_PER_DAY, SECONDS_PER_HOUR


def seconds_since(ts: Column, epoch_day: str) -> Column:
    """Whole seconds from midnight of ``epoch_day``, independent of the session time zone."""
    days = F.date_diff(ts.cast("date"), F.lit(epoch_day).cast("date")).cast("bigint")
    return (
        days * F.lit(SECONDS_PER_DAY).cast("bigint")
        + F.hour(ts) * F.lit(SECONDS_PER_HOUR)
        + F.minute(ts) * F.lit(60)
        + F.second(ts)
    )


def relative_day(seconds: Column) -> Column:
    return F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int")


def relative_hour(seconds: Column) -> Column:
    return (F.floor(seconds / F.lit(SECONDS_PER_HOUR)) % 24).cast("int")


def relative_weekday(day: Column) -> Column:
    return (day % F.lit(7)).cast("int")


def elapsed_seconds(later: Column, earlier: Column, digits: int = 2) -> Column:
    """Difference of two timestamps in seconds with ``digits`` decimals, half up."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    step = F.lit(10 ** (6 - digits)).cast("bigint")
    shifted = micros + F.lit(10 ** (6 - digits) // 2).cast("bigint")
    return (shifted - F.pmod(shifted, step)).cast("double") / F.lit(1e6)
