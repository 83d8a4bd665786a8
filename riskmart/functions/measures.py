"""Exact measures: amounts as integer units, rates as integer half-up ratios.

Sums of doubles depend on the order in which tasks finish. Amounts are therefore summed as
ten-thousandths, and every ratio is computed on integers, so a rerun or another partitioning gives the
same digits. The sum keeps the high and the low bits of the units in two ``bigint`` sums, which stay in fast
codegen, and joins them as a decimal only when the group is complete: it holds for 1e12 rows of any amount
below 9e14.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
EXACT = "decimal(38,0)"
LOW_BITS = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a: Column, b: Column) -> Column:
    """Integer division; null when the divisor is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def units(amount: Column | str) -> Column:
    """Amount as integer ten-thousandths."""
    return F.floor(_col(amount).cast("double") * F.lit(float(UNITS)) + F.lit(0.5))


def wide_units(amount: Column | str) -> Column:
    """Units of a reported amount that may itself be a large sum."""
    return F.round(_col(amount).cast("decimal(38,4)") * F.lit(UNITS)).cast(EXACT)


def exact_sum(amount_units: Column) -> Column:
    """Sum of ``bigint`` units that cannot overflow, as a decimal; 0 over no rows."""
    high, low = F.shiftright(amount_units, LOW_BITS), amount_units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    parts = [F.coalesce(F.sum(part), zero).cast(EXACT) for part in (high, low)]
    return (parts[0] * F.lit(1 << LOW_BITS) + parts[1]).cast(EXACT)


def money(amount_units: Column) -> Column:
    """Integer units to a double with two decimals, half up."""
    step = F.lit(UNITS // 100).cast(EXACT)
    shifted = amount_units.cast(EXACT) + F.lit(UNITS // 200)
    return (shifted - F.pmod(shifted, step)).cast("double") / F.lit(float(UNITS))


def half_up(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` of non-negative integers, rounded half up to ``digits`` decimals."""
    num, den = num.cast(EXACT), den.cast(EXACT)
    scaled = div(num * F.lit(2 * 10**digits) + den, den * F.lit(2))
    return scaled.cast("double") / F.lit(float(10**digits))


def ratio_or_zero(num: Column, den: Column, digits: int) -> Column:
    """``half_up`` with 0 where it is undefined."""
    return F.coalesce(half_up(num, den, digits), F.lit(0.0))


def rate_pct(positives: Column, n: Column, digits: int = 3) -> Column:
    return half_up(positives.cast(EXACT) * F.lit(100), n, digits)


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column, value: Column) -> Column:
    return exact_sum(F.when(cond, value))


def additive_sums(label: str, amount_units: Column) -> list[Column]:
    """Map-side combinable sums from which every other measure follows."""
    positive = F.col(label) == 1
    return [
        F.count(F.lit(1)).alias("transactions"),
        F.count(F.col(label)).alias("labelled"),
        count_if(positive).alias("positives"),
        exact_sum(amount_units).alias("amount_units"),
        sum_if(positive, amount_units).alias("positive_units"),
    ]


def bundle_columns() -> list[Column]:
    """The five reported measures from the sums above."""
    return [
        F.col("transactions"),
        F.col("positives"),
        rate_pct(F.col("positives"), F.col("labelled")).alias("rate_pct"),
        money(F.col("amount_units")).alias("amount_total"),
        money(F.col("positive_units")).alias("amount_positive"),
    ]
