"""String columns: trimming, providers, ordered text rules, allow lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.config import NO_DATA, OTHER_LEVEL, UNKNOWN_BRAND

# Device brand <- texts the description starts with, texts it contains; first match wins.
BRAND_RULES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("samsung", ("sm-", "gt-"), ("samsung",)),
    ("apple", (), ("ios device", "macos", "iphone")),
    ("motorola", ("moto", "xt"), ("motorola",)),
    ("lg", ("lg",), ("lg-",)),
    ("huawei", ("ale-", "ane-"), ("huawei",)),
    ("xiaomi", ("mi ",), ("redmi", "xiaomi")),
    ("google", (), ("pixel", "nexus")),
    ("windows", (), ("windows", "trident")),
    ("linux", (), ("linux",)),
)


def folded(c: Column) -> Column:
    """Trimmed lower case; blank becomes null."""
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def first_label(c: Column) -> Column:
    """Provider of an email domain, or first label of a host: the text before the first dot."""
    return F.substring_index(folded(c), ".", 1)


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, r"^[a-z]+://([^/?#:]+)", 1)


def rule_bucket(c: Column, rules, default: str) -> Column:
    """First matching rule of ``(result, prefixes, substrings)`` as one CASE expression; null stays null."""
    text = folded(c)
    bucket = F.when(text.isNull(), F.lit(None).cast("string"))
    for result, prefixes, substrings in rules:
        tests = [text.startswith(p) for p in prefixes] + [text.contains(s) for s in substrings]
        bucket = bucket.when(reduce(Column.__or__, tests), F.lit(result))
    return bucket.otherwise(F.lit(default))


def device_brand(c: Column) -> Column:
    return rule_bucket(c, BRAND_RULES, UNKNOWN_BRAND)


def keep_or_other(c: Column, keep, other: str = OTHER_LEVEL) -> Column:
    """Allow-listed values and null stay; everything else becomes ``other`` (case-sensitive)."""
    return F.when(c.isNull() | c.isin(*keep), c).otherwise(F.lit(other))


def or_no_data(c: Column, label: str = NO_DATA) -> Column:
    return F.coalesce(c.cast("string"), F.lit(label))
