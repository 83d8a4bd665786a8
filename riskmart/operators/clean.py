"""Cleaning, projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.config import AUDIT_COLUMNS, NO_DATA
from riskmart.functions import text, timing


def normalize_names(df: DataFrame, old: str = "-", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name; two names that collide are an error."""
    names = [c.replace(old, new) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def drop_audit(df: DataFrame, columns: Iterable[str] = AUDIT_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by every other column, so reruns agree.

    ``row_number() = 1`` lets Spark keep one row per key and map task before the shuffle, so a key
    with very many copies never gathers in one task.
    """
    named = {c for c in order if isinstance(c, str)}  # columns of the order cannot be compared with names
    rest = [c for c in df.columns if c not in keys and c not in named]
    ordering = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col(c) for c in rest]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering or keys)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column in one projection."""
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def email_provider(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, text.first_label(F.col(source)))


def device_brand(df: DataFrame, source: str, target: str) -> DataFrame:
    return df.withColumn(target, text.device_brand(F.col(source)))


def collapse_rare(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    return df.withColumn(column, text.keep_or_other(F.col(column), keep))


def derive_time(df: DataFrame, seconds: str) -> DataFrame:
    """Relative ``day``, ``hour`` and ``weekday`` from seconds since the epoch."""
    s = F.col(seconds)
    return df.withColumns(
        {
            "day": timing.relative_day(s),
            "hour": timing.relative_hour(s),
            "weekday": timing.relative_weekday(timing.relative_day(s)),
        }
    )


def label_missing(df: DataFrame, columns: Iterable[str], label: str = NO_DATA) -> DataFrame:
    """Null becomes a visible bucket, after the cast to string."""
    return df.withColumns({c: text.or_no_data(F.col(c), label) for c in columns if c in df.columns})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n_rows, nulls, null_fraction`` of each column, in one pass over the data."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in columns]
    )
    nulls = F.col("n_rows") - F.col("filled")
    return counted.unpivot("n_rows", [f"`{c}`" for c in columns], "column_name", "filled").select(
        "column_name",
        "n_rows",
        nulls.alias("nulls"),
        (nulls.cast("double") / F.nullif(F.col("n_rows"), F.lit(0)).cast("double")).alias("null_fraction"),
    )


def sparse_columns(profile: DataFrame, max_fraction: float, protected: Iterable[str] = ()) -> DataFrame:
    """Columns whose null fraction lies strictly above the limit, protected ones exempt."""
    return profile.filter(
        (F.col("null_fraction") > F.lit(max_fraction)) & ~F.col("column_name").isin(*protected)
    ).select("column_name", "null_fraction")


def drop_sparse_columns(
    df: DataFrame, training: DataFrame, max_fraction: float, protected: Iterable[str] = ()
) -> tuple[DataFrame, list[str]]:
    """Drop the columns that are sparse in ``training``.

    The schema depends on data, so the list is fetched: at most one row per column.
    """
    sparse = sparse_columns(null_profile(training), max_fraction, protected).orderBy("column_name")
    dropped = [r.column_name for r in sparse.collect()]
    return df.drop(*dropped), dropped


def filter_partition(df: DataFrame, column: str, *values: str) -> DataFrame:
    """Select whole partitions; on a partition column this prunes directories."""
    return df.filter(F.col(column).isin(*values) if len(values) > 1 else F.col(column) == F.lit(values[0]))


def slice_filter(
    df: DataFrame,
    days: tuple[int, int] | None = None,
    chosen: Mapping[str, Sequence[str]] | None = None,
    day: str = "day",
) -> DataFrame:
    """Inclusive day range and an IN list per dimension; an empty list means all values."""
    predicate = F.lit(True)
    if days is not None:
        predicate = predicate & F.col(day).between(*days)
    for dim, values in (chosen or {}).items():
        if values and dim in df.columns:
            predicate = predicate & F.col(dim).isin(*values)
    return df.filter(predicate)


def min_support(df: DataFrame, count_column: str, at_least: int) -> DataFrame:
    return df.filter(F.col(count_column) >= at_least)


def project_business(df: DataFrame, always: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """The required columns plus those optional ones that exist."""
    return df.select(*always, *[c for c in optional if c in df.columns and c not in always])
