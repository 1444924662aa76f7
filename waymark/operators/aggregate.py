"""Global and grouped aggregates, for batch tables and streams alike.

Every one is a partial aggregate per task before the shuffle, so a group that
holds much of the table still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATS = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def table_summary(
    df: DataFrame,
    total: str,
    average: str,
    key: str,
    names: Sequence[str] = ("total", "average", "minimum", "maximum", "row_count"),
) -> DataFrame:
    """Sum, minimum and maximum of one measure, average of another, non-null keys."""
    stats = (F.sum(total), F.avg(average), F.min(total), F.max(total), F.count(key))
    return df.agg(*[s.alias(n) for s, n in zip(stats, names, strict=True)])


def column_stats(
    df: DataFrame, columns: Sequence[str], stat: str, prefix: str | None = None
) -> DataFrame:
    """One row with ``stat`` of each column, all in one pass."""
    prefix = f"{stat}_" if prefix is None else prefix
    return df.agg(*[STATS[stat](c).alias(f"{prefix}{c}") for c in columns])


def averages_long(
    df: DataFrame,
    columns: Sequence[str],
    name_column: str = "attribute",
    value_column: str = "average_value",
) -> DataFrame:
    """One row (column name, average) per column."""
    wide = df.agg(*[F.avg(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), name_column, value_column)


def group_count(df: DataFrame, key: str | Column, name: str = "row_count") -> DataFrame:
    """Rows per group, largest group first; NULL keys form a group."""
    return count_by(df, key, name).orderBy(F.desc(name), F.asc_nulls_last(_label(df, key)))


def count_by(df: DataFrame, key: str | Column, name: str = "row_count") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def group_avg(df: DataFrame, key: str | Column, value: str, name: str) -> DataFrame:
    """Average per group. A NULL key is a group; drop such rows first to omit it."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def window_sum(
    df: DataFrame,
    ts: str,
    width: str,
    value: str,
    name: str,
    watermark: str | None = None,
    count: str | None = None,
) -> DataFrame:
    """Sum per tumbling window, with flat ``start_time`` and ``end_time``, and its rows as ``count``.

    On a stream, a watermark drops rows that come too late and lets the state of
    closed windows go; without one the state keeps every window ever seen.
    """
    source = df.withWatermark(ts, watermark) if watermark else df
    counted = {count: F.count(F.lit(1)).alias(count)} if count else {}
    summed = source.groupBy(F.window(ts, width)).agg(F.sum(value).alias(name), *counted.values())
    return summed.selectExpr("window.start AS start_time", "window.end AS end_time", name, *counted)


def _label(df: DataFrame, key: str | Column) -> str:
    return key if isinstance(key, str) else df.select(key).columns[0]
