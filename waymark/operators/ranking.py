"""Full sorts, top-k rows and the smallest and largest groups.

Every order ends with a unique tie breaker. That makes results repeatable, and
in a full sort it lets the range partitioning split rows that share the leading
value, however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import count_by


def sorted_projection(
    df: DataFrame, columns: Sequence[str], by: str, tie_breaker: Sequence[str]
) -> DataFrame:
    """Project, then sort the whole table by one column descending, nulls last."""
    ordered = df.select(*dict.fromkeys([*columns, by, *tie_breaker])).orderBy(
        F.desc_nulls_last(by), *tie_breaker
    )
    return ordered.select(*columns)


def top_k(df: DataFrame, by: str, k: int, tie_breaker: Sequence[str]) -> DataFrame:
    """The k rows with the largest values; each task keeps at most k rows."""
    return df.orderBy(F.desc_nulls_last(by), *tie_breaker).limit(k)


def top_k_series(
    df: DataFrame, label: str, value: str, by: str, k: int, tie_breaker: Sequence[str]
) -> DataFrame:
    """Label and value of the top-k rows, taken together from one result."""
    return top_k(df, by, k, tie_breaker).select(label, value)


def extreme_groups(
    df: DataFrame, key: str | Column, k: int, which: str, name: str = "row_count"
) -> DataFrame:
    """The k groups with the smallest or largest key, with their row counts."""
    counts = count_by(df, key, name)
    return _ends(counts, k, which)


def extremes_union(
    df: DataFrame, key: str | Column, k: int, name: str = "row_count"
) -> DataFrame:
    """k smallest then k largest groups; with under 2k groups some come twice."""
    return both_ends(count_by(df, key, name), k)


def both_ends(counts: DataFrame, k: int) -> DataFrame:
    """Both ends of a table of (key, count) rows; its shuffle is computed once."""
    return _ends(counts, k, "smallest").union(_ends(counts, k, "largest"))


def merged_counts(known: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables of (key, count) rows added up."""
    key, name = known.columns
    return known.unionByName(more).groupBy(key).agg(F.sum(name).alias(name))


def end_groups(counts: DataFrame, k: int, which: str) -> DataFrame:
    """The k smallest or largest keys of a table of (key, count) rows.

    Merged batch by batch this needs no other rows: a key that falls out of the k smallest
    has k smaller ones ever after.
    """
    return _ends(counts, k, which)


def _ends(counts: DataFrame, k: int, which: str) -> DataFrame:
    key, name = counts.columns
    if which == "smallest":
        return counts.orderBy(F.asc(key), F.asc(name)).limit(k)
    if which == "largest":
        return counts.orderBy(F.desc(key), F.desc(name)).limit(k)
    raise ValueError("which must be 'smallest' or 'largest'")
