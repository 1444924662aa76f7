"""Row and column shaping: projections, ratios, renames, null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import draw_int, parse_timestamp, ratio, split_field, whole_number


def project(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns)


def with_ratio(df: DataFrame, numerator: str, denominator: str, name: str) -> DataFrame:
    return df.withColumn(name, ratio(numerator, denominator))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by old name; a name the table lacks changes nothing."""
    return df.withColumnsRenamed(names)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_incomplete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any column of ``subset``.

    The default tests every column, and so makes the scan read every column.
    Name the columns a query uses to keep column pruning. Works on streams too.
    """
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_and_cast(
    df: DataFrame, fills: dict[str, float | int | str], casts: dict[str, str]
) -> DataFrame:
    """Replace nulls and NaN by constants, then cast; fractions are truncated."""
    filled = df.na.fill(fills)
    return filled.withColumns({c: whole_number(c, t) for c, t in casts.items()})


def keep_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Filter by SQL text or expression; a row whose test is NULL is dropped."""
    return df.where(predicate)


def keep_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def select_exprs(df: DataFrame, *exprs: str) -> DataFrame:
    """Project by SQL expressions, including struct fields such as ``window.start``."""
    return df.selectExpr(*exprs)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def extend_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Append rows by column name; a column missing on one side is NULL there."""
    return df.unionByName(extra, allowMissingColumns=True)


def with_random_int(
    df: DataFrame, name: str, lo: int, hi: int, keys: list[str], seed: int
) -> DataFrame:
    """Add whole numbers uniform in [lo, hi), fixed by the key columns and the seed."""
    return df.withColumn(name, draw_int(keys, lo, hi, seed))


def with_split_field(
    df: DataFrame, source: str, sep: str, index: int, name: str
) -> DataFrame:
    return df.withColumn(name, split_field(source, sep, index))


def with_parsed_timestamp(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.withColumn(name, parse_timestamp(source))
