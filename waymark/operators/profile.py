"""Shape, null counts, descriptive statistics, correlations and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import comoments
from .clean import numeric_columns

# Ship the per-task step inside the plan, so executors need not have this package.
cloudpickle.register_pickle_by_value(comoments)

# Partial results are merged in this many groups of tasks first, then once more.
MERGE_GROUPS = 256


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"), F.lit(len(df.columns)).alias("num_cols")
    )


def column_list(df: DataFrame) -> list[str]:
    return df.columns


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count) of every column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "null_count")


def describe_long(df: DataFrame) -> DataFrame:
    """Statistics of each numeric and text column, one row per column.

    Text columns have text extremes, and a mean and deviation over those values
    that are numbers. Columns of other types, such as timestamps, are left out.

    Numbers and texts are aggregated apart, so that each column is read once, and
    text extremes, which hash aggregation cannot hold, do not slow the numbers.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    parts = [
        _describe(df, columns, is_text)
        for columns, is_text in ((numeric_columns(df), False), (texts, True))
        if columns
    ]
    if not parts:
        raise ValueError("the table has no numeric or text column")
    return parts[0].union(parts[1]) if len(parts) == 2 else parts[0]


def _describe(df: DataFrame, columns: Sequence[str], is_text: bool) -> DataFrame:
    stats = []
    for i, name in enumerate(columns):
        value = F.col(name)
        number = _text_number(value) if is_text else value.cast("double")
        stats += [
            F.count(value).alias(f"n{i}"),
            F.avg(number).alias(f"mean{i}"),
            F.stddev(number).alias(f"dev{i}"),
            F.min(value if is_text else number).alias(f"min{i}"),
            F.max(value if is_text else number).alias(f"max{i}"),
        ]
    rows = F.array(*[_stat_row(name, i, is_text) for i, name in enumerate(columns)])
    return df.agg(*stats).select(F.inline(rows))


def _text_number(value: Column) -> Column:
    """Text as a number, or NULL; a failing cast is slow, so most are ruled out first."""
    like_number = r"(?i)^[\x00-\x20]*[-+]?(\.?[0-9]|nan|inf)"
    return F.when(value.rlike(like_number), value.try_cast("double"))


def _stat_row(name: str, i: int, is_text: bool) -> Column:
    low, high = F.col(f"min{i}"), F.col(f"max{i}")
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    return F.struct(
        F.lit(name).alias("column"),
        F.col(f"n{i}").alias("value_count"),
        F.col(f"mean{i}").alias("mean"),
        F.col(f"dev{i}").alias("stddev"),
        (no_number if is_text else low).alias("min_number"),
        (no_number if is_text else high).alias("max_number"),
        (low if is_text else no_text).alias("min_text"),
        (high if is_text else no_text).alias("max_text"),
    )


def describe_text(df: DataFrame) -> DataFrame:
    """The same statistics in Spark's own layout, all as text."""
    return df.describe()


def _merged(partials: DataFrame, by: list[str]) -> DataFrame:
    """Co-moments of each group, summed around the group's smallest mean."""
    group, n = Window.partitionBy(*by), F.col("n")
    low = {f"low_{v}": F.min(f"mean_{v}").over(group) for v in "xy"}
    shifted = partials.withColumns(low).withColumns(
        {f"d_{v}": F.col(f"mean_{v}") - F.col(f"low_{v}") for v in "xy"}
    )
    sums = shifted.groupBy(*by).agg(
        F.sum(n).alias("n"),
        *[F.first(f"low_{v}").alias(f"low_{v}") for v in "xy"],
        *[F.sum(n * F.col(f"d_{v}")).alias(f"s_{v}") for v in "xy"],
        *[
            F.sum(F.col(f"c_{v}{w}") + n * F.col(f"d_{v}") * F.col(f"d_{w}")).alias(f"sum_{v}{w}")
            for v, w in ("xy", "xx", "yy")
        ],
    )
    return sums.select(
        *by,
        "n",
        *[(F.col(f"low_{v}") + F.try_divide(f"s_{v}", n)).alias(f"mean_{v}") for v in "xy"],
        *[
            (F.col(f"sum_{v}{w}") - F.try_divide(F.col(f"s_{v}") * F.col(f"s_{w}"), n)).alias(f"c_{v}{w}")
            for v, w in ("xy", "xx", "yy")
        ],
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns as (col_x, col_y, corr).

    Each pair uses the rows where both values are present. A constant column, or
    fewer than two rows, gives NULL. The table is read once: each task reduces
    its rows to one partial result per pair, and only those are shuffled. Sums
    are taken around a value of the column, so columns far from zero lose no
    digits.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    values = df.select(*[F.col(c).cast("double") for c in names])
    partials = values.mapInArrow(comoments.partial_comoments, comoments.PARTIAL_SCHEMA)
    tasks = partials.withColumn("g", F.spark_partition_id() % MERGE_GROUPS)
    merged = _merged(_merged(tasks, ["g", "i", "j"]), ["i", "j"])
    corr = F.try_divide(F.col("c_xy"), F.sqrt("c_xx") * F.sqrt("c_yy"))
    found = merged.select("i", "j", F.when(~F.isnan(corr), corr).alias("corr"))
    label = F.array(*[F.lit(c) for c in names])
    cells = df.sparkSession.range(len(names) ** 2).selectExpr(
        f"int(id div {len(names)}) AS x", f"int(id % {len(names)}) AS y"
    )
    at = (F.least("x", "y") == F.col("i")) & (F.greatest("x", "y") == F.col("j"))
    return cells.join(found, at, "left").select(
        F.get(label, F.col("x")).alias("col_x"), F.get(label, F.col("y")).alias("col_y"), "corr"
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the value range as (bin, low, high, row_count).

    Bins are half open but for the last, which is closed. Empty bins are kept.
    A single distinct value gets the range around it from -0.5 to +0.5, and a
    table without values the range 0 to 1. NULL and NaN are not counted.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    extremes = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = extremes.select(
        F.coalesce(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), F.lit(0.0)).alias("lo"),
        F.coalesce(F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")), F.lit(1.0)).alias("hi"),
    )
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    bucket = F.least(F.width_bucket("v", lo, hi, F.lit(bins)), F.lit(bins)) - 1
    counted = values.groupBy(bucket.cast("int").alias("bin")).agg(F.count("*").alias("found"))
    step = (hi - lo) / bins
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (lo + step * F.col("bin")).alias("low"),
            (lo + step * (F.col("bin") + 1)).alias("high"),
            F.coalesce("found", F.lit(0).cast("bigint")).alias("row_count"),
        )
    )
