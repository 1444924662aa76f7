"""Full outer join of two tables on one key, safe against hot keys.

A key shared by a large part of either table would send all its rows to one
task, and adaptive execution cannot split a full outer join. So the rows of every
key are counted exactly on both sides, in the same lazy plan as the join, and keys
with more rows than a slice holds are cut into slices:

* A row of a hot key gets one slice number of its own side, from a hash of the row
  and its task, and is repeated for each slice of the other side, so each pair of
  rows meets in exactly one cell (left slice, right slice).
* A cell can lack rows of one side although the key has partners in another
  cell. Such rows are dropped after the join for keys known to be on both sides.

The counts combine in each task before they are shuffled. The table of hot keys
grows with the data, so it is joined without a forced broadcast: adaptive execution
broadcasts it by its measured size, or else splits the hot keys of that left join.
Rows with a NULL key match nothing and are spread by the hash of the row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000

LEFT, RIGHT, SHARED = "left_slice", "right_slice", "on_both_sides"


class Pair(NamedTuple):
    """Two tables ready to join under the names l and r.

    ``on`` is the join condition, and ``keep`` is false for a joined row that
    only lacks a partner within its own cell. Both are SQL text.
    """

    left: DataFrame
    right: DataFrame
    on: str
    keep: str


def full_outer_pair(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_columns: dict[str, str],
    right_columns: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join on ``key`` and give columns of each side (old name to new name).

    The other side's columns are NULL where a row has no partner; keys may
    repeat on both sides.
    """
    pair = prepare_pair(
        left.select(*dict.fromkeys([key, *left_columns])),
        right.select(*dict.fromkeys([key, *right_columns])),
        key,
        rows_per_slice,
    )
    l, r = pair.left.alias("l"), pair.right.alias("r")
    return l.join(r, F.expr(pair.on), "full_outer").where(pair.keep).select(
        *[F.col(f"l.{old}").alias(new) for old, new in left_columns.items()],
        *[F.col(f"r.{old}").alias(new) for old, new in right_columns.items()],
    )


def full_outer_stored(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_columns: dict[str, str],
    right_columns: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``full_outer_pair`` of two tables that are stored in equally many buckets of the key.

    The rows of every key are counted bucket by bucket, which reads the key alone and moves
    nothing. If no key is hot the buckets are joined where they are, without an exchange;
    else the join is that of ``full_outer_pair``.
    """
    for side in (left, right):
        hot = side.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > rows_per_slice)
        missing = side.where(F.col(key).isNull()).limit(rows_per_slice + 1).count()
        if missing > rows_per_slice or not hot.isEmpty():
            return full_outer_pair(left, right, key, left_columns, right_columns, rows_per_slice)
    l = left.select(*dict.fromkeys([key, *left_columns])).alias("l")
    r = right.select(*dict.fromkeys([key, *right_columns])).alias("r")
    return l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}"), "full_outer").select(
        *[F.col(f"l.{old}").alias(new) for old, new in left_columns.items()],
        *[F.col(f"r.{old}").alias(new) for old, new in right_columns.items()],
    )


def prepare_pair(
    left: DataFrame, right: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE
) -> Pair:
    """Give both tables the slices of their hot keys."""
    hot = _hot_keys(left, right, key, rows_per_slice)
    return Pair(
        _slice(left, hot, key, LEFT, RIGHT),
        _slice(right, hot, key, RIGHT, LEFT),
        f"l.`{key}` = r.`{key}` AND l.{LEFT} = r.{LEFT} AND l.{RIGHT} = r.{RIGHT}",
        f"NOT (coalesce(l.{SHARED}, r.{SHARED})"
        f" AND (l.{SHARED} IS NULL OR r.{SHARED} IS NULL))",
    )


def _hot_keys(left: DataFrame, right: DataFrame, key: str, rows_per_slice: int) -> DataFrame:
    """Per key with more rows than a slice: slices of each side, and whether both have it."""
    zero = F.lit(0).cast("bigint")
    l = left.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("l"), zero.alias("r"))
    r = right.groupBy(F.col(key).alias("hot_key")).agg(zero.alias("l"), F.count("*").alias("r"))
    counts = l.union(r).where("hot_key IS NOT NULL").groupBy("hot_key").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return counts.where(F.greatest("l", "r") > rows_per_slice).select(
        "hot_key",
        F.greatest(F.ceil(F.col("l") / rows_per_slice), F.lit(1)).alias(f"{LEFT}s"),
        F.greatest(F.ceil(F.col("r") / rows_per_slice), F.lit(1)).alias(f"{RIGHT}s"),
        ((F.col("l") > 0) & (F.col("r") > 0)).alias(SHARED),
    )


def _slice(df: DataFrame, hot: DataFrame, key: str, own: str, other: str) -> DataFrame:
    # The task's number separates exact copies of a row. Unlike a row number it does
    # not depend on the order of rows, so a task that is run again gives the same.
    row_hash = F.xxhash64(*df.columns, F.spark_partition_id())
    hashed = df.withColumn("row_hash", row_hash)
    marked = hashed.join(hot, F.col(key) == F.col("hot_key"), "left")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    own_slice = (
        F.when(F.col(key).isNull(), F.col("row_hash"))
        .when(F.col("hot_key").isNull(), zero)
        .otherwise(F.pmod("row_hash", F.col(f"{own}s")))
    )
    last = F.coalesce(F.col(f"{other}s"), one) - 1
    return marked.select(
        *df.columns,
        own_slice.alias(own),
        F.coalesce(F.col(SHARED), F.lit(False)).alias(SHARED),
        F.explode(F.sequence(zero, last)).alias(other),
    )
