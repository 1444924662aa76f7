"""Shared steps: word patterns, row identity, and tables kept in the shared folder."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BROADCAST_ROWS = 2_000_000


def ship_by_value(name: str) -> None:
    """Send a module's functions inside the plan, so executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def picked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns in use, so other columns can have any name."""
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def row_key() -> Column:
    """Tells rows that share a doc_id apart; equal rows get equal results."""
    return F.xxhash64("doc_id", "text")


def with_results(rows: DataFrame, results: DataFrame, how: str = "left") -> DataFrame:
    """Join per-row results on (doc_id, row_key), where a null id equals a null id."""
    results = results.withColumnsRenamed({"doc_id": "__doc_id", "row_key": "__row_key"})
    same = (F.col("row_key") == F.col("__row_key")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    return rows.join(results, same, how).drop("__doc_id", "__row_key")


def kept_table(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage: a lost executor repeats reads of this table, not the work before it.
    """
    path = fresh_dir(spark, f"llm-{label}")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small_side(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of a few numbers for one side of a join, broadcast only if counted to be few.

    Beyond ``MOST_BROADCAST_ROWS`` (some 150 MB of ids) Spark shuffles the join instead.
    """
    rows = kept_table(spark, rows, "side")
    return F.broadcast(rows) if rows.count() <= MOST_BROADCAST_ROWS else rows


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


Query = Callable[[SparkSession, str], DataFrame]
