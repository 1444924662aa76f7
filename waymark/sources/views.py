"""Named relations for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL in this session and return it."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run text that names the given frames as ``{name}``; no view is left behind."""
    return spark.sql(text, **frames)
