"""Fare model: features of a trip, and a random forest over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_of_week, hour_of_day

# A forest of 20 trees over six features caches some 200 bytes for a row.
ROWS_PER_TASK = 1_000_000


def trip_features(df: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """The given columns plus pickup hour and day of week; batch or stream."""
    return df.select(
        *columns,
        hour_of_day(ts).alias("pickup_hour"),
        day_of_week(ts).alias("pickup_dayofweek"),
    )


def even_parts(df: DataFrame, rows_per_task: int) -> DataFrame:
    """The rows as they are if no task holds more than so many, else dealt evenly to tasks that hold no more.

    Dealt rows are sorted inside a task, so whatever looks at their order finds the same one each time.
    """
    held = df.select(F.spark_partition_id().alias("part")).groupBy("part").count()
    counted = held.agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    if (counted["most"] or 0) <= rows_per_task:
        return df
    return df.repartition(-(-counted["rows"] // rows_per_task)).sortWithinPartitions(*df.columns)


def fit_fare_model(
    df: DataFrame, features: Sequence[str], label: str, seed: int = 42, rows_per_task: int = ROWS_PER_TASK
) -> PipelineModel:
    """Fit a random forest; rows with an invalid feature are left out.

    The forest caches its rows with a count for each tree, and a task reads one part of
    them, so parts are bounded.
    """
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="skip"
    )
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed)
    rows = df.where(F.col(label).isNotNull()).select(*dict.fromkeys([*features, label]))
    return Pipeline(stages=[assembler, forest]).fit(even_parts(rows, rows_per_task))


def score(model: PipelineModel, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Predictions next to the given columns, for a table or a stream."""
    return model.transform(df).select(*columns, "prediction")


def store_model(model: PipelineModel, path: str) -> str:
    """Write a fitted pipeline to a folder that later runs can read; gives the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """A stored pipeline, with the predictions it had when it was fitted."""
    return PipelineModel.load(path)
