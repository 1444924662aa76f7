"""Row samples and the point sets drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import draw_below


def seeded_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement, stable for one way of partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int
) -> DataFrame:
    """Bernoulli sample decided by the key columns alone, however rows are spread."""
    return df.where(draw_below(list(keys), seed, int(fraction * 2**32)))


def point_set(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).alias("x"), F.col(y).alias("y"))
