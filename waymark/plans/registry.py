"""The query registry: a name, a Spark query and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir, use_utc
from ..sources import read_table, stream_table


@dataclass(frozen=True)
class Inputs:
    """The tables a query reads, and a place for files it writes."""

    spark: SparkSession
    root: str

    def __call__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def stream(self, name: str, ts: str | None = None) -> DataFrame:
        """A table as a stream; ``ts`` becomes an instant, as watermarks require."""
        rows = stream_table(self.spark, self.root, name)
        return rows.withColumn(ts, F.col(ts).cast("timestamp")) if ts else rows

    def scratch(self, label: str) -> str:
        return fresh_dir(self.spark, label)


Query = Callable[[Inputs], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of ``Inputs``; without SQL only its rows are checked."""

    def add(build: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _runner(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return build(Inputs(spark, sf_dir))

    return run


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Round sums and averages of doubles, whose last digits depend on row order."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Instants back to the zone-less timestamps the tables hold."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
