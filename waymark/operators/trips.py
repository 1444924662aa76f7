"""Endpoints and legs of trips, as tables a map could draw."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TripColumns(NamedTuple):
    """Names of the four coordinate columns; the default is the taxi file's."""

    pickup_lat: str = "pickup_latitude"
    pickup_lon: str = "pickup_longitude"
    dropoff_lat: str = "dropoff_latitude"
    dropoff_lon: str = "dropoff_longitude"


def trip_endpoints(
    df: DataFrame, keys: Sequence[str], at: TripColumns = TripColumns()
) -> DataFrame:
    """Two rows per trip: (kind, lat, lon) of the pickup and of the dropoff."""
    ends = F.array(
        _end("Pickup", at.pickup_lat, at.pickup_lon),
        _end("Dropoff", at.dropoff_lat, at.dropoff_lon),
    )
    return df.select(*keys, F.inline(ends))


def trip_legs(
    df: DataFrame, keys: Sequence[str], at: TripColumns = TripColumns()
) -> DataFrame:
    """One row per trip with the line from pickup to dropoff, as two points."""
    line = F.array(_point(at.pickup_lat, at.pickup_lon), _point(at.dropoff_lat, at.dropoff_lon))
    return df.select(*keys, line.alias("leg"))


def _point(lat: str, lon: str):
    return F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))


def _end(kind: str, lat: str, lon: str):
    return F.struct(F.lit(kind).alias("kind"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
