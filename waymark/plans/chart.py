"""The data behind scatter plots and trip maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..operators import TripColumns
from .draw_sql import draw_sql
from .registry import query

SEED = 42
FRACTION = 0.01
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
AT = TripColumns("l_quantity", "l_extendedprice", "l_discount", "l_tax")

SAMPLE = f"(SELECT * FROM lineitem WHERE {draw_sql(KEYS, SEED)} < {int(FRACTION * 2**32)})"
TOP = f"(SELECT * FROM lineitem ORDER BY l_quantity DESC, {', '.join(KEYS)}, l_extendedprice LIMIT 10)"


def sample(t) -> DataFrame:
    return op.hash_sample(t("lineitem"), KEYS, FRACTION, SEED)


def longest(t) -> DataFrame:
    return op.top_k(t("lineitem"), "l_quantity", 10, [*KEYS, "l_extendedprice"])


def endpoints_sql(rows: str) -> str:
    keys = ", ".join(KEYS)
    return f"""SELECT {keys}, 'Pickup' AS kind, l_quantity AS lat, l_extendedprice AS lon
               FROM {rows}
               UNION ALL SELECT {keys}, 'Dropoff', l_discount, l_tax FROM {rows}"""


def legs_sql(rows: str) -> str:
    return f"""SELECT {', '.join(KEYS)}, l_quantity AS from_lat, l_extendedprice AS from_lon,
                      l_discount AS to_lat, l_tax AS to_lon
               FROM {rows}"""


def flat(legs: DataFrame) -> DataFrame:
    start, end = F.get("leg", 0), F.get("leg", 1)
    return legs.select(
        *KEYS,
        start["lat"].alias("from_lat"),
        start["lon"].alias("from_lon"),
        end["lat"].alias("to_lat"),
        end["lon"].alias("to_lon"),
    )


@query("seeded_sample")
def seeded_sample(t):
    """Spark's own sample: its rows depend on the partitioning, so SQL cannot name them."""
    return op.seeded_sample(t("lineitem"), FRACTION, SEED)


@query(
    "seeded_sample_checks",
    "SELECT TRUE AS all_in_table, TRUE AS none_twice, TRUE AS near_fraction FROM (SELECT count(*) FROM lineitem)",
)
def seeded_sample_checks(t):
    """Sampled rows are rows of the table, none more often than there, about as many as asked."""
    unit = F.lit(1)
    table = t("lineitem").groupBy(*KEYS).agg(F.count(unit).alias("n"))
    taken = seeded_sample(t).groupBy(*KEYS).agg(F.count(unit).alias("taken"))
    both = table.join(taken, KEYS, "full_outer")
    total, drawn = F.sum("n"), F.coalesce(F.sum("taken"), F.lit(0))
    spread = F.sqrt(total * FRACTION * (1 - FRACTION))
    return both.agg(
        (F.count_if(F.col("n").isNull()) == 0).alias("all_in_table"),
        (F.count_if(F.col("taken") > F.col("n")) == 0).alias("none_twice"),
        (F.abs(drawn - total * FRACTION) < 6 * spread).alias("near_fraction"),
    )


SMALL_FRACTION = 0.0001


@query("hash_sample_small", f"SELECT * FROM lineitem WHERE {draw_sql(KEYS, SEED)} < {int(SMALL_FRACTION * 2**32)}")
def hash_sample_small(t):
    return op.hash_sample(t("lineitem"), KEYS, SMALL_FRACTION, SEED)


@query("hash_sample", f"SELECT * FROM {SAMPLE}")
def hash_sample(t):
    return sample(t)


@query("points_distance_passengers", f"SELECT l_quantity AS x, l_linenumber AS y FROM {SAMPLE}")
def points_distance_passengers(t):
    return op.point_set(sample(t), "l_quantity", "l_linenumber")


@query("points_tip_passengers", f"SELECT l_discount AS x, l_linenumber AS y FROM {SAMPLE}")
def points_tip_passengers(t):
    return op.point_set(sample(t), "l_discount", "l_linenumber")


@query("points_tip_fare", f"SELECT l_discount AS x, l_extendedprice AS y FROM {SAMPLE}")
def points_tip_fare(t):
    return op.point_set(sample(t), "l_discount", "l_extendedprice")


@query("trip_endpoints", endpoints_sql(SAMPLE))
def trip_endpoints(t):
    return op.trip_endpoints(sample(t), KEYS, AT)


@query("trip_legs", legs_sql(SAMPLE))
def trip_legs(t):
    return flat(op.trip_legs(sample(t), KEYS, AT))


@query("longest_trip_endpoints", endpoints_sql(TOP))
def longest_trip_endpoints(t):
    return op.trip_endpoints(longest(t), KEYS, AT)


@query("longest_trip_legs", legs_sql(TOP))
def longest_trip_legs(t):
    return flat(op.trip_legs(longest(t), KEYS, AT))
