"""The trip questions over trip files, batch and stream, against pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from waymark import operators as op
from waymark.functions import day_of_week, draw_double, draw_int, hour_of_day, weekday
from waymark.sources import TRIP_SCHEMA, read_csv, stream_csv, write_csv
from waymark.streaming import StreamJob, run_streams

PICKUP = "tpep_pickup_datetime"
MEASURES = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount"]
INTS = {"VendorID": (1, 3), "passenger_count": (0, 7), "RateCodeID": (1, 7), "payment_type": (1, 5)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """600 trips in three files; every 50th lacks its fare."""
    path = str(tmp_path_factory.mktemp("trips") / "csv")
    columns = []
    for i, (name, kind) in enumerate(f.split() for f in TRIP_SCHEMA.split(", ")):
        if name in INTS:
            column = draw_int("id", *INTS[name], 9, i)
        elif kind == "TIMESTAMP":
            minutes = draw_int("id", 0, 60 * 24 * 9, 9, 1)
            column = F.timestamp_seconds(F.lit(1_420_070_400) + minutes * 60)
        elif kind == "DOUBLE":
            column = F.round(draw_double("id", 0.0, 80.0, 9, i), 1)
        else:
            column = F.lit("N")
        if name == "fare_amount":
            column = F.when(F.col("id") % 50 != 0, column)
        columns.append(column.alias(name))
    write_csv(spark.range(0, 600, 1, 3).select(*columns), path)
    return path


@pytest.fixture(scope="module")
def trips(spark, folder):
    return read_csv(spark, folder, TRIP_SCHEMA).cache()


@pytest.fixture(scope="module")
def frame(trips):
    return trips.toPandas()


def close(actual, expected):
    assert {k: pytest.approx(v) for k, v in expected.items()} == actual


def test_exploration(trips, frame):
    nulls = {r.column: r.null_count for r in op.null_profile(trips).collect()}
    assert nulls == frame.isna().sum().to_dict() and nulls["fare_amount"] == 12
    assert tuple(op.table_shape(trips).collect()[0]) == frame.shape
    riders = op.group_count(trips, "passenger_count", "ride_count").collect()
    assert {r[0]: r[1] for r in riders} == frame.passenger_count.value_counts().to_dict()
    assert [r[1] for r in riders] == sorted((r[1] for r in riders), reverse=True)
    for stat, wanted in (("avg", frame[MEASURES].mean()), ("min", frame[MEASURES].min())):
        close(op.column_stats(trips, MEASURES, stat, "").collect()[0].asDict(), wanted.to_dict())
    found = {(r.col_x, r.col_y): r["corr"] for r in op.correlation_matrix(trips, MEASURES).collect()}
    wanted = frame[MEASURES].astype(float).corr()
    for (x, y), value in found.items():
        assert value == pytest.approx(wanted[x][y], abs=1e-9)
    longest = op.top_k(trips, "trip_distance", 10, [PICKUP, "total_amount"])
    ends = op.trip_endpoints(longest, ["trip_distance"]).toPandas()
    assert len(ends) == 20 and set(ends.kind) == {"Pickup", "Dropoff"}
    assert ends.trip_distance.min() == frame.trip_distance.nlargest(10).min()
    assert op.trip_legs(longest, []).count() == 10


def test_all_live_queries_side_by_side(spark, folder, frame):
    rows = op.drop_incomplete_rows(
        stream_csv(spark, folder, TRIP_SCHEMA, max_files=1, header=True)
    )
    window = ["start_time", "end_time"]
    by = lambda part, name: op.group_avg(rows, part(PICKUP).alias(name), "fare_amount", "avg_fare")
    counts = op.count_by(rows, "trip_distance")
    results = run_streams(
        {
            "averages": StreamJob(op.column_stats(rows, MEASURES, "avg", ""), "complete"),
            "ends": StreamJob(counts, "complete", refine=lambda b: op.both_ends(b, 10)),
            "hour": StreamJob(by(hour_of_day, "hour"), "complete"),
            "day": StreamJob(by(day_of_week, "day"), "complete"),
            "weekday": StreamJob(by(weekday, "day"), "complete"),
            "type": StreamJob(
                op.group_avg(rows, "payment_type", "passenger_count", "avg_passengers"),
                "update",
                ["payment_type"],
            ),
            "high": StreamJob(op.keep_where(rows, "fare_amount > 50").select(PICKUP, "fare_amount"), "append"),
            "total": StreamJob(
                op.window_sum(rows, PICKUP, "1 hour", "fare_amount", "total", "30 days"), "update", window
            ),
            "live": StreamJob(
                op.window_sum(rows, PICKUP, "10 minutes", "passenger_count", "total"), "update", window
            ),
        }
    )
    got = {name: df.toPandas() for name, df in results.items()}
    kept = frame.dropna()
    ts, fare = pd.DatetimeIndex(kept[PICKUP]), kept.fare_amount.to_numpy()
    fares = pd.Series(fare, index=ts)
    close(got["averages"].iloc[0].to_dict(), kept[MEASURES].mean().to_dict())
    close(dict(got["hour"].values), fares.groupby(ts.hour).mean().to_dict())
    close(dict(got["weekday"].values), fares.groupby(ts.dayofweek).mean().to_dict())
    close(dict(got["day"].values), fares.groupby((ts.dayofweek + 1) % 7 + 1).mean().to_dict())
    close(dict(got["type"].values), kept.groupby("payment_type").passenger_count.mean().to_dict())
    assert sorted(got["high"].fare_amount) == sorted(fare[fare > 50])
    close(got["total"].set_index("start_time").total.to_dict(), fares.groupby(ts.floor("h")).sum().to_dict())
    riders = pd.Series(kept.passenger_count.to_numpy(), index=ts).groupby(ts.floor("10min")).sum()
    close(got["live"].set_index("start_time").total.to_dict(), riders.to_dict())
    distances = kept.trip_distance.value_counts().sort_index()
    ends = pd.concat([distances.head(10), distances.tail(10)])
    assert sorted(map(tuple, got["ends"].values)) == sorted(ends.items())
