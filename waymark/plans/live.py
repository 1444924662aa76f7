"""Structured Streaming queries over the tables read as streams.

Each drains its stream and gives the running result as a table, so its oracle is
the batch query over the whole table. Where the batch query is registered too, both
share its plan. The ``_gaps`` queries read views with nulls instead, whose incomplete
rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import day_of_week, hour_of_day
from ..sources import stream_csv, write_csv
from ..streaming import (
    Output,
    StreamJob,
    await_streams,
    run_fan_out,
    run_stream,
    run_streams,
    start_stream,
    stream_snapshot,
)
from . import batch
from .registry import Inputs, query, rounded, wall_clock

WINDOW_KEYS = ["start_time", "end_time"]
ENDS = 10

# The tables hold no nulls, so the gap queries read views with some.
EVENTS = """(SELECT * FROM (SELECT event_id, ts, user_id, props, nullif(event_type, 'error') AS event_type,
             CASE WHEN event_type <> 'view' THEN value END AS value FROM events)
             WHERE event_type IS NOT NULL AND value IS NOT NULL)"""
LINES = """(SELECT * FROM (SELECT * REPLACE (CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
            CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax) FROM lineitem)
            WHERE l_quantity IS NOT NULL AND l_tax IS NOT NULL)"""


def of_complete(sql: str) -> str:
    """A batch oracle over the complete rows of the views above."""
    return sql.replace("FROM events", f"FROM {EVENTS}").replace("FROM lineitem", f"FROM {LINES}")


def clean_events(t: Inputs, *columns: str) -> DataFrame:
    """The event stream without rows that lack a column in use."""
    return op.drop_incomplete_rows(t.stream("events", ts="ts").select(*columns), list(columns))


def clean_lines(t: Inputs, *columns: str) -> DataFrame:
    return op.drop_incomplete_rows(t.stream("lineitem").select(*columns), list(columns))


@query("stream_averages_gaps", of_complete(batch.AVERAGES_SQL))
def stream_averages_gaps(t):
    gaps = t.stream("lineitem").withColumns(
        {
            "l_quantity": F.when(F.col("l_returnflag") != "R", F.col("l_quantity")),
            "l_tax": F.when(F.col("l_tax") != 0, F.col("l_tax")),
        }
    )
    lines = op.drop_incomplete_rows(gaps.select(*batch.MEASURES), batch.MEASURES)
    result = run_stream(op.column_stats(lines, batch.MEASURES, "avg"), "complete")
    return rounded(result, 4, *result.columns)


@query("stream_avg_by_hour_gaps", of_complete(batch.HOUR_SQL))
def stream_avg_by_hour_gaps(t):
    gaps = t.stream("events", ts="ts").select(
        "ts",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )
    averages = batch.average_by(op.drop_incomplete_rows(gaps), hour_of_day, "pickup_hour")
    return rounded(run_stream(averages, "complete"), 6, "avg_value")


@query("stream_averages", batch.AVERAGES_SQL)
def stream_averages(t):
    lines = clean_lines(t, *batch.MEASURES)
    result = run_stream(op.column_stats(lines, batch.MEASURES, "avg"), "complete")
    return rounded(result, 4, *result.columns)


def running_ends(t: Inputs, keep) -> DataFrame:
    """Both ends of the distances by folding: a group that leaves the ends never returns, so none else is kept."""
    lines = clean_lines(t, "l_quantity")
    counts = op.count_by(lines, "l_quantity")
    merge = lambda known, rows: keep(op.merged_counts(known, op.count_by(rows, "l_quantity")))
    return run_streams({"ends": StreamJob(lines, "fold", merge=merge, schema=counts.schema)})["ends"]


@query("stream_shortest", batch.SHORTEST_SQL)
def stream_shortest(t):
    return running_ends(t, lambda counts: op.end_groups(counts, ENDS, "smallest"))


@query("stream_longest", batch.LONGEST_SQL)
def stream_longest(t):
    return running_ends(t, lambda counts: op.end_groups(counts, ENDS, "largest"))


@query("stream_extremes_union", batch.EXTREMES_SQL)
def stream_extremes_union(t):
    """One source and one table of at most 2k groups for both ends."""
    kept = running_ends(t, lambda counts: op.both_ends(counts, ENDS).distinct())
    return op.both_ends(kept, ENDS)


@query("stream_avg_by_hour", batch.HOUR_SQL)
def stream_avg_by_hour(t):
    averages = batch.average_by(clean_events(t, "ts", "value"), hour_of_day, "pickup_hour")
    return rounded(run_stream(averages, "complete"), 6, "avg_value")


@query("stream_avg_by_dayofweek", batch.DOW_SQL)
def stream_avg_by_dayofweek(t):
    averages = batch.average_by(clean_events(t, "ts", "value"), day_of_week, "pickup_dayofweek")
    return rounded(run_stream(averages, "complete"), 6, "avg_value")


@query("stream_avg_by_type", batch.TYPE_SQL)
def stream_avg_by_type(t):
    events = clean_events(t, "event_type", "user_id")
    averages = op.group_avg(events, "event_type", "user_id", "avg_user")
    return rounded(run_stream(averages, "update", ["event_type"]), 6, "avg_user")


@query("stream_hourly_sum", batch.HOURLY_SUM_SQL)
def stream_hourly_sum(t):
    events = clean_events(t, "ts", "value")
    sums = op.window_sum(events, "ts", "1 hour", "value", "total_value", watermark="1 hour")
    return wall_clock(rounded(run_stream(sums, "update", WINDOW_KEYS), 2, "total_value"), *WINDOW_KEYS)


@query("stream_ten_minute_sum", batch.TEN_MINUTE_SQL)
def stream_ten_minute_sum(t):
    events = clean_events(t, "ts", "user_id")
    sums = op.window_sum(events, "ts", "10 minutes", "user_id", "total_users")
    return wall_clock(run_stream(sums, "update", WINDOW_KEYS), *WINDOW_KEYS)


# Every fiftieth event before the middle of the time range comes after all others.
LATE_EVERY = 50
LATE_SQL = """
    WITH bounds AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events),
    parts AS (SELECT e.*, ts < middle AND event_id % 50 = 0 AS late FROM events e, bounds),
    mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM parts WHERE NOT late)
    SELECT date_trunc('hour', ts) AS start_time, date_trunc('hour', ts) + INTERVAL 1 HOUR AS end_time,
           round(sum(value), 2) AS total_value
    FROM parts, mark WHERE NOT late OR date_trunc('hour', ts) + INTERVAL 1 HOUR > watermark
    GROUP BY 1, 2"""


def late_turns(t: Inputs):
    """Files that arrive in three turns, each drained before the next: a row comes too
    late when its window had ended by the watermark of the turns before.

    Gives the hourly sums' table and the finished queries.
    """
    path, result = t.scratch("events-ordered"), t.scratch("late-rows")
    events = t("events").select("event_id", "ts", "value")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(first + (last - first) / 2)
    late = (F.col("ts") < middle) & (F.col("event_id") % LATE_EVERY == 0)
    done = []
    for rows in (events.where((F.col("ts") < middle) & ~late), events.where(F.col("ts") >= middle), events.where(late)):
        write_csv(rows, path, mode="append", header=False)
        stream = stream_csv(t.spark, path, "event_id BIGINT, ts TIMESTAMP, value DOUBLE", max_files=None)
        sums = op.window_sum(stream, "ts", "1 hour", "value", "total_value", watermark="1 hour", count="row_count")
        table, running = start_stream(StreamJob(sums, "update", WINDOW_KEYS, counted="row_count"), result)
        await_streams([running])
        done.append(running)
    return table, done


@query("stream_late_rows", LATE_SQL)
def stream_late_rows(t):
    table, _ = late_turns(t)
    sums = table.read(t.spark).drop("row_count")
    return wall_clock(rounded(sums, 2, "total_value"), *WINDOW_KEYS)


LATE_COUNTS_SQL = LATE_SQL.split("SELECT date_trunc('hour', ts) AS start_time")[0] + """
    , judged AS (
      SELECT CASE WHEN late THEN 2 WHEN ts >= middle THEN 1 ELSE 0 END AS batch_id,
             NOT late OR date_trunc('hour', ts) + INTERVAL 1 HOUR > watermark AS kept FROM parts, bounds, mark)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS input_rows, count(*) FILTER (kept) AS kept_rows,
           count(*) FILTER (NOT kept) AS dropped_rows FROM judged GROUP BY 1"""


@query("stream_late_counts", LATE_COUNTS_SQL)
def stream_late_counts(t):
    """Rows that came, were kept, and were dropped by the watermark, of each batch that had any.

    The runs end their input with a batch without rows, so batches are numbered again.
    """
    table, done = late_turns(t)
    counts = table.row_counts(t.spark, done).drop("watermark")
    numbered = F.row_number().over(Window.orderBy("batch_id")) - 1  # three batches
    return counts.withColumn("batch_id", numbered.cast("bigint"))


@query("stream_filter", "SELECT event_id, ts, user_id, value FROM events WHERE value > 50")
def stream_filter(t):
    high = op.keep_where(clean_events(t, "event_id", "ts", "user_id", "value"), "value > 50")
    return wall_clock(run_stream(high.select("event_id", "ts", "user_id", "value"), "append"), "ts")


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "stream_snapshot_shape",
    "SELECT count(*) AS num_rows, CAST(6 AS INTEGER) AS num_cols FROM events",
)
def stream_snapshot_shape(t):
    stream_snapshot(clean_events(t, *EVENT_COLUMNS), "waymark_live")
    return op.table_shape(t.spark.sql("SELECT * FROM waymark_live"))


@query(
    "stream_snapshot_describe",
    batch.describe_sql("events", ["event_id", "user_id", "value"], ["event_type", "props"]),
)
def stream_snapshot_describe(t):
    """Every column of the stream; a description leaves the timestamp out by itself."""
    stream_snapshot(clean_events(t, *EVENT_COLUMNS), "waymark_live_values")
    described = op.describe_long(t.spark.sql("SELECT * FROM waymark_live_values"))
    return rounded(described, 3, "mean", "stddev")


@query("stream_csv_rows", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def stream_csv_rows(t):
    """A directory of CSV files with header lines, some files per micro-batch."""
    path = t.scratch("supplier-csv")
    supplier = t("supplier")
    write_csv(supplier, path)
    rows = stream_csv(t.spark, path, supplier.schema, max_files=100)
    return run_stream(op.drop_incomplete_rows(rows), "append")


SIDE_BY_SIDE_SQL = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, CAST({key} AS INTEGER) AS part, round(avg(value), 6) AS avg_value "
    "FROM events GROUP BY 2"
    for kind, key in (("hour", "hour(ts)"), ("dayofweek", "dayofweek(ts) + 1"))
)


@query("stream_side_by_side", SIDE_BY_SIDE_SQL)
def stream_side_by_side(t):
    """Two queries over one source, running at the same time."""
    events = clean_events(t, "ts", "value")
    results = run_streams(
        {
            "hour": StreamJob(batch.average_by(events, hour_of_day, "part"), "complete"),
            "dayofweek": StreamJob(batch.average_by(events, day_of_week, "part"), "complete"),
        }
    )
    hours, days = [
        result.select(F.lit(kind).alias("kind"), "part", "avg_value")
        for kind, result in results.items()
    ]
    return rounded(hours.union(days), 6, "avg_value")


CLOSED_SQL = """
    SELECT CAST(date_trunc('hour', ts) AS DATE) AS day, date_trunc('hour', ts) AS start_time,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS end_time, round(sum(value), 2) AS total_value
    FROM events GROUP BY 1, 2, 3
    HAVING end_time <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"""


@query("stream_closed_windows", CLOSED_SQL)
def stream_closed_windows(t):
    """Hours that the watermark has closed, written once each into a folder of their day; open ones aren't there."""
    sums = op.window_sum(clean_events(t, "ts", "value"), "ts", "1 hour", "value", "total_value", watermark="1 hour")
    daily = sums.select(F.to_date("start_time").alias("day"), "*")
    rows = run_streams({"closed": StreamJob(daily, "append", partition_by=["day"])})["closed"]
    return wall_clock(rounded(rows, 2, "total_value"), *WINDOW_KEYS)


FAN_OUT_SQL = """
    SELECT 'high' AS kind, event_type AS label, count(*) AS row_count, round(sum(value), 2) AS total
    FROM events WHERE value > 50 GROUP BY 2
    UNION ALL
    SELECT 'hour', CAST(hour(ts) AS VARCHAR), count(*), round(sum(value), 2) FROM events GROUP BY 2"""


@query("stream_fan_out", FAN_OUT_SQL)
def stream_fan_out(t):
    """One read of the stream for two results: rows over 50, appended, and totals by hour, folded."""
    events = clean_events(t, "ts", "event_type", "value")

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("label").agg(F.sum("row_count").alias("row_count"), F.sum("total").alias("total"))

    def by_hour(rows: DataFrame) -> DataFrame:
        one = F.lit(1).cast("bigint").alias("row_count")
        return totals(rows.select(F.hour("ts").cast("string").alias("label"), one, F.col("value").alias("total")))

    outputs = {
        "high": Output(lambda rows: rows.where("value > 50").select("event_type", "value")),
        "hour": Output(by_hour, lambda known, rows: totals(known.unionByName(rows)), by_hour(events).schema),
    }
    found = run_fan_out(events, outputs)
    high = found["high"].groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("row_count"), F.sum("value").alias("total"))
    both = high.withColumn("kind", F.lit("high")).unionByName(found["hour"].withColumn("kind", F.lit("hour")))
    return rounded(both.select("kind", "label", "row_count", "total"), 2, "total")
