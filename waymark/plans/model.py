"""Model features, and scores of a table and of a stream.

Scores have no SQL oracle; what must hold of them has: the ``*_checks`` queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..streaming import StreamJob, await_streams, run_stream, start_stream
from .registry import Inputs, query

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MEASURES = ["l_quantity", "l_discount", "l_tax"]
FEATURES = [*MEASURES, "l_linenumber", "pickup_hour", "pickup_dayofweek"]
LABEL = "l_extendedprice"
COLUMNS = [*KEYS, *MEASURES, LABEL]


def line_features(lines: DataFrame) -> DataFrame:
    return op.trip_features(lines, "l_shipdate", COLUMNS)


def fitted(t: Inputs):
    """Fits while the query is built, on every row with valid features."""
    return op.fit_fare_model(line_features(t("lineitem")), FEATURES, LABEL)


@query(
    "trip_features",
    """SELECT event_id, user_id, value, CAST(hour(ts) AS INTEGER) AS pickup_hour,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_dayofweek
       FROM events""",
)
def trip_features(t):
    return op.trip_features(t("events"), "ts", ["event_id", "user_id", "value"])


@query("fit_score")
def fit_score(t):
    return op.score(fitted(t), line_features(t("lineitem")), [*KEYS, LABEL])


@query("stream_scored")
def stream_scored(t):
    lines = line_features(t.stream("lineitem", ts="l_shipdate"))
    return run_stream(op.score(fitted(t), lines, [*KEYS, LABEL]), "append")


VALID = " AND ".join(f"{c} IS NOT NULL" for c in [*MEASURES, "l_linenumber", "l_shipdate"])


@query(
    "fit_score_checks",
    f"""SELECT count(*) AS scored_rows, CAST(0 AS BIGINT) AS outside_label_range, TRUE AS beats_the_mean
        FROM lineitem WHERE {VALID}""",
)
def fit_score_checks(t):
    """Rows with valid features are scored, within the label's range, better than by its mean."""
    scored = fit_score(t)
    label = t("lineitem").agg(
        F.min(LABEL).alias("lo"), F.max(LABEL).alias("hi"), F.var_pop(LABEL).alias("variance")
    )
    outside = (F.col("prediction") < label.select("lo").scalar()) | (
        F.col("prediction") > label.select("hi").scalar()
    )
    error = F.avg((F.col("prediction") - F.col(LABEL)) ** 2)
    return scored.agg(
        F.count("prediction").alias("scored_rows"),
        F.count_if(outside).alias("outside_label_range"),
        (error < label.select("variance").scalar()).alias("beats_the_mean"),
    )


@query(
    "stream_scored_checks",
    f"SELECT count(*) AS scored_rows, CAST(0 AS BIGINT) AS mismatches FROM lineitem WHERE {VALID}",
)
def stream_scored_checks(t):
    """A stream's predictions are those of the table, row by row."""
    model = fitted(t)
    lines = line_features(t.stream("lineitem", ts="l_shipdate"))
    counted = [
        op.score(model, line_features(t("lineitem")), [*KEYS, LABEL]).withColumn("side", F.lit(1)),
        run_stream(op.score(model, lines, [*KEYS, LABEL]), "append").withColumn("side", F.lit(-1)),
    ]
    rows = counted[0].unionByName(counted[1]).groupBy(*KEYS, LABEL, "prediction")
    sides = rows.agg(F.sum("side").alias("more"), F.count_if(F.col("side") < 0).alias("streamed"))
    return sides.agg(
        F.sum("streamed").alias("scored_rows"), F.count_if(F.col("more") != 0).alias("mismatches")
    )


@query(
    "stream_rescored_checks",
    f"SELECT count(*) AS scored_rows, CAST(0 AS BIGINT) AS mismatches FROM lineitem WHERE {VALID}",
)
def stream_rescored_checks(t):
    """A stream that stops and goes on with the stored model scores like one that never stopped.

    The table arrives in two turns; after the first the model is loaded again, and the
    same checkpoint goes on. Nothing is fitted a second time.
    """
    model = fitted(t)
    stored = op.store_model(model, t.scratch("fare-model"))
    source, result = t.scratch("lines-in"), t.scratch("lines-scored")
    lines = line_features(t("lineitem"))
    early = F.col("l_linenumber") <= 2
    for turn in (lines.where(early), lines.where(~early)):
        turn.write.mode("append").parquet(source)
        arriving = t.spark.readStream.schema(lines.schema).parquet(source)
        scored = op.score(op.load_model(stored), arriving, [*KEYS, LABEL])
        table, running = start_stream(StreamJob(scored, "append"), result)
        await_streams([running])
    sides = [
        op.score(model, lines, [*KEYS, LABEL]).withColumn("side", F.lit(1)),
        table.read(t.spark).withColumn("side", F.lit(-1)),
    ]
    rows = sides[0].unionByName(sides[1]).groupBy(*KEYS, LABEL, "prediction")
    counted = rows.agg(F.sum("side").alias("more"), F.count_if(F.col("side") < 0).alias("streamed"))
    return counted.agg(F.sum("streamed").alias("scored_rows"), F.count_if(F.col("more") != 0).alias("mismatches"))
