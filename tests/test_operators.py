"""Operators against exact small results, pandas, and brute force."""

import math
import uuid
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark import operators as op
from waymark.functions import (
    day_of_week,
    draw,
    draw_digits,
    draw_double,
    draw_int,
    draw_word,
    hour_of_day,
    parse_timestamp,
    ratio,
    round_half_even,
    split_field,
    weekday,
    whole_number,
)
from waymark.operators.model import even_parts

NAN = float("nan")


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0]


# --- scalars -----------------------------------------------------------------


def test_ratio(spark):
    row = one(spark, ratio(F.lit(7), F.lit(2)), ratio(F.lit(7.0), F.lit(0)), ratio(F.lit(None), F.lit(2)))
    assert tuple(row) == (3.5, None, None)


def test_weekday_numberings(spark):
    rows = spark.createDataFrame(
        [(datetime(2015, 1, 4, 23, 59),), (datetime(2015, 1, 5),)], "ts TIMESTAMP"
    ).select(day_of_week("ts"), weekday("ts"), hour_of_day("ts"))
    assert [tuple(r) for r in rows.collect()] == [(1, 6, 23), (2, 0, 0)]


def test_split_field(spark):
    text = F.lit("a.b..d")
    row = one(spark, *[split_field(text, ".", i) for i in (0, 2, 3, 4)])
    assert tuple(row) == ("a", "", "d", None)


def test_parse_timestamp(spark):
    row = one(
        spark,
        parse_timestamp(F.lit("2015-01-04 05:06:07")),
        parse_timestamp(F.lit("not a time")),
        parse_timestamp(F.lit("04/01/2015"), "dd/MM/yyyy"),
    )
    assert tuple(row) == (datetime(2015, 1, 4, 5, 6, 7), None, datetime(2015, 1, 4))


def test_numbers(spark):
    row = one(
        spark,
        whole_number(F.lit(2.9)),
        whole_number(F.lit(-2.9)),
        whole_number(F.lit(NAN)),
        whole_number(F.lit(1e12)),
        round_half_even(F.lit(0.125), 2),
        round_half_even(F.lit(0.375), 2),
    )
    assert tuple(row) == (2, -2, None, None, 0.12, 0.38)


# --- draws -------------------------------------------------------------------


def test_draws_do_not_depend_on_partitioning(spark):
    columns = [draw("id", 7), draw_word("id", 4, 6, "burg", 7, 1), draw_digits("id", 6, 7, 3)]
    few = spark.range(0, 1000, 1, 2).select("id", *columns)
    many = spark.range(0, 1000, 1, 9).repartition(5).select("id", *columns)
    assert sorted(few.collect()) == sorted(many.collect())


def test_draws_are_uniform_and_in_range(spark):
    n = 20_000
    ids = spark.range(10**12, 10**12 + n)
    drawn = ids.select(
        draw_int("id", -3, 5, 1).alias("i"),
        draw_double("id", 2.0, 4.0, 1, 1).alias("d"),
        draw_int(["id", F.lit(-9)], 0, 10, 1, 2).alias("k"),
    ).toPandas()
    assert sorted(drawn.i.unique()) == list(range(-3, 5))
    assert drawn.d.min() >= 2.0 and drawn.d.max() < 4.0
    for counts in (drawn.i.value_counts(), drawn.k.value_counts(), pd.cut(drawn.d, 10).value_counts()):
        expected = n / len(counts)
        assert ((counts - expected) ** 2 / expected).sum() < 45
    assert abs(np.corrcoef(drawn.i, drawn.d)[0, 1]) < 0.03


def test_draws_are_uniform_in_the_tail(spark):
    n = 10_000_000
    x = spark.range(n).select(draw("id", 42).alias("x"))
    fractions = [10.0**-e for e in range(2, 7)]
    below = [F.count_if(F.col("x") < int(f * 2**32)).alias(f"f{i}") for i, f in enumerate(fractions)]
    row = x.agg(F.count_if(F.col("x") == 0).alias("zeros"), *below).first()
    assert row.zeros <= 2
    for i, f in enumerate(fractions):
        expected = n * f
        assert abs(row[f"f{i}"] - expected) < 5 * (expected * (1 - f)) ** 0.5


def test_synthetic_cities(spark):
    for country, suffix, top in (("DE", "burg", 900), ("FR", "ville", 110)):
        cities = op.synth_cities(spark, 3000, country, seed=5).toPandas()
        stems = cities.CityName.str.removesuffix(suffix)
        assert cities.CityName.str.endswith(suffix).all()
        assert set(stems.str.len()) == {4, 5, 6}
        assert stems.str.fullmatch("[a-z]+").all()
        assert cities.Population.between(0, 3_999_999).all()
        assert cities.Area.between(20, top).all() and cities.Area.max() > 0.95 * top
        assert (cities.Area.round(2) == cities.Area).all()
        assert cities.CulturalSites.between(0, 99).all()
        assert cities.CityID.str.fullmatch("[0-9]{6}").all()
        assert cities.equals(op.synth_cities(spark, 3000, country, seed=5).toPandas())
        assert not cities.equals(op.synth_cities(spark, 3000, country, seed=6).toPandas())


def test_extended_cities_keep_real_rows(spark):
    real = spark.createDataFrame(
        [(1, "Berlin", 3644826.0), (2, "Blank", None)], "id LONG, CityName STRING, Population DOUBLE"
    )
    cities = op.extend_cities(real, spark.range(1, 11), "id", "DE")
    rows = {r.CityName: r for r in cities.collect()}
    assert cities.count() == 12
    assert (rows["Berlin"].Population, rows["Blank"].Population) == (3644826, 0)
    assert cities.columns == ["CityName", "Population", "Area", "CulturalSites", "CityID"]


# --- shaping -----------------------------------------------------------------


def test_null_handling(spark):
    df = spark.createDataFrame(
        [(1, 2.7, "a"), (2, NAN, "b"), (3, None, "c"), (4, -1.2, None)], "i INT, x DOUBLE, s STRING"
    )
    assert [r.i for r in op.drop_incomplete_rows(df).collect()] == [1]
    assert [r.i for r in op.drop_incomplete_rows(df, ["s"]).collect()] == [1, 2, 3]
    filled = op.fill_and_cast(df, {"x": 0}, {"x": "int"})
    assert [r.x for r in filled.collect()] == [2, 0, 0, -1]
    assert [r.i for r in op.keep_null(df, "x").collect()] == [3]
    assert [r.i for r in op.keep_where(df, "s < 'c'").collect()] == [1, 2]
    profile = {r.column: r.null_count for r in op.null_profile(df).collect()}
    assert profile == {"i": 0, "x": 1, "s": 1}
    assert tuple(op.table_shape(df).collect()[0]) == (4, 3)
    assert op.column_list(df) == ["i", "x", "s"]
    assert op.numeric_columns(df) == ["i", "x"]
    assert op.select_exprs(df, "i + 1 AS j").columns == ["j"]
    assert op.rename_columns(df, {"i": "k", "none": "z"}).columns == ["k", "x", "s"]
    assert op.drop_columns(df, ["x", "none"]).columns == ["i", "s"]


def test_extend_rows_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i INT, s STRING")
    b = spark.createDataFrame([("y", 2.5)], "s STRING, d DOUBLE")
    rows = op.extend_rows(a, b).collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (None, "y", 2.5)]


# --- aggregates --------------------------------------------------------------


def test_group_counts_keep_the_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,), ("a",), (None,)], "k STRING")
    assert [tuple(r) for r in op.group_count(df, "k").collect()] == [(None, 3), ("a", 2), ("b", 1)]


def test_averages_skip_nulls_per_column(spark):
    df = spark.createDataFrame([(1, 10.0), (None, 20.0), (3, None)], "a INT, b DOUBLE")
    wide = op.column_stats(df, ["a", "b"], "avg").collect()[0]
    assert tuple(wide) == (2.0, 15.0)
    rows = op.averages_long(df, ["a", "b"]).collect()
    assert {r.attribute: r.average_value for r in rows} == {"a": 2.0, "b": 15.0}
    whole_rows = op.column_stats(op.drop_incomplete_rows(df), ["a", "b"], "avg").collect()[0]
    assert tuple(whole_rows) == (1.0, 10.0)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a INT, b DOUBLE, s STRING")
    assert tuple(op.table_summary(empty, "a", "b", "s").collect()[0]) == (None, None, None, None, 0)
    assert [r.row_count for r in op.histogram(empty, "b").collect()] == [0] * 10
    assert [r["corr"] for r in op.correlation_matrix(empty).collect()] == [None] * 4
    assert [r.value_count for r in op.describe_long(empty).collect()] == [0] * 3


def test_describe_matches_spark(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "7", "x"), (2, None, " 8 ", "y"), (4, -2.0, "abc", None), (5, 0.25, "-1e2", "x")],
        "i INT, d DOUBLE, n STRING, s STRING",
    ).withColumn("ts", F.current_timestamp())
    ours = {r.column: r for r in op.describe_long(df).collect()}
    spark_rows = {r.summary: r for r in op.describe_text(df.drop("n")).collect()}
    assert list(ours) == ["i", "d", "n", "s"]
    for c in ("i", "d", "s"):
        row = ours[c]
        assert str(row.value_count) == spark_rows["count"][c]
        low = row.min_text if c == "s" else row.min_number
        assert str(low) == spark_rows["min"][c] or float(spark_rows["min"][c]) == low
        if c != "s":
            assert row["mean"] == pytest.approx(float(spark_rows["mean"][c]))
            assert row["stddev"] == pytest.approx(float(spark_rows["stddev"][c]))
    assert ours["n"]["mean"] == pytest.approx((7 + 8 - 100) / 3)
    assert ours["s"]["mean"] is None


# --- correlation and histogram -----------------------------------------------


def matrix(spark, frame):
    rows = op.correlation_matrix(frame).collect()
    return {(r.col_x, r.col_y): r["corr"] for r in rows}


def test_correlation_fixture(spark):
    df = spark.createDataFrame(
        [(1, 2.0, 5), (2, None, 5), (3, 7.0, 5), (4, 6.0, 5)], "x INT, y DOUBLE, c INT"
    )
    found = matrix(spark, df)
    assert found["x", "y"] == found["y", "x"] == pytest.approx(0.866025, abs=1e-6)
    assert found["x", "x"] == pytest.approx(1.0)
    assert found["x", "c"] is None and found["c", "c"] is None
    assert set(matrix(spark, df.limit(1)).values()) == {None}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(*[st.one_of(st.none(), st.integers(-50, 50)) for _ in range(3)]),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([0, 10**9]),
)
def test_correlation_matches_pandas(spark, rows, offset):
    rows = [tuple(None if v is None else float(v + offset) for v in row) for row in rows]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE").repartition(3)
    found = matrix(spark, df)
    expected = pd.DataFrame(rows, columns=list("abc"), dtype=float).corr(min_periods=2)
    for x in "abc":
        for y in "abc":
            if math.isnan(expected[x][y]):
                assert found[x, y] is None
            else:
                assert found[x, y] == pytest.approx(expected[x][y], abs=1e-6)


def test_histogram_fixture(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.99, 1.0, 9.99, 10.0, None, NAN)], "v DOUBLE")
    rows = sorted(op.histogram(df, "v").collect())
    assert [r.row_count for r in rows] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    assert (rows[0].low, rows[9].high) == (0.0, 10.0)


def test_histogram_of_one_value(spark):
    rows = sorted(op.histogram(spark.range(7).select(F.lit(3).alias("v")), "v").collect())
    assert [r.row_count for r in rows] == [0, 0, 0, 0, 0, 7, 0, 0, 0, 0]
    assert (rows[0].low, rows[9].high) == (2.5, 3.5)


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(3).normal(50, 20, 5000).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    for bins in (1, 7, 10):
        rows = sorted(op.histogram(df, "v", bins).collect())
        counts, edges = np.histogram(values, bins)
        assert [r.row_count for r in rows] == counts.tolist()
        assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())


# --- full outer join ---------------------------------------------------------


def brute_force_pairs(left, right):
    by_key = defaultdict(list)
    for key, name in right:
        by_key[key].append(name)
    left_keys = {key for key, _ in left}
    pairs = Counter()
    for key, name in left:
        partners = by_key[key] if key is not None and by_key[key] else [None]
        pairs.update((name, partner) for partner in partners)
    pairs.update((None, n) for k, n in right if k is None or k not in left_keys)
    return pairs


def join(spark, left, right, **slicing):
    l = spark.createDataFrame(left, "k INT, name STRING")
    r = spark.createDataFrame(right, "k INT, name STRING")
    joined = op.full_outer_pair(l, r, "k", {"name": "a"}, {"name": "b"}, **slicing)
    return Counter((row.a, row.b) for row in joined.collect())


HOT = 1
LEFT = [(HOT, f"l{i}") for i in range(60)] + [(None, f"ln{i}") for i in range(30)]
LEFT += [(2, f"l2-{i}") for i in range(40)] + [(i, f"lx{i}") for i in range(10, 20)]
RIGHT = [(HOT, f"r{i}") for i in range(25)] + [(None, f"rn{i}") for i in range(12)]
RIGHT += [(3, f"r3-{i}") for i in range(40)] + [(i, f"rx{i}") for i in range(15, 25)]


@pytest.mark.parametrize("rows_per_slice", [1, 4, 7, 50, 1000])
def test_full_outer_pair_with_hot_keys(spark, rows_per_slice):
    expected = brute_force_pairs(LEFT, RIGHT)
    assert join(spark, LEFT, RIGHT, rows_per_slice=rows_per_slice) == expected


def test_full_outer_pair_with_exact_copies(spark):
    left = [(HOT, "same")] * 50 + [(2, "x")]
    right = [(HOT, "r")] * 30 + [(5, "y")] * 20
    expected = brute_force_pairs(left, right)
    assert join(spark, left, right, rows_per_slice=8) == expected


def test_full_outer_pair_of_nulls_only(spark):
    left, right = [(None, f"l{i}") for i in range(20)], [(None, f"r{i}") for i in range(20)]
    expected = brute_force_pairs(left, right)
    assert join(spark, left, right, rows_per_slice=5) == expected
    assert join(spark, left, [], rows_per_slice=5) == brute_force_pairs(left, [])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=40),
    st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=40),
    st.integers(1, 12),
)
def test_full_outer_pair_property(spark, left_keys, right_keys, rows_per_slice):
    left = [(k, f"l{i}") for i, k in enumerate(left_keys)]
    right = [(k, f"r{i}") for i, k in enumerate(right_keys)]
    expected = brute_force_pairs(left, right)
    assert join(spark, left, right, rows_per_slice=rows_per_slice) == expected


def test_many_hot_keys_are_all_sliced(spark):
    keys = spark.range(3000).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20))))
    left = keys.select((F.col("id") + 1000).alias("k"), F.concat_ws("-", "id", "copy").alias("name"))
    right = keys.select(F.col("id").alias("k"), F.concat_ws("+", "id", "copy").alias("name"))
    pair = op.prepare_pair(left, right, "k", rows_per_slice=5)
    sliced = pair.left.groupBy("k").agg(F.countDistinct("left_slice").alias("n")).where("n > 1").count()
    assert sliced == 3000
    joined = op.full_outer_pair(left, right, "k", {"name": "a"}, {"name": "b"}, rows_per_slice=5)
    row = joined.agg(F.count("*").alias("n"), F.count("a").alias("a"), F.count("b").alias("b")).first()
    assert (row.n, row.a, row.b) == (2000 * 400 + 2 * 20_000, 2000 * 400 + 20_000, 2000 * 400 + 20_000)


def test_hot_keys_are_spread(spark):
    l = spark.range(5000).select(F.lit(1).alias("k"), "id")
    r = spark.range(10).select(F.lit(1).alias("k"), "id")
    pair = op.prepare_pair(l, r, "k", rows_per_slice=100)
    cells = pair.left.groupBy("left_slice", "right_slice").count().collect()
    assert len(cells) == 50 and max(c["count"] for c in cells) < 200
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("s"))
    spread = op.prepare_pair(copies, copies, "k", rows_per_slice=100).left
    assert spread.select("left_slice").distinct().count() > 4
    nulls = copies.withColumn("k", F.lit(None).cast("int"))
    spread = op.prepare_pair(nulls, copies, "k", rows_per_slice=100).left
    assert spread.select("left_slice").distinct().count() == 8
    text_keys = l.withColumn("k", F.lit("hot")), r.withColumn("k", F.lit("hot"))
    assert op.full_outer_pair(
        *text_keys, "k", {"id": "a"}, {"id": "b"}, rows_per_slice=100
    ).count() == 50_000


# --- order, samples, trips ---------------------------------------------------


def test_sorts_and_top_k(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "a"), (2, None, "b"), (3, 5.0, "c"), (4, 9.0, "d")], "id INT, v DOUBLE, s STRING"
    )
    ordered = op.sorted_projection(df, ["s", "v"], "v", ["id"])
    assert [tuple(r) for r in ordered.collect()] == [("d", 9.0), ("a", 5.0), ("c", 5.0), ("b", None)]
    assert [r.id for r in op.top_k(df, "v", 2, ["id"]).collect()] == [4, 1]
    series = op.top_k_series(df, "s", "id", "v", 3, ["id"])
    assert [tuple(r) for r in series.collect()] == [("d", 4), ("a", 1), ("c", 3)]


def test_extreme_groups_overlap_when_few(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (3.0,)], "v DOUBLE")
    assert [tuple(r) for r in op.extreme_groups(df, "v", 2, "smallest").collect()] == [(1.0, 2), (2.0, 1)]
    union = op.extremes_union(df, "v", 2).collect()
    assert Counter(tuple(r) for r in union) == Counter([(1.0, 2), (2.0, 1), (3.0, 1), (2.0, 1)])
    with pytest.raises(ValueError):
        op.extreme_groups(df, "v", 2, "middle")


def test_samples(spark):
    df = spark.range(0, 20_000, 1, 4)
    seeded = op.seeded_sample(df, 0.05, 42)
    assert sorted(seeded.collect()) == sorted(op.seeded_sample(df, 0.05, 42).collect())
    hashed = op.hash_sample(df, ["id"], 0.05, 42)
    again = op.hash_sample(df.repartition(7), ["id"], 0.05, 42)
    assert sorted(hashed.collect()) == sorted(again.collect())
    for sample in (seeded, hashed):
        rows = sample.collect()
        assert 850 < len(rows) < 1150 and len(set(rows)) == len(rows)
    assert op.hash_sample(df, ["id"], 1.0, 1).count() == 20_000
    assert op.hash_sample(df, ["id"], 0.0, 1).count() == 0
    assert op.point_set(df.selectExpr("id", "id * 2 AS b"), "id", "b").columns == ["x", "y"]


def test_trip_tables(spark):
    df = spark.createDataFrame(
        [(7, 1.0, 2.0, 3.0, 4.0)],
        "id INT, pickup_latitude DOUBLE, pickup_longitude DOUBLE, "
        "dropoff_latitude DOUBLE, dropoff_longitude DOUBLE",
    )
    ends = op.trip_endpoints(df, ["id"]).collect()
    assert [tuple(r) for r in ends] == [(7, "Pickup", 1.0, 2.0), (7, "Dropoff", 3.0, 4.0)]
    legs = op.trip_legs(df, ["id"])
    assert legs.dtypes[1] == ("leg", "array<struct<lat:double,lon:double>>")
    assert [tuple(p) for p in legs.collect()[0].leg] == [(1.0, 2.0), (3.0, 4.0)]


# --- model -------------------------------------------------------------------


def test_fare_model_learns_and_skips_invalid_rows(spark):
    trips = spark.range(400).selectExpr(
        "timestamp'2015-01-01' + make_interval(0, 0, 0, 0, int(id % 48), 0, 0) AS ts",
        "IF(id = 5, NULL, double(id % 10)) AS dist",
        "double(id % 10) * 3 + 2 AS total",
    )
    features = op.trip_features(trips, "ts", ["dist", "total"])
    assert features.columns == ["dist", "total", "pickup_hour", "pickup_dayofweek"]
    model = op.fit_fare_model(features, ["dist", "pickup_hour", "pickup_dayofweek"], "total")
    scored = op.score(model, features, ["total"]).toPandas()
    assert len(scored) == 399
    assert np.corrcoef(scored.total, scored.prediction)[0, 1] > 0.9


def test_fare_model_bounds_the_rows_of_a_task(spark):
    """One part of copies, nulls and NaN is dealt out; the same rows give the same trees each time."""
    trips = spark.range(4000, numPartitions=1).selectExpr(
        "IF(id = 5, NULL, IF(id = 6, double('NaN'), double(id % 10))) AS dist",
        "IF(id < 2000, 1, id % 24) AS hour",
        "IF(id = 7, NULL, double(id % 10) * 3 + id % 7) AS total",
    )

    def fitted(rows, **limits):
        group = f"fit-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "fit")
        model = op.fit_fare_model(rows, ["dist", "hour"], "total", **limits)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tracker = spark.sparkContext.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
        widest = max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)
        return model.stages[-1].toDebugString.split("\n", 1)[1], widest

    bounded = fitted(trips, rows_per_task=500)
    assert bounded[1] == 8 and bounded == fitted(trips, rows_per_task=500)
    assert fitted(trips)[1] < 8
    assert len(op.score(op.fit_fare_model(trips, ["dist", "hour"], "total", rows_per_task=500), trips, ["total"]).collect()) == 3998


def test_even_parts_keep_every_row(spark):
    rows = spark.range(1000, numPartitions=1).selectExpr("IF(id % 3 = 0, NULL, 7) AS a", "id % 2 AS b")
    dealt = even_parts(rows, 100)
    parts = dealt.rdd.glom().map(lambda part: [tuple(r) for r in part]).collect()
    assert len(parts) == 10 and max(map(len, parts)) <= 101
    assert parts == even_parts(rows, 100).rdd.glom().map(lambda part: [tuple(r) for r in part]).collect()
    assert sorted(map(str, sum(parts, []))) == sorted(str(tuple(r)) for r in rows.collect())
    assert even_parts(rows, 1000) is rows and even_parts(rows.where("b > 1"), 1).count() == 0
