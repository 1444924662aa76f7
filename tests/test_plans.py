"""Physical plans: what is read, pushed down, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from waymark import operators as op
from waymark import session
from waymark.plans import live
from waymark.sources import read_table, stream_table
from waymark.streaming import runner

ROOT = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def registered(spark, name):
    return plan(contract.queries()[name](spark, ROOT))


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("avg_by_hour", {"ts", "value"}),
        ("group_count_desc", {"event_type"}),
        ("ratio_column", {"p_partkey", "p_retailprice", "p_size"}),
        ("table_summary", {"p_partkey", "p_retailprice", "p_size"}),
        ("top_k_series", {"p_name", "p_size", "p_retailprice", "p_partkey"}),
        ("count_by_quantity", {"l_quantity"}),
        ("filter_high", {"event_id", "ts", "user_id", "value"}),
        ("points_tip_fare", {"l_discount", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"}),
    ],
)
def test_scans_read_only_the_columns_in_use(spark, name, columns):
    assert all(read == columns for read in read_columns(registered(spark, name)))


def final_plan(df):
    df.collect()
    return plan(df)


def test_join_shuffles_wide_rows_once(spark):
    df = contract.queries()["full_outer_pair"](spark, ROOT)
    text, initial = final_plan(df).split("Initial Plan")
    assert "SortMergeJoin" in text and "CartesianProduct" not in text
    wide = [line for line in re.findall(r"Exchange hashpartitioning\(([^\n]*)", text) if "_slice" in line]
    assert len(wide) == 2  # one for each side, by key and slices
    assert {"l_orderkey", "l_extendedprice", "l_linestatus"} in read_columns(text)
    assert "partial_count" in initial  # no key is hot, so the final plan has dropped the counts


def test_hot_keys_are_counted_in_the_plan(spark):
    text = final_plan(contract.queries()["full_outer_hot_pair"](spark, ROOT)).split("Initial Plan")[0]
    assert "partial_count" in text


def test_stored_buckets_are_joined_where_they_are(spark):
    df = contract.queries()["full_outer_stored_pair"](spark, ROOT)
    text = final_plan(df).split("Initial Plan")[0]
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("Bucketed: true") == 2


def test_filters_are_pushed_down(spark):
    assert "GreaterThan(value,50.0)" in registered(spark, "filter_high")


def test_top_k_is_not_a_full_sort(spark):
    for name in ("top_k_series", "shortest_groups", "longest_trip_legs"):
        text = registered(spark, name)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_full_sort_is_range_partitioned_by_a_unique_order(spark):
    text = registered(spark, "sorted_projection")
    assert re.search(r"rangepartitioning\(p_retailprice#\d+ DESC NULLS LAST, p_partkey#", text)


def test_one_pass_profiles(spark):
    for name in ("null_profile", "averages_long", "column_averages"):
        text = registered(spark, name)
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    numbers, texts = read_columns(registered(spark, "describe_long"))
    assert numbers == {"event_id", "user_id", "value"} and texts == {"event_type", "props"}


def test_correlation_reads_the_table_once(spark):
    text = plan(op.correlation_matrix(read_table(spark, ROOT, "lineitem")))
    assert text.count("FileScan") == 1
    assert text.count("hashpartitioning(i#") >= 1


# Streams and fits run while the query is built, so their result is a plain scan; the
# streaming plans are read from the running queries below.
BUILT = ("stream_", "fit_score")
CORPUS = getattr(contract.corpus_plans(), "QUERIES", {})


@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if not n.startswith(BUILT) and n not in CORPUS))
def test_no_cross_joins(spark, name):
    text = registered(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


STREAMS = sorted(n for n in contract.queries() if n.startswith("stream_") and not n.endswith("_checks"))


@pytest.mark.parametrize("name", STREAMS)
def test_no_cross_joins_in_streams(spark, name, monkeypatch):
    plans = []
    wait = runner.await_streams

    def waited(queries):
        wait(queries)
        plans.extend(q._jsq.explainInternal(False) for q in queries)

    monkeypatch.setattr(runner, "await_streams", waited)
    monkeypatch.setattr(live, "await_streams", waited)
    contract.queries()[name](spark, ROOT)
    assert plans and all("Scan" in text for text in plans)
    assert not any("CartesianProduct" in text or "NestedLoop" in text for text in plans)


def test_histogram_scans_twice(spark):
    text = final_plan(contract.queries()["histogram"](spark, ROOT)).split("Initial Plan")[0]
    assert text.count("FileScan") - text.count("ReusedSubquery") <= 2


def test_group_keys_are_aggregated_before_the_shuffle(spark):
    text = registered(spark, "avg_by_type")
    assert "partial_avg" in text


def test_tables_may_be_directories(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "things.parquet"))
    spark.range(5).write.parquet(str(tmp_path / "things.parquet2"))
    assert read_table(spark, str(tmp_path), "things").count() == 10
    counts = []
    query = (
        stream_table(spark, str(tmp_path), "things")
        .writeStream.foreachBatch(lambda batch, _: counts.append(batch.count()))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    assert sum(counts) == 10


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = session.fresh_dir(spark, "x")
    assert path.startswith(f"{root}/waymark/x-") and path != session.fresh_dir(spark, "x")


def test_drop_incomplete_with_subset_keeps_pruning(spark):
    events = read_table(spark, ROOT, "events")
    clean = op.drop_incomplete_rows(events, ["ts", "value"])
    text = plan(clean.groupBy(F.hour("ts")).agg(F.avg("value")))
    assert read_columns(text) == [{"ts", "value"}]
