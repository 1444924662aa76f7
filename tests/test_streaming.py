"""Streams against exact results, late rows, replays and restarts."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waymark.operators import (
    both_ends,
    column_stats,
    count_by,
    drop_incomplete_rows,
    end_groups,
    extreme_groups,
    extremes_union,
    group_avg,
    keep_where,
    merged_counts,
    window_sum,
)
from waymark.sources import stream_csv
from waymark.streaming import (
    Output,
    StreamJob,
    StreamTable,
    run_fan_out,
    run_stream,
    run_streams,
    start_fan_out,
    start_stream,
    stream_snapshot,
)

SCHEMA = "id INT, ts TIMESTAMP, dist DOUBLE, fare DOUBLE, pax INT"
HEADER = "id,ts,dist,fare,pax"
FILES = [
    ["1,2015-01-01 00:05:00,1.5,10,1", "2,2015-01-01 00:55:00,2.5,60,2"],
    ["3,2015-01-01 05:00:00,3.5,20,3", "4,,1.0,5,1"],
    ["5,2015-01-01 00:10:00,1.5,99,4", "6,2015-01-01 05:10:00,9.5,7,2"],
    ["7,2015-01-01 00:20:00,1.5,1,4", "8,2015-01-01 05:20:00,9.5,7,2"],
]


def add_file(folder, i):
    path = folder / f"f{i}.csv"
    path.write_text("\n".join([HEADER, *FILES[i]]) + "\n")
    os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "trips"
    source.mkdir()
    return source


@pytest.fixture
def trips(spark, folder):
    for i in range(len(FILES)):
        add_file(folder, i)
    return drop_incomplete_rows(stream_csv(spark, str(folder), SCHEMA, max_files=1))


def at(hour, minute=0):
    return datetime(2015, 1, 1, hour, minute)


def test_watermark_drops_rows_that_come_too_late(trips):
    sums = window_sum(trips, "ts", "1 hour", "fare", "total", watermark="1 hour")
    result = run_stream(sums, "update", ["start_time", "end_time"])
    rows = {r.start_time: r.total for r in result.collect()}
    assert rows == {at(0): 169.0, at(5): 34.0}  # id 7 is late


def test_update_mode_keeps_every_revision_until_read(spark, trips):
    sums = window_sum(trips, "ts", "1 hour", "fare", "total", watermark="1 hour")
    table, query = start_stream(StreamJob(sums, "update", ["start_time", "end_time"]))
    query.awaitTermination(120)
    revisions = spark.read.parquet(table.data).orderBy("batch_id", "start_time").collect()
    by_window = {}
    for r in revisions:
        by_window.setdefault(r.start_time, []).append(r.total)
    assert by_window == {at(0): [70.0, 169.0], at(5): [20.0, 27.0, 34.0]}


def test_append_mode_emits_closed_windows_only(trips):
    sums = window_sum(trips, "ts", "1 hour", "fare", "total", watermark="1 hour")
    rows = run_stream(sums, "append").collect()
    assert [(r.start_time, r.total) for r in rows] == [(at(0), 169.0)]


def test_ten_minute_windows_without_watermark(trips):
    sums = window_sum(trips, "ts", "10 minutes", "pax", "passengers")
    result = run_stream(sums, "update", ["start_time", "end_time"])
    rows = {r.start_time: r.passengers for r in result.collect()}
    assert rows == {
        at(0): 1,
        at(0, 10): 4,
        at(0, 20): 4,
        at(0, 50): 2,
        at(5): 3,
        at(5, 10): 2,
        at(5, 20): 2,
    }


def test_running_averages(trips):
    row = run_stream(column_stats(trips, ["pax", "fare"], "avg"), "complete").collect()[0]
    assert row.avg_pax == pytest.approx(18 / 7)
    assert row.avg_fare == pytest.approx(204 / 7)


def test_running_extremes(spark, trips):
    ends = {w: extreme_groups(trips, "dist", 2, w) for w in ("smallest", "largest")}
    results = run_streams({w: StreamJob(df, "complete") for w, df in ends.items()})
    smallest = [tuple(r) for r in results["smallest"].collect()]
    largest = [tuple(r) for r in results["largest"].collect()]
    assert sorted(smallest) == [(1.5, 3), (2.5, 1)]
    assert sorted(largest) == [(3.5, 1), (9.5, 2)]
    job = StreamJob(
        count_by(trips, "dist"), "complete", refine=lambda batch: both_ends(batch, 2)
    )
    union = run_streams({"union": job})["union"]
    assert sorted(tuple(r) for r in union.collect()) == sorted(smallest + largest)
    native = run_stream(extremes_union(trips, "dist", 2), "complete")
    assert sorted(tuple(r) for r in native.collect()) == sorted(smallest + largest)


def test_filter_and_group_averages(trips):
    high = run_stream(keep_where(trips, "fare > 50").select("id", "fare"), "append")
    assert sorted(r.id for r in high.collect()) == [2, 5]
    hourly = run_stream(group_avg(trips, F.hour("ts").alias("hour"), "fare", "avg_fare"), "complete")
    rows = {r.hour: r.avg_fare for r in hourly.collect()}
    assert rows == {0: 42.5, 5: pytest.approx(34 / 3)}


def test_snapshot_is_a_view(spark, trips):
    stream_snapshot(trips, "test_snapshot")
    assert spark.sql("SELECT count(*) AS n FROM test_snapshot").collect()[0].n == 7


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_restart_resumes_from_the_checkpoint(spark, folder, tmp_path, mode):
    path = str(tmp_path / "result")

    def drain():
        rows = drop_incomplete_rows(stream_csv(spark, str(folder), SCHEMA, max_files=1))
        df = rows.select("id") if mode == "append" else count_by(rows, "dist")
        keys = ["dist"] if mode == "update" else []
        table, query = start_stream(StreamJob(df, mode, keys), path)
        query.awaitTermination(120)
        result = table.read(spark)
        return sorted(tuple(r) for r in result.collect())

    assert drain() == []
    add_file(folder, 0)
    add_file(folder, 1)
    first = drain()
    add_file(folder, 2)
    add_file(folder, 3)
    second = drain()
    if mode == "append":
        assert (first, second) == ([(1,), (2,), (3,)], [(i,) for i in (1, 2, 3, 5, 6, 7, 8)])
    else:
        assert first == [(1.5, 1), (2.5, 1), (3.5, 1)]
        assert second == [(1.5, 3), (2.5, 1), (3.5, 1), (9.5, 2)]


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_a_replayed_batch_changes_nothing(spark, tmp_path, mode):
    df = spark.createDataFrame([(1, 10.0), (2, None)], "k INT, v DOUBLE")
    newer = spark.createDataFrame([(1, None), (2, 5.0)], "k INT, v DOUBLE")
    table = StreamTable(str(tmp_path / "t"), df.schema, mode, ("k",))
    for batch, batch_id in [(df, 0), (newer, 1), (newer, 1)]:
        table.write_batch(batch, batch_id)
    assert sorted(tuple(r) for r in table.read(spark).collect()) == [(1, None), (2, 5.0)]


def test_an_empty_newest_result_is_read_as_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, 10.0)], "k INT, v DOUBLE")
    table = StreamTable(str(tmp_path / "t"), df.schema, "complete")
    assert table.read(spark).count() == 0
    table.write_batch(df, 0)
    assert table.read(spark).count() == 1
    table.write_batch(df.where("k > 1"), 1)
    assert table.read(spark).count() == 0


def test_a_held_frame_keeps_its_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 10.0)], "k INT, v DOUBLE")
    table = StreamTable(str(tmp_path / "t"), df.schema, "complete")
    table.write_batch(df, 0)
    held = table.read(spark)
    for batch_id in (1, 2):
        table.write_batch(df.withColumn("v", F.lit(float(batch_id))), batch_id)
    assert [r.v for r in held.collect()] == [10.0]
    assert [r.v for r in table.read(spark).collect()] == [2.0]
    for batch_id in range(3, 12):
        table.write_batch(df, batch_id)
    assert len(list((tmp_path / "t" / "data").glob("batch_id=*"))) <= 4


def test_half_a_batch_is_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, 10.0)], "k INT, v DOUBLE")
    for mode, keys in (("complete", ()), ("update", ("k",))):
        table = StreamTable(str(tmp_path / mode), df.schema, mode, keys)
        table.write_batch(df, 0)
        df.withColumn("v", F.lit(99.0)).write.parquet(f"{table.data}/batch_id=1")  # without its marker
        assert [r.v for r in table.read(spark).collect()] == [10.0]


def test_revisions_are_compacted(spark, tmp_path):
    schema = "k INT, v DOUBLE"
    frame = lambda i: spark.createDataFrame([(i % 7, float(i)), (100, None if i % 2 else float(i))], schema)
    table = StreamTable(str(tmp_path / "t"), frame(0).schema, "update", ("k",), compact_every=5)
    for i in range(50):
        table.write_batch(frame(i), i)
        if i % 5 == 4:
            table.write_batch(frame(i), i)  # a replay of the batch that compacts
    expected = {(k, float(max(i for i in range(50) if i % 7 == k))) for k in range(7)} | {(100, None)}
    assert {tuple(r) for r in table.read(spark).collect()} == expected
    assert len(list((tmp_path / "t" / "data").glob("batch_id=*"))) <= 10
    assert len(list((tmp_path / "t" / "base").glob("folded=*"))) <= 5


def ten_rows(spark, i):
    return spark.createDataFrame([(i * 10 + k, float(i)) for k in range(10)], "k INT, v DOUBLE")


def test_appended_batches_are_never_folded(spark, tmp_path):
    table = StreamTable(str(tmp_path / "t"), ten_rows(spark, 0).schema, "append", compact_every=2)
    assert table.read(spark).count() == 0
    for i in range(6):
        table.write_batch(ten_rows(spark, i), i)
        table.write_batch(ten_rows(spark, i), i)  # a replay
    ten_rows(spark, 9).write.parquet(f"{table.data}/batch_id=6")  # half a batch, without its marker
    assert sorted(r.k for r in table.read(spark).collect()) == list(range(60))
    assert len(os.listdir(tmp_path / "t" / "marks" / "data")) <= 8  # few markers, with their checksum files
    table.write_batch(ten_rows(spark, 6), 6)
    assert table.read(spark).count() == 70


def test_a_refined_append_stream_keeps_its_rows(spark, folder, trips):
    job = StreamJob(trips.select("id", "fare"), "append", refine=lambda batch: batch.where("fare > 5"))
    table, query = start_stream(job)
    query.awaitTermination(120)
    assert not table.native and sorted(r.id for r in table.read(spark).collect()) == [1, 2, 3, 5, 6, 8]


def test_folded_ends_hold_few_rows(spark, tmp_path):
    """Over 45 batches the ends are those of all rows, and no batch stores more than 2k groups."""
    keep = lambda counts: both_ends(counts, 3).distinct()
    every = [[(float((i * 37 + k * 11) % 90),) for k in range(20)] for i in range(45)]
    counts = count_by(spark.createDataFrame(every[0], "dist DOUBLE"), "dist")
    table = StreamTable(str(tmp_path / "t"), counts.schema, "fold")
    merge = lambda known, rows: keep(merged_counts(known, count_by(rows, "dist")))
    for i, rows in enumerate(every):
        table.fold_batch(spark.createDataFrame(rows, "dist DOUBLE"), i, merge)
        if i % 10 == 7:
            table.fold_batch(spark.createDataFrame(rows, "dist DOUBLE"), i, merge)  # a replay counts nothing twice
            assert table.read(spark).count() <= 6
    whole = spark.createDataFrame([x for rows in every for x in rows], "dist DOUBLE")
    assert sorted(map(tuple, table.read(spark).collect())) == sorted(map(tuple, keep(count_by(whole, "dist")).collect()))
    assert len(list((tmp_path / "t" / "data").glob("batch_id=*"))) <= 4


def test_a_folded_stream_resumes(spark, folder, tmp_path):
    path = str(tmp_path / "ends")

    def drain():
        rows = drop_incomplete_rows(stream_csv(spark, str(folder), SCHEMA, max_files=1)).select("dist")
        counts = count_by(rows, "dist")
        merge = lambda known, batch: end_groups(merged_counts(known, count_by(batch, "dist")), 2, "smallest")
        table, query = start_stream(StreamJob(rows, "fold", merge=merge, schema=counts.schema), path)
        query.awaitTermination(120)
        assert all(not p.stateOperators for p in query.recentProgress)
        return sorted(tuple(r) for r in table.read(spark).collect())

    add_file(folder, 0)
    add_file(folder, 1)
    assert drain() == [(1.5, 1), (2.5, 1)]
    add_file(folder, 2)
    add_file(folder, 3)
    assert drain() == [(1.5, 3), (2.5, 1)]


def test_one_read_serves_several_outputs(spark, trips):
    counts = count_by(trips, "pax")
    outputs = {
        "high": Output(lambda rows: rows.where("fare > 50").select("id")),
        "by_pax": Output(lambda rows: count_by(rows, "pax"), merged_counts, counts.schema),
    }
    tables, query = start_fan_out(trips, outputs)
    query.awaitTermination(120)
    assert sorted(r.id for r in tables["high"].read(spark).collect()) == [2, 5]
    assert sorted(map(tuple, tables["by_pax"].read(spark).collect())) == [(1, 1), (2, 3), (3, 1), (4, 2)]
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert all(len(p.sources) == 1 for p in progress)
    assert sum(p.numInputRows for p in progress) == 12  # every line of the files once, with the header lines
    found = run_fan_out(trips, outputs)
    assert found["by_pax"].count() == 4


def test_a_batch_that_fails_between_outputs_is_replayed(spark, trips, tmp_path):
    broken = [True]

    def fragile(rows):
        if broken[0]:
            raise RuntimeError("lost")
        return rows.select("id")

    first = Output(lambda rows: rows.select("id"))
    path = str(tmp_path / "fan")
    schema = trips.select("id").schema
    outputs = {"first": first, "second": Output(fragile, lambda known, rows: known.unionByName(rows), schema)}
    _, query = start_fan_out(trips, outputs, path)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination(120)
    broken[0] = False
    tables, query = start_fan_out(trips, outputs, path)
    query.awaitTermination(120)
    for table in tables.values():
        assert sorted(r.id for r in table.read(spark).collect()) == [1, 2, 3, 5, 6, 7, 8]


def test_closed_windows_are_written_once_by_day(spark, trips):
    sums = window_sum(trips, "ts", "1 hour", "fare", "total", watermark="1 hour")
    daily = sums.select(F.to_date("start_time").alias("day"), "*")
    table, query = start_stream(StreamJob(daily, "append", partition_by=["day"]))
    query.awaitTermination(120)
    assert [(str(r.day), r.start_time, r.total) for r in table.read(spark).collect()] == [("2015-01-01", at(0), 169.0)]
    assert os.path.isdir(f"{table.data}/day=2015-01-01")
    states = [op for p in query.recentProgress for op in p.stateOperators]
    assert sum(op.numRowsRemoved for op in states) > 0 and states[-1].numRowsTotal == 1  # the open window


def test_batches_in_folders_by_value(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k INT, part STRING")
    table = StreamTable(str(tmp_path / "t"), rows.schema, "append", partition_by=("part",))
    table.write_batch(rows, 0)
    table.write_batch(rows.where("k = 2"), 1)
    assert sorted(map(tuple, table.read(spark).collect()), key=repr) == [(1, "a"), (2, "b"), (2, "b"), (3, None)]
    assert (tmp_path / "t" / "data" / "batch_id=1" / "part=b").is_dir()


def test_dropped_rows_are_counted_by_batch(spark, folder):
    for i in range(len(FILES)):
        add_file(folder, i)
    trips = stream_csv(spark, str(folder), SCHEMA, max_files=1, header=True)
    sums = window_sum(trips, "ts", "1 hour", "fare", "total", watermark="1 hour", count="n")
    table, query = start_stream(StreamJob(sums, "update", ["start_time", "end_time"], counted="n"))
    query.awaitTermination(120)
    rows = table.row_counts(spark, [query]).collect()
    # Batch 1 has a row without a time, which isn't kept either; id 7 of batch 3 is late.
    counts = [(r.input_rows, r.kept_rows, r.dropped_rows) for r in sorted(rows, key=lambda r: r.batch_id)]
    assert counts == [(2, 2, 0), (2, 1, 1), (2, 2, 0), (2, 1, 1)]


def test_a_view_follows_the_finished_batches(spark, folder, tmp_path):
    def drain():
        rows = drop_incomplete_rows(stream_csv(spark, str(folder), SCHEMA, max_files=1)).select("id")
        table, query = start_stream(StreamJob(rows, "append", view="live_trips"), str(tmp_path / "live"), {"processingTime": "0 seconds"})
        return table, query

    count = lambda: spark.sql("SELECT count(*) AS n FROM live_trips").collect()[0].n
    add_file(folder, 0)
    table, query = drain()
    assert count() in (0, 2)
    seen = []
    for i in (1, 2):
        query.processAllAvailable()
        seen.append(count())
        add_file(folder, i)
    query.processAllAvailable()
    query.stop()
    assert seen == [2, 3] and count() == 5
    ten_rows(spark, 0).selectExpr("k AS id").write.parquet(f"{table.data}/batch_id=50")  # a batch under way
    assert count() == 5


def test_drained_files_are_archived_and_read_once(spark, folder, tmp_path):
    archive = tmp_path / "done"

    def drain():
        rows = stream_csv(spark, str(folder), SCHEMA, max_files=None, max_bytes=1, archive=str(archive))
        table, query = start_stream(StreamJob(drop_incomplete_rows(rows).select("id"), "append"), str(tmp_path / "ids"))
        query.awaitTermination(120)
        assert len([p for p in query.recentProgress if p.numInputRows]) == 2  # one file in each batch
        return sorted(r.id for r in table.read(spark).collect())

    add_file(folder, 0)
    add_file(folder, 1)
    assert drain() == [1, 2, 3]
    add_file(folder, 2)
    add_file(folder, 3)
    assert drain() == [1, 2, 3, 5, 6, 7, 8]
    moved = {p.name for p in archive.rglob("f*.csv")}
    assert {"f0.csv", "f1.csv"} <= moved and not moved & {p.name for p in folder.iterdir()}
    with pytest.raises(ValueError, match="not by both"):
        stream_csv(spark, str(folder), SCHEMA, max_files=1, max_bytes=1)


def test_one_failing_query_stops_the_others(spark, trips):
    bad = trips.select(F.raise_error(F.lit("broken")).alias("x"), "id")
    with pytest.raises(Exception, match="broken"):
        run_streams(
            {"good": StreamJob(trips.select("id"), "append"), "bad": StreamJob(bad, "append")}
        )
    assert spark.streams.active == []


def test_modes_are_checked(spark):
    schema = spark.range(1).schema
    with pytest.raises(ValueError, match="mode"):
        StreamTable("x", schema, "upsert")
    with pytest.raises(ValueError, match="keys"):
        StreamTable("x", schema, "update")
    with pytest.raises(ValueError, match="counted"):
        StreamTable("x", schema, "append", counted="n")
    with pytest.raises(ValueError, match="merge"):
        StreamJob(spark.range(1), "fold")
