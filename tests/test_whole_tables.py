"""The headerless scan and the stream queries take every complete row, whatever its values."""

from datetime import datetime, timedelta

import pytest

import __spark_entry__ as contract

LINES = [(float(i % 40), 100.0 + i, i % 3 / 100, i % 2 / 10, i % 8, i) for i in range(80)]  # line number 7, tax 0
GAPS = [(None, 1.0, 0.0, 0.0, 1, 80), (5.0, None, 0.0, 0.0, 1, 81), (39.0, 1.0, 0.0, None, 7, 82)]
FIRST = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))

    def store(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    names = "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_linenumber INT, l_orderkey BIGINT"
    store("lineitem", LINES + GAPS, names)
    events = [(i, FIRST + timedelta(hours=i), i, ["view", "error"][i % 2], float(i), "{}") for i in range(30)]
    names = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    store("events", [*events, (30, FIRST, 1, None, 1.0, "{}"), (31, FIRST, 1, "view", None, "{}")], names)
    orders = [(i, i, "OFP"[i % 3], i + 0.5) for i in range(40)]
    names = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    store("orders", [*orders, (40, None, "O", 1.0), (41, 1, None, 1.0)], names)
    return path


def rows_of(spark, root, name):
    return [tuple(r) for r in contract.queries()[name](spark, root).collect()]


def test_headerless_scan_keeps_orders_of_every_status(spark, root):
    assert sorted(rows_of(spark, root, "csv_headerless_scan")) == [(i, i, "OFP"[i % 3], i + 0.5) for i in range(40)]


def test_stream_averages_take_every_line_without_a_null(spark, root):
    (got,) = rows_of(spark, root, "stream_averages")
    assert got == pytest.approx([round(sum(x[c] for x in LINES) / 80, 4) for c in range(5)])


def test_stream_extremes_count_every_line_with_a_quantity(spark, root):
    counts = dict.fromkeys(map(float, range(40)), 2) | {5.0: 3, 39.0: 3}
    ends = [*range(10), *range(30, 40)]
    assert sorted(rows_of(spark, root, "stream_extremes_union")) == [(float(q), counts[q]) for q in ends]


def test_stream_snapshot_counts_events_of_every_type(spark, root):
    assert rows_of(spark, root, "stream_snapshot_shape") == [(30, 6)]
