"""Streams over tables of several files against the same oracles as over one."""

import duckdb
import pytest

import __spark_entry__ as contract
from test_oracles import sorted_rows

SOURCE = "/root/testdata/sf0.001"
STREAMS = sorted(n for n in contract.oracle_sql() if n.startswith("stream_"))


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Events and lines dealt at random to six files; other tables as they are."""
    path = tmp_path_factory.mktemp("dealt")
    for name in ("events", "lineitem", "supplier"):
        table = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        table.orderBy(table.columns[-1]).repartition(6).write.parquet(str(path / f"{name}.parquet"))
    return str(path)


@pytest.mark.parametrize("name", STREAMS)
def test_streams_are_complete_on_many_files(spark, root, name):
    duck = duckdb.connect()
    for table in ("events", "lineitem", "supplier"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SOURCE}/{table}.parquet'")
    actual = contract.queries()[name](spark, root).toArrow()
    expected = sorted_rows(duck.execute(contract.oracle_sql()[name]).to_arrow_table())
    assert len(expected) == actual.num_rows
    for row, wanted in zip(sorted_rows(actual), expected, strict=True):
        # A last digit can differ where an average lies between two roundings.
        for a, w in zip(row, wanted, strict=True):
            assert a == (pytest.approx(w, abs=2e-4) if isinstance(w, float) else w)
