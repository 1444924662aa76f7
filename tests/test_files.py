"""CSV scans and sinks on hand-made files."""

import pytest
from pyspark.sql import Row

from waymark.operators import (
    drop_incomplete_rows,
    extract_columns,
    extract_packed_places,
    fill_and_cast,
    full_outer_pair,
    full_outer_stored,
    null_profile,
    table_summary,
    with_ratio,
)
from waymark.operators.synth import PACKED_HEADER
from waymark.sources import (
    CITY_SCHEMA,
    TRIP_SCHEMA,
    malformed_by_file,
    read_csv,
    register,
    run_sql,
    store_buckets,
    stream_csv,
    write_csv,
)

CITIES = """CityName,Population,Area,CulturalSites,CityID
Ab,10,2.0,3,001234
Cd,20,4.0,,5
Ef,30,0.0,4,1234
"""


@pytest.fixture
def cities(tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text(CITIES)
    return str(path)


def test_header_line_is_a_row_without_header_option(spark, cities):
    raw = read_csv(spark, cities, CITY_SCHEMA, header=False)
    assert [r.CityID for r in raw.collect()] == [None, 1234, 5, 1234]
    clean = drop_incomplete_rows(raw)
    assert [r.CityName for r in clean.collect()] == ["Ab", "Ef"]
    rated = with_ratio(clean, "Population", "Area", "Density")
    assert [r.Density for r in rated.collect()] == [5.0, None]


def test_header_is_checked_against_the_schema(spark, cities):
    assert read_csv(spark, cities, CITY_SCHEMA).count() == 3
    wrong = CITY_SCHEMA.replace("Area", "Size")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, cities, wrong).collect()
    assert read_csv(spark, cities, wrong, check_header=False).count() == 3


def test_inferred_schema(spark, cities):
    types = dict(read_csv(spark, cities).dtypes)
    assert types == {
        "CityName": "string",
        "Population": "int",
        "Area": "double",
        "CulturalSites": "int",
        "CityID": "int",
    }


def test_columns_bind_by_position(spark, tmp_path):
    fields = len(TRIP_SCHEMA.split(","))
    assert fields == 19
    path = tmp_path / "wide.csv"
    path.write_text("1,2,3\n4,5\n")
    narrow = read_csv(spark, str(path), "a INT, b INT", header=False)
    assert narrow.collect() == [Row(a=1, b=2), Row(a=4, b=5)]
    wide = read_csv(spark, str(path), "a INT, b INT, c INT, d INT", header=False)
    assert [r.d for r in wide.collect()] == [None, None]


def test_directory_scan_and_write_modes(spark, cities, tmp_path):
    out = str(tmp_path / "out")
    table = read_csv(spark, cities, CITY_SCHEMA)
    write_csv(table.repartition(2), out)
    assert read_csv(spark, out, CITY_SCHEMA).count() == 3
    with pytest.raises(Exception, match="exists"):
        write_csv(table, out)
    write_csv(table, out, mode="append")
    assert read_csv(spark, out, CITY_SCHEMA).count() == 6


def test_fractional_populations_with_blanks(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("city,population\nBig,3644826.0\nTwin,5312.0\nTwin,7000.0\nBlank,\n")
    table = read_csv(spark, str(path), "city STRING, population DOUBLE")
    counts = {r.column: r.null_count for r in null_profile(table).collect()}
    assert counts == {"city": 0, "population": 1}
    whole = fill_and_cast(table, {"population": 0}, {"population": "int"})
    summary = table_summary(whole, "population", "population", "city").collect()[0]
    assert (summary.total, summary.minimum, summary.maximum) == (3657138, 0, 3644826)
    assert summary.row_count == 4


def test_packed_places(spark, tmp_path):
    path = tmp_path / "packed.csv"
    path.write_text(f"{PACKED_HEADER}\n7;01000;1;2;9;Bourg;5;6;7\n8;01;1;2;9\n")
    lines = read_csv(spark, str(path))
    assert lines.columns == [PACKED_HEADER]
    keyed = lines.selectExpr(f"`{PACKED_HEADER}`", f"int(split_part(`{PACKED_HEADER}`, ';', 1)) AS k")
    rows = extract_packed_places(keyed, PACKED_HEADER, ["k"]).collect()
    assert [r.cities for r in rows] == ["Bourg", None]
    assert all(50 <= r.population < 2_800_000 for r in rows)
    assert extract_columns(keyed, "k").columns == ["k"]


def test_views_and_sql(spark, cities):
    table = read_csv(spark, cities, CITY_SCHEMA)
    register(table, "test_cities")
    total = spark.sql("SELECT sum(Population) AS p FROM test_cities").collect()[0].p
    named = run_sql(spark, "SELECT sum(Population) AS p FROM {other_cities}", other_cities=table)
    assert total == named.collect()[0].p == 60


def test_stream_takes_one_file_per_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.csv").write_text(f"{i}\n")
    seen = []
    stream = stream_csv(spark, str(source), "a INT", max_files=1)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count()))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    assert seen == [1, 1, 1]


def test_malformed_lines_are_kept_beside_the_typed_row(spark, tmp_path):
    """Lines of 17, 18 and 19 values under a schema of 18, and a text for a number."""
    schema = ", ".join(["id INT", *[f"c{i} DOUBLE" for i in range(1, 18)]])
    line = lambda i, n: ",".join([str(i), *[f"{k}.5" for k in range(1, n)]])
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([line(1, 18), line(2, 17), line(3, 19)]) + "\n")
    (folder / "b.csv").write_text("\n".join([line(4, 18), line(5, 18).replace(",7.5,", ",seven,"), "x," + line(6, 17)]) + "\n")
    (folder / "c.csv").write_text(line(7, 18) + "\n")
    rows = read_csv(spark, str(folder), schema, header=False, malformed="bad")
    assert rows.columns[-1] == "bad"
    got = {r.c1 if r.id is None else r.id: r for r in rows.collect()}
    assert {k for k, r in got.items() if r.bad is None} == {1, 4, 7}
    assert (got[2].bad, got[2].c16, got[2].c17) == (line(2, 17), 16.5, None)
    assert (got[3].bad, got[3].c17) == (line(3, 19), 17.5)
    assert (got[5].c7, got[5].c8) == (None, 8.5) and got[5].bad.count("seven") == 1
    counts = {r.file_name: (r.row_count, r.malformed_count, r.null_fields) for r in malformed_by_file(rows, "bad").collect()}
    assert counts == {"a.csv": (3, 2, 1), "b.csv": (3, 2, 2), "c.csv": (1, 0, 0)}


def test_malformed_lines_under_a_header(spark, cities):
    rows = read_csv(spark, cities, CITY_SCHEMA, malformed="bad")
    assert [r.bad for r in rows.collect()] == [None] * 3
    with pytest.raises(Exception, match="header"):
        read_csv(spark, cities, CITY_SCHEMA.replace("Area", "Size"), malformed="bad").collect()


def test_stored_buckets_join_like_tables(spark):
    left = spark.createDataFrame([(i % 7, "l", float(i)) for i in range(40)] + [(None, "l", 0.0)], "id INT, name STRING, amount DOUBLE")
    right = spark.createDataFrame([(i % 11, "r", float(i)) for i in range(30)] + [(None, "r", 1.0)], "id INT, name STRING, amount DOUBLE")
    stored = [store_buckets(side, "id", 4) for side in (left, right)]
    names = {"name": "a", "amount": "b"}, {"name": "c", "amount": "d"}
    expected = sorted(map(tuple, full_outer_pair(left, right, "id", *names).collect()), key=repr)
    for rows_per_slice in (1_000_000, 3):  # without and with hot keys
        got = full_outer_stored(*stored, "id", *names, rows_per_slice)
        assert sorted(map(tuple, got.collect()), key=repr) == expected
