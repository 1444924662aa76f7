"""Synthetic and extracted city tables, built from the keys of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..operators.synth import (
    AREA,
    COUNTRIES,
    CULTURAL_SITES,
    EXTRACTED_POPULATION,
    ID,
    ID_DIGITS,
    NAME,
    NAME_LETTERS,
    PACKED_HEADER,
    PEOPLE,
    POPULATION,
    SITES,
)
from ..sources import read_csv, write_csv
from .draw_sql import draw_digits_sql, draw_double_sql, draw_int_sql, draw_word_sql
from .registry import query

SEED = 42


def name_sql(keys: list[str], country: str) -> str:
    return draw_word_sql(keys, *NAME_LETTERS, COUNTRIES[country].suffix, SEED, NAME)


def population_sql(keys: list[str]) -> str:
    return draw_int_sql(keys, *POPULATION, SEED, PEOPLE)


def attributes_sql(keys: list[str], country: str) -> str:
    ranges = COUNTRIES[country]
    area = draw_double_sql(keys, ranges.area_min, ranges.area_max, SEED, AREA)
    return f"""round({area}, 2) AS Area,
               {draw_int_sql(keys, *CULTURAL_SITES, SEED, SITES)} AS CulturalSites,
               {draw_digits_sql(keys, ID_DIGITS, SEED, ID)} AS CityID"""


ORDER_KEY, CITY_KEY = ["o_orderkey"], ["id", "kind"]


@query(
    "synth_cities",
    f"""SELECT o_orderkey, {name_sql(ORDER_KEY, "FR")} AS CityName,
               {population_sql(ORDER_KEY)} AS Population, {attributes_sql(ORDER_KEY, "FR")}
        FROM orders""",
)
def synth_cities(t):
    """One synthetic city per order."""
    named = op.synth_names(t("orders"), ORDER_KEY, "FR", SEED)
    return op.with_city_attributes(named, ORDER_KEY, "FR", SEED)


@query(
    "extend_cities",
    f"""SELECT CityName, CAST(trunc(coalesce(people, 0)) AS INTEGER) AS Population,
               {attributes_sql(CITY_KEY, "DE")}
        FROM (SELECT c_custkey AS id, 0 AS kind, c_name AS CityName,
                     CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS people FROM customer
              UNION ALL
              SELECT id, kind, {name_sql(CITY_KEY, "DE")}, {population_sql(CITY_KEY)}
              FROM (SELECT o_orderkey AS id, 1 AS kind FROM orders))""",
)
def extend_cities(t):
    """Customers as real cities, some without a population, and a synthetic one per order."""
    real = t("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("CityName"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("Population"),
    )
    extra = t("orders").select(F.col("o_orderkey").alias("id"))
    return op.extend_cities(real, extra, "id", "DE", SEED)


@query(
    "random_int_column",
    f"""SELECT s_suppkey,
               {draw_int_sql(["s_suppkey"], *EXTRACTED_POPULATION, SEED)} AS population
        FROM supplier""",
)
def random_int_column(t):
    keys = ["s_suppkey"]
    suppliers = t("supplier").select(*keys)
    return op.with_random_int(suppliers, "population", *EXTRACTED_POPULATION, keys, SEED)


@query("city_extract", "SELECT c_name AS city, c_acctbal AS population FROM customer")
def city_extract(t):
    """Raw file to two-column file to table."""
    raw, clean = t.scratch("cities-raw"), t.scratch("cities-clean")
    customer = op.rename_columns(t("customer"), {"c_name": "city", "c_acctbal": "population"})
    write_csv(customer, raw)
    write_csv(op.extract_columns(read_csv(t.spark, raw, customer.schema), "city", "population"), clean)
    return read_csv(t.spark, clean, "city STRING, population DOUBLE")


@query(
    "packed_places",
    f"""SELECT p_name AS cities,
               {draw_int_sql(["p_partkey"], *EXTRACTED_POPULATION, SEED)} AS population
        FROM part""",
)
def packed_places(t):
    """Lines of ``;``-packed fields written as one text column, then taken apart."""
    path = t.scratch("places-packed")
    fields = ["p_partkey", "p_size", "p_brand", "p_type", "p_partkey", "p_name", "p_size"]
    packed = F.concat_ws(";", *[F.col(c).cast("string") for c in fields])
    write_csv(t("part").select(packed.alias(PACKED_HEADER)), path)
    # One text column: the file's header line is the packed list of field names.
    lines = read_csv(t.spark, path, check_header=False, schema=f"`{PACKED_HEADER}` STRING")
    keyed = op.with_split_field(lines, PACKED_HEADER, ";", 0, "key")
    keyed = keyed.withColumn("key", F.col("key").try_cast("bigint"))
    return op.extract_packed_places(keyed, PACKED_HEADER, ["key"], SEED)
