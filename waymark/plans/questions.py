"""The city questions, asked of two city tables grown from the given tables.

Customers and suppliers stand for the real cities of two countries; each order
and each part adds a synthetic one. Ids are read as numbers, so that they lose
their leading zeros, and cities without a name are dropped.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from .cities import CITY_KEY, SEED, attributes_sql, name_sql, population_sql
from .registry import Inputs, query, rounded


class Country(NamedTuple):
    code: str
    real_table: str
    real_key: str
    real_name: str
    real_people: str
    extra_table: str
    extra_key: str


GERMAN = Country("DE", "customer", "c_custkey", "c_name", "c_acctbal", "orders", "o_orderkey")
FRENCH = Country("FR", "supplier", "s_suppkey", "s_name", "s_acctbal", "part", "p_partkey")

COLUMNS = ["CityName", "Population", "Area", "CulturalSites", "CityID"]
# Rows that agree in all of these and in what is sorted by are interchangeable.
TIES = ["CityName", "Population", "CulturalSites", "CityID"]


def cities(t: Inputs, of: Country) -> DataFrame:
    real = t(of.real_table).select(
        F.col(of.real_key).alias("id"),
        F.col(of.real_name).alias("CityName"),
        F.when(F.col(of.real_people) >= 0, F.col(of.real_people)).alias("Population"),
    )
    # Only names of real cities can be missing: populations are filled, the rest drawn.
    named = op.drop_incomplete_rows(real, ["CityName"])
    extra = t(of.extra_table).select(F.col(of.extra_key).alias("id"))
    table = op.extend_cities(named, extra, "id", of.code, SEED)
    return table.withColumn("CityID", F.col("CityID").cast("int"))


def cities_sql(of: Country) -> str:
    return f"""(
        SELECT CityName, CAST(trunc(coalesce(people, 0)) AS INTEGER) AS Population, Area,
               CulturalSites, CAST(CityID AS INTEGER) AS CityID
        FROM (SELECT *, {attributes_sql(CITY_KEY, of.code)} FROM (
                SELECT {of.real_key} AS id, 0 AS kind, {of.real_name} AS CityName,
                       CASE WHEN {of.real_people} >= 0 THEN {of.real_people} END AS people
                FROM {of.real_table} WHERE {of.real_name} IS NOT NULL
                UNION ALL
                SELECT id, kind, {name_sql(CITY_KEY, of.code)}, {population_sql(CITY_KEY)}
                FROM (SELECT {of.extra_key} AS id, 1 AS kind FROM {of.extra_table}))))"""


def register_country(of: Country) -> None:
    table, suffix = cities_sql(of), of.code.lower()

    @query(
        f"city_sizes_{suffix}",
        f"SELECT CityName, Area, Population FROM {table} ORDER BY Area DESC, {', '.join(TIES)}",
    )
    def sizes(t):
        columns = ["CityName", "Area", "Population"]
        return op.sorted_projection(cities(t, of), columns, "Area", TIES)

    @query(
        f"city_summary_{suffix}",
        f"""SELECT CAST(sum(Population) AS BIGINT) AS total_population,
                   round(avg(Area), 6) AS average_area, min(Population) AS min_population,
                   max(Population) AS max_population, count(CityID) AS city_count
            FROM {table}""",
    )
    def summary(t):
        names = ["total_population", "average_area", "min_population", "max_population", "city_count"]
        whole = op.table_summary(cities(t, of), "Population", "Area", "CityID", names)
        return rounded(whole, 6, "average_area")

    @query(f"city_density_{suffix}", f"SELECT CityName, Population / nullif(Area, 0) AS Density FROM {table}")
    def density(t):
        return op.with_ratio(cities(t, of), "Population", "Area", "Density").select("CityName", "Density")

    averages = COLUMNS[1:]

    @query(
        f"city_averages_{suffix}",
        f"SELECT {', '.join(f'round(avg({c}), 4) AS Avg_{c}' for c in averages)} FROM {table}",
    )
    def average(t):
        stats = op.column_stats(cities(t, of), averages, "avg", prefix="Avg_")
        return rounded(stats, 4, *stats.columns)

    @query(
        f"city_sites_top_{suffix}",
        f"""SELECT CityName, CulturalSites FROM {table}
            ORDER BY Population DESC, {', '.join(TIES)}, Area LIMIT 20""",
    )
    def sites(t):
        ties = [c for c in TIES if c != "Population"] + ["Area"]
        return op.top_k_series(cities(t, of), "CityName", "CulturalSites", "Population", 20, ties)


for country in (GERMAN, FRENCH):
    register_country(country)
