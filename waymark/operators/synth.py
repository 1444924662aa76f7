"""City tables: extending them with synthetic rows and extracting them from raw files.

All values are draws from the row's key, so the same key and seed give the same
city however the job is partitioned or retried.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import draw_digits, draw_double, draw_int, draw_word, round_half_even
from .clean import extend_rows, with_random_int, with_split_field


class CountryRanges(NamedTuple):
    suffix: str
    area_min: float
    area_max: float


# Name endings, value ranges and id width of the synthetic cities.
COUNTRIES = {"DE": CountryRanges("burg", 20.0, 900.0), "FR": CountryRanges("ville", 20.0, 110.0)}
NAME_LETTERS = (4, 6)
POPULATION = (0, 4_000_000)
CULTURAL_SITES = (0, 100)
ID_DIGITS = 6
PACKED_HEADER = ";Postal Code;x;y;iseecode;place;population;surface;altitude"
PACKED_PLACE_FIELD = 5
EXTRACTED_POPULATION = (50, 2_800_000)

# Draw streams; a name takes two.
NAME, PEOPLE, AREA, SITES, ID = 0, 2, 3, 4, 5


def synth_names(rows: DataFrame, keys: list[str], country: str, seed: int) -> DataFrame:
    """(keys, CityName, Population) for each row of a table of distinct keys."""
    suffix = COUNTRIES[country].suffix
    return rows.select(
        *keys,
        draw_word(keys, *NAME_LETTERS, suffix, seed, NAME).alias("CityName"),
        draw_int(keys, *POPULATION, seed, PEOPLE).alias("Population"),
    )


def with_city_attributes(
    df: DataFrame, keys: list[str], country: str, seed: int
) -> DataFrame:
    """Add Area, CulturalSites and CityID; ids are text and may repeat."""
    ranges = COUNTRIES[country]
    area = draw_double(keys, ranges.area_min, ranges.area_max, seed, AREA)
    return df.withColumns(
        {
            "Area": round_half_even(area, 2),
            "CulturalSites": draw_int(keys, *CULTURAL_SITES, seed, SITES),
            "CityID": draw_digits(keys, ID_DIGITS, seed, ID),
        }
    )


def synth_cities(spark: SparkSession, n: int, country: str, seed: int = 42) -> DataFrame:
    """n synthetic cities with all five columns."""
    named = synth_names(spark.range(n), ["id"], country, seed)
    return with_city_attributes(named, ["id"], country, seed).drop("id")


def extend_cities(
    real: DataFrame, extra: DataFrame, key: str, country: str, seed: int = 42
) -> DataFrame:
    """Real cities (key, CityName, Population) plus one synthetic city per extra key.

    Both kinds get random attributes; missing populations of real cities become 0.
    """
    kind = "is_synthetic"
    real = real.select(key, F.lit(0).alias(kind), "CityName", "Population")
    extra = synth_names(extra.select(key, F.lit(1).alias(kind)), [key, kind], country, seed)
    cities = with_city_attributes(extend_rows(real, extra), [key, kind], country, seed)
    population = F.coalesce(F.col("Population").cast("double"), F.lit(0.0)).try_cast("int")
    return cities.withColumn("Population", population).drop(key, kind)


def extract_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The (city, population) extract of a clean city file."""
    return df.select(*columns)


def extract_packed_places(
    lines: DataFrame, packed: str, keys: list[str], seed: int = 42
) -> DataFrame:
    """Place names out of ``;``-packed lines, with a random population each."""
    named = with_split_field(lines, packed, ";", PACKED_PLACE_FIELD, "cities")
    filled = with_random_int(named, "population", *EXTRACTED_POPULATION, keys, seed)
    return filled.select("cities", "population")
