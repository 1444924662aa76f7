"""Batch file sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import fresh_dir


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    check_header: bool = True,
    malformed: str | None = None,
) -> DataFrame:
    """Scan one CSV file or a directory of them.

    Without a schema the types are inferred, which costs one more pass over the
    files. With one, columns bind by position; a header that does not name the
    schema's columns fails the read instead of shifting values between columns,
    unless ``check_header`` is off. ``header=False`` reads a header line as a row.

    A line with too few or too many fields, or a field that isn't of its type, is read as
    far as it goes, the rest as null. With ``malformed``, a column of that name after the
    schema's holds such a line's text, and null for the others.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if header and check_header:
        reader = reader.option("enforceSchema", False)
    if malformed:
        typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*typed.fields, StructField(malformed, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed)
    return reader.schema(schema).csv(path)


def malformed_by_file(rows: DataFrame, malformed: str) -> DataFrame:
    """file_name, row_count, malformed_count and null_fields of each file of a scan with a ``malformed`` column."""
    named = rows.select("*", F.col("_metadata.file_name").alias("file_name"))
    nulls = sum((F.col(c).isNull().cast("bigint") for c in rows.columns if c != malformed), F.lit(0))
    return named.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(malformed).alias("malformed_count"),
        F.sum(nulls).alias("null_fields"),
    )


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True
) -> None:
    """Write part files with a header line each and no row index."""
    df.write.option("header", header).mode(mode).csv(path)


def store_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Store a table in sorted buckets of a key, in the shared folder, and read it back.

    Tables with equally many buckets of one key are joined and grouped by it without an exchange.
    """
    spark = df.sparkSession
    name = f"buckets_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", fresh_dir(spark, "buckets")).saveAsTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan a Parquet table that is either one file or a directory of part files."""
    return spark.read.parquet(f"{root}/{name}.parquet")
