"""Streaming file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    max_files: int | None,
    header: bool = False,
    max_bytes: str | int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Read a growing directory of CSV files.

    A micro-batch takes at most ``max_files`` new files, or files of ``max_bytes`` together
    (one file at least), or all there are with neither. With ``archive``, a folder outside
    of ``path``, files are moved there when a later batch finds them done; the checkpoint
    knows them, so none is read twice.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("a micro-batch is limited by files or by bytes, not by both")
    reader = spark.readStream.schema(schema).option("header", header)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path)


def stream_table(
    spark: SparkSession, root: str, name: str, max_files: int | None = None
) -> DataFrame:
    """Read a Parquet table as a stream, with the schema of the files there now.

    Without ``max_files`` a drained table is one micro-batch: its files are in no
    order of time, so cutting it would make a watermark drop rows as late. The
    pattern matches just the table's name; being a pattern, it lets the source
    take a table that is one file as well as one that is a directory.
    """
    reader = spark.readStream.schema(spark.read.parquet(f"{root}/{name}.parquet").schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/{name}.parque[t]")
