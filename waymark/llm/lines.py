"""Line dedup: normalised lines, hashed, counted in distinct documents, and dropped where frequent.

Texts are cut at line feeds. A line's key is the line without spaces, tabs, line feeds,
vertical tabs, form feeds and returns at both ends, with A-Z lower-cased. A key of at
least ``LEAST_CHARS`` characters that stands in at least ``LEAST_DOCUMENTS`` documents
loses all its lines but those of the largest doc_id that has it. What is left is put
together again in the order of its positions.

The keys are two independent 64-bit hashes. Counts of rows are partial in each task before
the shuffle, and only lines whose key is in enough rows go on to the exact count of
documents. They find their key by a broadcast of keys that are counted to be few; beyond
that only the heaviest keys are broadcast, at most ``MOST_BROADCAST_ROWS`` by what a share
of all rows means, so no key of the shuffle that serves the rest has many rows.

Null and empty texts are one empty line and keep it. Lines of rows with a null id are not
counted and stay. Rows that share an id are one document; each is put together by
itself, and equal rows get equal results. An empty table gives an empty one. A text may be
as long as a string can be: its lines are marked in time linear in its length. Other
columns can have any name. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MOST_BROADCAST_ROWS, ascii_lower, kept_table, picked, row_key

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
BLANKS = " \t\n\x0b\f\r"
KEY = ["high", "low"]
# The marks of dropped lines, a byte for each line, are broadcast to the texts if they can't be more.
MOST_BROADCAST_BYTES = 100_000_000


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, row_key, place (from 0) and key hashes of every line that is long enough."""
    rows = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= least_chars))
    lines = rows.select("doc_id", row_key().alias("row_key"), F.posexplode(text_lines(F.col("text"))).alias("place", "line"))
    keyed = lines.select("doc_id", "row_key", "place", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= least_chars).select(
        "doc_id", "row_key", "place", F.xxhash64("key").alias("high"), F.xxhash64(F.lit(13), "key").alias("low")
    )


def frequent_keys(spark: SparkSession, lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Keys that stand in enough rows, and in more than one document, with their number of lines."""
    counted = lines.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    enough = F.col("n") >= least_documents
    if least_documents > 1:
        enough &= F.col("first") != F.col("last")
    return kept_table(spark, counted.where(enough).select(*KEY, "n", "last"), "line-keys")


def lines_of(lines: DataFrame, keys: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """The lines with one of these keys (with ``n`` lines each, and other columns)."""
    total = keys.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("lines")).first()
    if total["keys"] <= most:
        return lines.join(F.broadcast(keys), KEY)
    heavy = F.col("n") * most >= total["lines"]  # of at most ``most`` keys
    found = lines.join(F.broadcast(keys.where(heavy)), KEY)
    return found.unionByName(lines.join(keys.where(~heavy), KEY))


def dropped_lines(
    spark: SparkSession, docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """doc_id, row_key and the places, in order, of every row that loses lines."""
    docs = picked(docs)
    lines = hashed_lines(docs, least_chars)
    keys = frequent_keys(spark, lines, least_documents)
    found = kept_table(spark, lines_of(lines, keys), "line-places")
    documents = (
        found.select(*KEY, "doc_id")
        .distinct()
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= least_documents)
    )
    repeated = kept_table(spark, keys.join(documents, KEY), "line-keys")
    gone = lines_of(found.drop("n", "last"), repeated).where(F.col("doc_id") != F.col("last"))
    places = gone.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set("place")).alias("places"))
    return kept_table(spark, places, "line-drops")


def _marks(places: Column) -> Column:
    """One byte for each line up to the last dropped one, '1' where it goes."""
    runs = F.transform(
        places, lambda at, i: F.concat(F.repeat(F.lit("0"), at - F.coalesce(F.get(places, i - 1), F.lit(-1)) - 1), F.lit("1"))
    )
    return F.array_join(runs, "").cast("binary")


def _with_marks(spark: SparkSession, rows: DataFrame, places: DataFrame) -> DataFrame:
    """Add ``__gone`` and ``__marks`` (null where nothing goes) to rows with __id and __own.

    The marks are made from the written places, below the join, so they are made once for each row.
    """
    size = places.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.element_at("places", -1) + 1).alias("bytes")).first()
    few = size["rows"] <= MOST_BROADCAST_ROWS and (size["bytes"] or 0) <= MOST_BROADCAST_BYTES
    named = places.select(
        F.col("doc_id").alias("__doc_id"),
        F.col("row_key").alias("__row_key"),
        F.size("places").alias("__gone"),
        _marks(F.col("places")).alias("__marks"),
    )
    same = (F.col("__own") == F.col("__row_key")) & (F.col("__id") == F.col("__doc_id"))
    return rows.join(F.broadcast(named) if few else named, same, "left").drop("__doc_id", "__row_key")


def deduplicated(
    spark: SparkSession,
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without their dropped lines, and n_lines and n_dropped of each."""
    own = picked(docs, doc_id, text)
    places = dropped_lines(spark, own, least_chars, least_documents)
    rows = docs.withColumns({"__id": docs[doc_id], "__own": F.xxhash64(docs[doc_id], docs[text])})
    joined = _with_marks(spark, rows, places)
    gone = F.lit("1").cast("binary")
    left = F.filter(text_lines(F.col(f"`{text}`")), lambda line, i: F.substring("__marks", i + 1, F.lit(1)) != gone)
    return joined.withColumns(
        {
            "n_lines": F.size(text_lines(F.col(f"`{text}`"))).cast("bigint"),
            "n_dropped": F.coalesce("__gone", F.lit(0)).cast("bigint"),
            text: F.when(F.col("__marks").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(left, "\n")),
        }
    ).drop("__id", "__own", "__gone", "__marks")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    rows = deduplicated(spark, picked(docs))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return rows.select("doc_id", "n_lines", "n_dropped", kept)
