"""Benchmark decontamination: a broadcast hash set of test windows, scanned against every document.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A
benchmark item gives every window of 13 words, or one shorter window if it has fewer
words; items without words give none. Document windows are hashed, looked up in the
broadcast set, and each hash hit is confirmed word by word.

Null and empty texts have no words and are never contaminated; rows that share a doc_id
are judged one by one; an empty benchmark hits nothing, an empty table gives an empty one.
A text of any length is scanned whole, one row for each of its windows; other columns can
have any name. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, kept_table, picked, row_key, small_side, with_results

WINDOW = 13
# A broadcast needs this proof of its size: below it the set stays under some 500 MB.
MOST_BROADCAST_WINDOWS = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _hash_at(size: int, start: Column) -> Column:
    """Hash of ``size`` words from ``start``; one expression, so it is compiled with the scan."""
    return F.xxhash64(*[F.get("words", start + i) for i in range(size)])


def test_windows(benchmark: DataFrame, size: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and the words of every window of every item."""
    items = benchmark.select(benchmark[item_id].alias("item_id"), words(benchmark[text]).alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    return (
        items.where(n > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), F.least(F.lit(size), n)).alias("window"))
        .distinct()
    )


def window_hits(spark: SparkSession, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, row_key, first word, end and window of every occurrence, confirmed on the words."""
    distinct = windows.select("window", F.size("window").alias("n")).distinct()
    counted = distinct.groupBy("n").count().collect()  # at most 13 lengths
    few = sum(r["count"] for r in counted) <= MOST_BROADCAST_WINDOWS
    texts = docs.select("doc_id", row_key().alias("row_key"), words(F.col("text")).alias("words"))
    found = []
    for n in sorted(r["n"] for r in counted):
        size = F.size("words")
        starts = F.when(size >= n, F.sequence(F.lit(0), size - n))
        tokens = texts.select("doc_id", "row_key", "words", F.explode(starts).alias("first"))
        tests = distinct.where(F.col("n") == n).select(
            "window", F.xxhash64(*[F.get("window", F.lit(i)) for i in range(n)]).alias("hash")
        )
        own_hash, own = _hash_at(n, F.col("first")), F.slice("words", F.col("first") + 1, n)
        if not few:  # what travels to meet the tests is the window, not the text
            tokens = tokens.select("doc_id", "row_key", "first", own_hash.alias("own_hash"), own.alias("own"))
            own_hash, own = F.col("own_hash"), F.col("own")
        confirmed = (own_hash == F.col("hash")) & (own == F.col("window"))
        found.append(
            tokens.join(F.broadcast(tests) if few else tests, confirmed).select(
                "doc_id", "row_key", "first", (F.col("first") + n).alias("end"), "window"
            )
        )
    if not found:
        return texts.select(
            "doc_id", "row_key", F.lit(0).alias("first"), F.lit(0).alias("end"), F.col("words").alias("window")
        ).where(F.lit(False))
    return reduce(DataFrame.unionByName, found)


def covered(spans: str) -> Column:
    """Number of words in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(done, span):
        fresh = F.greatest(span["end"] - F.greatest(span["first"], done["reach"]), F.lit(0))
        return F.struct(
            (done["n"] + fresh).alias("n"), F.greatest(done["reach"], span["end"]).alias("reach")
        )

    return F.aggregate(spans, start, add)["n"].cast("bigint")


def contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW
) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, spans, items (sorted as text) of every row of ``docs``."""
    docs = picked(docs)
    windows = test_windows(benchmark, size)
    hits = kept_table(spark, window_hits(spark, docs, windows), "test-hits")
    spans = hits.groupBy("doc_id", "row_key").agg(
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans")
    )
    items = (
        hits.select("doc_id", "row_key", "window")
        .distinct()
        .join(windows, "window")
        .select("doc_id", "row_key", F.col("item_id").cast("string").alias("item"))
        .groupBy("doc_id", "row_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    texts = docs.select(
        "doc_id",
        row_key().alias("row_key"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("n_words"),
    )
    marked = with_results(with_results(texts, spans), items)
    return marked.select(
        "doc_id",
        "row_key",
        "n_words",
        F.coalesce(covered("spans"), F.lit(0)).cast("bigint").alias("n_hit"),
        "spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated() -> Column:
    """At least one word in twenty is part of a test window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(marked: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = (
        contamination(spark, docs, benchmark)
        .where(is_contaminated())
        .select(F.col("doc_id").alias("__doc_id"), F.col("row_key").alias("__row_key"))
    )
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == F.col("__row_key")) & docs["doc_id"].eqNullSafe(
        F.col("__doc_id")
    )
    return docs.join(small_side(spark, bad), same, "left_anti")
