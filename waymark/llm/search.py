"""Exact top-k BM25 search: an inverted index in shards, scored for many queries at once and merged.

Every task turns its documents into shards: postings by term. Document frequencies, row
count and mean length are summed over all shards, so every shard scores with global
statistics. Queries are packed into blocks of bounded size, and each block is broadcast
to the shards in turn. Shards are sent to Python one at a time.

A shard scores a block of queries against all its documents: first the terms that few of
its documents hold, by their postings. Like WAND a task holds each query's k-th best score
of its shards so far as a threshold: a block of ``BLOCK`` documents is left out if for no
query of the block what a document has, with the block maxima of the common terms, can
reach the threshold. The common terms are rows of a matrix, and one product of matrices
adds them up for all queries and the documents that stay. Scores are rounded to six
places and ties go to the smaller id, so the k best of all shards are exactly the k best
of the corpus.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. Null
and empty texts match nothing but count as rows. A query doesn't find its own id.
Repeated rows are found as often as they stand in the table, and the queries of rows that
share an id are one query of all their words. Ids are whole numbers. An empty table or no
query gives no rows. A long text is one document of its shard, as a query too; other
columns can have any name. A document without an id counts as a row and isn't found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept_table, picked, ship_by_value
from .vectors import blocks, hashed_rows, run_starts, spread

ship_by_value(__name__)

K1, B = 1.2, 0.75
CHARS_PER_SHARD = 16_000_000
QUERIES_PER_BLOCK = 2048
TERMS_PER_BLOCK = 1_000_000
BLOCK = 64
# Terms that more than this share of a shard's documents hold are cheaper in a matrix.
DENSE = 0.05
# Bounds: numbers in a shard's matrix, scores held at once, postings added up at once.
CELLS = 4_000_000
SCORES = 500_000
POSTINGS = 50_000
# Spark's batches of 64 MB, in buffers that grow by doubling, add up to an executor's limit beside a full heap.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4_000_000
DIGITS = 6
EDGE = 2 * 10.0**-DIGITS
NONE = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

# Bytes that aren't part of a word become spaces: all of ASCII but digits and letters.
PLAIN = bytes(x if x > 127 or chr(x).isalnum() else 32 for x in range(256))
SHARD_SCHEMA = (
    "docs array<bigint>, lengths array<int>, terms array<bigint>, counts array<int>, places binary, tfs binary"
)


def query_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(PLAIN).split()


def term_counts(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct term hashes of each text and how often each stands in it."""
    rows = hashed_rows(query_words(t) for t in texts)  # the words of one text at a time
    return [np.unique(row.view(np.int64), return_counts=True) for row in rows]


def packed_numbers(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as many bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(values.max(initial=0))).tobytes()


def unpacked_numbers(data: bytes | pa.Buffer, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // max(count, 1) or 1}")


def shard_of(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """One row of SHARD_SCHEMA: the postings of these documents by term."""
    found = term_counts(texts)
    sizes = np.array([len(t) for t, _ in found], np.int64)
    term = np.concatenate([t for t, _ in found])
    tf = np.concatenate([n for _, n in found]).astype(np.int32)
    place = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    order = np.argsort(term, kind="stable")
    terms, counts = np.unique(term, return_counts=True)
    lengths = pa.array([int(n.sum()) for _, n in found], pa.int32())
    return pa.record_batch(
        [
            pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            pa.ListArray.from_arrays(np.array([0, len(texts)], np.int32), lengths),
            pa.ListArray.from_arrays(np.array([0, len(terms)], np.int32), terms),
            pa.ListArray.from_arrays(np.array([0, len(terms)], np.int32), counts.astype(np.int32)),
            pa.array([packed_numbers(place[order])], pa.binary()),
            pa.array([packed_numbers(tf[order])], pa.binary()),
        ],
        ["docs", "lengths", "terms", "counts", "places", "tfs"],
    )


def shards(docs: DataFrame) -> DataFrame:
    """One row of SHARD_SCHEMA for each run of documents of a task, over all its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = []

        def texts() -> Iterator[str | None]:
            for batch in batches:
                ids.extend(batch.column("doc_id").to_pylist())
                yield from batch.column("text").to_pylist()

        for block in blocks(texts(), CHARS_PER_SHARD):
            yield shard_of(pa.array(ids[: len(block)], pa.int64()), block)
            del ids[: len(block)]

    return docs.mapInArrow(run, SHARD_SCHEMA)


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term and n of every distinct term of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = term_counts(batch.column("text").to_pylist())
            sizes = np.array([len(t) for t, _ in found], np.int64)
            ids = batch.column("doc_id").to_numpy()
            columns = [np.repeat(ids, sizes), np.concatenate([t for t, _ in found]), np.concatenate([n for _, n in found])]
            yield pa.record_batch([pa.array(c) for c in columns], ["query_id", "term", "n"])

    rows = queries.where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "query_id bigint, term bigint, n bigint")


def cuts(done: np.ndarray, n: int, most: int) -> Iterator[tuple[int, int]]:
    """Runs of the n items that add at most so much to their running total, or hold one item."""
    first = 0
    while first < n:
        before = done[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(done, before + most, side="right")))
        yield first, last
        first = last


class Shard:
    """Postings of one shard with global statistics, ready for many queries."""

    def __init__(self, docs, lengths, terms, counts, places, tfs, mean: float):
        self.docs = docs.fill_null(0).to_numpy()
        self.nameless = np.flatnonzero(docs.is_null().to_numpy(zero_copy_only=False))
        self.by_id = np.argsort(self.docs, kind="stable")
        self.terms, self.counts = terms, counts.astype(np.int64)
        self.starts = run_starts(self.counts)
        self.place, tf = (unpacked_numbers(x, int(self.counts.sum())) for x in (places, tfs))
        norm = K1 * (1 - B + B * lengths / mean)
        self.impact = tf * (K1 + 1) / (tf + norm[self.place])
        # The heaviest terms as rows of a matrix; the others have no row.
        dense = np.flatnonzero(self.counts > DENSE * len(lengths))
        dense = dense[np.argsort(-self.counts[dense], kind="stable")][: CELLS // max(len(lengths), 1)]
        self.row = np.full(len(terms), -1, np.int64)
        self.row[dense] = np.arange(len(dense))
        at = spread(self.starts[dense], self.counts[dense])
        self.matrix = np.zeros((len(dense), len(lengths)))
        self.matrix[np.repeat(np.arange(len(dense)), self.counts[dense]), self.place[at]] = self.impact[at]

        self.block = np.arange(0, len(lengths), BLOCK)
        self.most = np.maximum.reduceat(self.matrix, self.block, axis=1)

    def scores(self, query: np.ndarray, at: np.ndarray, weights: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Scores of every document for some queries, in full where they reach the query's floor; terms come query by query."""
        row, n, (height, width) = self.row[at], len(floors), self.matrix.shape
        light = row < 0
        cell = query[~light] * height + row[~light]
        asked = np.bincount(cell, weights[~light], n * height).reshape(n, height)
        query, at, weights = query[light], at[light], weights[light]
        counts = self.counts[at]
        scores = np.empty((n, width))
        for first, last in cuts(np.cumsum(np.bincount(query, counts, n)), n, POSTINGS):
            own = slice(*np.searchsorted(query, [first, last]))
            posting = spread(self.starts[at[own]], counts[own])
            cell = np.repeat((query[own] - first) * width, counts[own]) + self.place[posting]
            added = self.impact[posting] * np.repeat(weights[own], counts[own])
            scores[first:last] = np.bincount(cell, added, (last - first) * width).reshape(-1, width)
        stay = self.in_reach(scores, asked, floors) if floors.any() else np.arange(width)
        if len(stay) == width:
            scores += asked @ self.matrix
        elif len(stay):
            scores[:, stay] += asked @ self.matrix[:, stay]
        return scores

    def in_reach(self, scores: np.ndarray, asked: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Documents of the blocks in which one can reach a floor, by its score so far and the block maxima."""
        best = np.maximum.reduceat(scores, self.block, axis=1) + asked @ self.most
        blocks_left = (best >= floors[:, None]).any(axis=0)
        return np.flatnonzero(np.repeat(blocks_left, BLOCK)[: scores.shape[1]])

    def best(self, ids, sizes, terms, weights, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, document and score of the best other documents of this shard for each query.

        Terms and weights hold one query after another, of the given sizes. ``known`` is a
        row for each query: the k best scores so far, zero for none. It takes in those of
        this shard; documents that can't be among the k best then are left out.
        """
        if not len(self.terms):
            return NONE
        k = known.shape[1]
        start, end = (np.searchsorted(self.docs, ids, side, sorter=self.by_id) for side in ("left", "right"))
        same = end - start
        ends = np.concatenate([[0], np.cumsum(sizes)])
        width, rows = len(self.docs), max(1, SCORES // len(self.docs))
        parts = [NONE]
        for first in range(0, len(ids), rows):
            last = min(first + rows, len(ids))
            own = slice(ends[first], ends[last])
            at = np.minimum(np.searchsorted(self.terms, terms[own]), len(self.terms) - 1)
            here = self.terms[at] == terms[own]
            query = np.repeat(np.arange(last - first), sizes[first:last])[here]
            floors = np.maximum(known[first:last].min(axis=1) - EDGE, 0)
            scores = self.scores(query, at[here], weights[own][here], floors)
            scores[:, self.nameless] = 0
            here = slice(first, last)
            scores[np.repeat(np.arange(last - first), same[here]), self.by_id[spread(start[here], same[here])]] = 0
            if width > k:
                floors = np.maximum(floors, np.partition(scores, width - k, axis=1)[:, width - k] - EDGE)
            asked, found = np.nonzero((scores >= floors[:, None]) & (scores > 0))
            score = np.round(scores[asked, found], DIGITS)
            order = np.lexsort((self.docs[found], -score, asked))
            asked, found, score = asked[order], found[order], score[order]
            rank = np.arange(len(asked)) - np.searchsorted(asked, asked)
            top = rank < k
            asked, found, score = asked[top], found[top], score[top]
            new = np.zeros((last - first, k))
            new[asked, rank[top]] = score
            known[here] = np.sort(np.concatenate([known[here], new], axis=1), axis=1)[:, -k:]
            parts.append((ids[first + asked], self.docs[found], score))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def searched(shard_rows: DataFrame, packed: DataFrame, mean: float, k: int) -> DataFrame:
    """query_id, doc_id and score: each shard's best for each query of one packed block.

    A task leaves out what can't be among the k best of the shards that it has seen.
    """

    def answers(value: dict[str, pa.Scalar], known: list[np.ndarray]) -> pa.RecordBatch:
        numbers = {n: value[n].values.to_numpy(zero_copy_only=False) for n in ("lengths", "terms", "counts")}
        parts = {n: value[n].as_buffer() for n in ("places", "tfs")}
        shard = Shard(value["docs"].values, **numbers, **parts, mean=mean)
        ids, terms, weights = (value["queries"].values.field(n) for n in ("query_id", "terms", "weights"))
        if not known:  # the queries are the same beside every shard
            known.append(np.zeros((len(ids), k)))
        sizes = terms.value_lengths().to_numpy()
        asked = (x.to_numpy(zero_copy_only=False) for x in (terms.flatten(), weights.flatten()))
        found = shard.best(ids.to_numpy(), sizes, *asked, known[0])
        return pa.record_batch([pa.array(x) for x in found], ["query_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = []
        for batch in batches:
            for row in range(batch.num_rows):
                yield answers({name: batch.column(name)[row] for name in batch.schema.names}, known)

    joined = shard_rows.withColumn("block", F.lit(0)).join(F.broadcast(packed), "block").drop("block")
    return joined.mapInArrow(run, "query_id bigint, doc_id bigint, score double")


def kept_in_batches(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """A kept table of rows from Python, sent there in batches of ``BATCH_BYTES`` or one row.

    An executor holds a task's batch outside of its heap, in buffers of up to twice its size.
    A limit that the session has set itself stays.
    """
    if spark.conf.get(BATCH_KEY, None):
        return kept_table(spark, rows, label)
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        return kept_table(spark, rows, label)
    finally:
        spark.conf.unset(BATCH_KEY)


def top_k(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id and score of the k best documents for each query (doc_id, text)."""
    rows = picked(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    index = kept_in_batches(spark, shards(rows), "shards")
    length = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    total = index.agg(F.sum(F.size("docs")).alias("rows"), F.sum(length).alias("words")).first()
    count, mean = total["rows"] or 0, max((total["words"] or 0) / max(total["rows"] or 0, 1), 1e-9)
    asked = picked(queries).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    terms = kept_in_batches(spark, query_terms(asked), "query-terms")
    df = (
        index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
        .join(terms.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("df"))
    )
    idf = F.log(1 + (count - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = terms.join(df, "term").withColumn("weight", F.col("n") * idf)
    size = terms.agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("terms")).first()
    parts = max(1, -(-size["queries"] // QUERIES_PER_BLOCK), -(-size["terms"] // TERMS_PER_BLOCK))
    packed = (
        weighed.groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("x"))
        .select(
            F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"),
            F.struct("query_id", F.col("x.term").alias("terms"), F.col("x.weight").alias("weights")).alias("query"),
        )
        .groupBy("part")
        .agg(F.collect_list("query").alias("queries"))
    )
    packed = kept_table(spark, packed, "queries")
    found = None
    for part in range(parts):
        block = packed.where(F.col("part") == part).select(F.lit(0).alias("block"), "queries")
        result = kept_in_batches(spark, searched(index, block, mean, k), "found")
        found = result if found is None else found.unionByName(result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The registered query: every document whose id is divisible by 50 against all others."""
    return top_k(spark, docs, docs.where(F.col("doc_id") % 50 == 0))
