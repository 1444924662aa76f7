"""Quality classifier: hashed word and character n-gram vectors, averaged per document, then softmax.

Every word gives a vector for itself and one for each of its 2- to 4-grams of
characters between word marks; a word that repeats the one before it gives the vector of
a repeated word, any other the vector of a fresh word. All are learned together with the
output weights by numpy stochastic gradient descent on a bounded sample of labelled rows.
Since the average and the output weights are linear, a word's share of the score is one
number, computed once per distinct word of a batch.

Null and empty texts have no features and get the score of the bias alone. Rows with
null labels or ids don't train; without labelled rows every score is 0.5. Repeated rows get
equal scores; an empty table gives an empty one. A long text is averaged whole; other
columns pass through, and can have any name but that of the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import picked, ship_by_value
from .vectors import Grams, blocks, numbered, run_starts, run_sums, spread

ship_by_value(__name__)

BUCKETS = 1 << 17
SIZE = 16
SAMPLE_ROWS = 2000
CHARS_PER_BLOCK = 4_000_000
WORDS_AT_ONCE = 20_000
EPOCHS = 8
RATE = 8.0
KEEP_FROM = 0.3
REPEATED, FRESH = BUCKETS, BUCKETS + 1


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo the divisor."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of every word, word by word, and how many each has."""
    grams = Grams(words)
    found = [grams.whole(), *[grams.grams(n) for n in (2, 3, 4)]]
    owner = np.concatenate([w for w, _ in found])
    bucket = np.concatenate([v for _, v in found]) % np.uint64(BUCKETS)
    order = np.argsort(owner, kind="stable")
    return bucket[order].astype(np.int64), np.bincount(owner, minlength=len(words))


def repeats(row: np.ndarray) -> int:
    return int((row[1:] == row[:-1]).sum())


def document_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct feature numbers and their share of each document's features."""
    out = []
    for block in blocks(texts, CHARS_PER_BLOCK // 8):
        rows, words = numbered(block)
        flat, counts = features(words)
        starts = run_starts(counts)
        for row in rows:
            again = repeats(row)
            extra = np.repeat([REPEATED, FRESH], [again, len(row) - again])
            ids, n = np.unique(np.concatenate([flat[spread(starts[row], counts[row])], extra]), return_counts=True)
            out.append((ids.astype(np.int32), (n / max(n.sum(), 1)).astype(np.float32)))
    return out


@dataclass
class Model:
    """Score of each feature (output weight times vector) and the bias, both as log odds of label 1."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows, words = numbered(texts)
        sums, counts = np.zeros(len(words)), np.zeros(len(words), np.int64)
        for at in range(0, len(words), WORDS_AT_ONCE):
            own = slice(at, at + WORDS_AT_ONCE)
            flat, counts[own] = features(words[own])
            sums[own] = run_sums(self.weight[flat], counts[own])
        out = np.empty(len(rows))
        for i, row in enumerate(rows):
            again = repeats(row)
            total = sums[row].sum() + self.weight[REPEATED] * again + self.weight[FRESH] * (len(row) - again)
            out[i] = self.bias + total / max(counts[row].sum() + len(row), 1)
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def train(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Stochastic gradient descent, one document at a time, with a falling rate."""
    if not texts:
        return Model(np.zeros(BUCKETS + 2, np.float32), 0.0)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS + 2, SIZE)).astype(np.float32)
    output, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    data = document_features(texts)
    steps, done = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(data)):
            ids, share = data[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ vectors[ids]
            logits = output @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= rate / SIZE * np.outer(error, mean)
            bias -= 0.01 * error
            # Steps follow the share of a feature, so common n-grams don't swamp rare ones.
            vectors[ids] -= rate * np.sqrt(share)[:, None] * back
    return Model(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled rows outside the held-out fold, chosen by a hash of their id."""
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), 5) != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return picked(docs).join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the bounded sample; its texts come to the driver, nothing else does."""
    sample = sorted((r.doc_id, r.text, r.quality) for r in training_rows(docs, labels, rows).collect())
    return train([x[1] for x in sample], [x[2] for x in sample])


def scored(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Add the score to whole rows of ``docs``; the other columns pass through."""
    kept = docs.columns

    def run(batches):
        for batch in batches:
            texts, done = batch.column(kept.index("text")).to_pylist(), 0
            for block in blocks(texts, CHARS_PER_BLOCK):
                part = batch.slice(done, len(block))
                done += len(block)
                yield pa.record_batch([*part.columns, pa.array(model.scores(block))], [*kept, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def predicted(score: str = "score") -> Column:
    return (F.col(score) >= KEEP_FROM).cast("int")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    rows = scored(picked(docs), fit(docs, labels))
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", predicted().alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with their own columns."""
    rows = scored(docs, fit(docs, labels), "__quality")
    return rows.where(predicted("__quality") == 1).drop("__quality")
