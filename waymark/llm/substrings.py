"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

Every window of 13 words of every document is hashed, and the hashes are counted in
Spark: a window is repeated if its hash also starts in a document with a smaller id.
Repeated windows next to each other merge into maximal intervals, whose words go.

Windows are grouped by the smallest hash of their four-word parts. Equal windows meet in
one group, and neighbours mostly share theirs, so a group gets runs of windows and sends
intervals back. There are as many buckets of groups as the windows need, and a group that
would fill a bucket by itself (a phrase that a large part of all texts has) is split by
the windows' own hashes: equal windows still meet, only runs get shorter. A sample of the
rows tells how many buckets and which groups; it decides on the plan, not on results.
Windows are equal if their 64-bit hashes and 32 bits of their smallest part are. Each task first settles repeats among the documents it holds at a time and
passes on only those of the smallest id, so a passage that a third of all rows shares
arrives once from each such set. No words travel but in the last join with the texts.

Null and empty texts have no words; texts under 13 words lose none. Rows with a null id
neither lose words nor make others lose them. Rows that share an id are one document, so
they keep each other's windows, and each loses its own. Ids are whole numbers. An empty
table gives an empty one. A long text is cut into windows whole; other columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_table, picked, ship_by_value
from .vectors import blocks, hashed_rows, plain_words, rolling, run_starts, spread

ship_by_value(__name__)

WINDOW = 13
PART = 4
CHARS_PER_BLOCK = 2_000_000
WINDOWS_PER_FLUSH = 1_200_000
# A bucket is settled by one task in some 50 bytes for each window.
WINDOWS_PER_BUCKET = 4_000_000
SAMPLE_SHARE = 0.02

GROUP_SCHEMA = "bucket int, hashes binary, runs binary, docs binary, tags binary"


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes, all lowest ones first: the high zeros then compress away."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def window_parts(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window, and the smallest hash of its parts."""
    windows = rolling(hashes, size)
    part = min(PART, size)
    parts = rolling(hashes, part)
    least = parts[: len(windows)].copy()
    for j in range(1, size - part + 1):
        np.minimum(least, parts[j : j + len(windows)], out=least)
    return windows, least


def runs_of(doc: np.ndarray, place: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of neighbouring places of one document (and equal keys) start, and their lengths."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] != 1)
    for key in keys:
        breaks |= key[1:] != key[:-1]
    starts = np.concatenate([[0], np.flatnonzero(breaks) + 1])
    return starts, np.diff(np.concatenate([starts, [len(doc)]]))


def grouped_order(window: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal windows stand together, otherwise as they were, and where each starts anew."""
    by_hash = np.argsort(window, kind="stable")
    differ = window[by_hash[1:]] != window[by_hash[:-1]]
    other = mark[by_hash[1:]] != mark[by_hash[:-1]]
    if (other & ~differ).any():  # hashes that meet by chance
        by_hash = np.lexsort((mark, window))
        differ = window[by_hash[1:]] != window[by_hash[:-1]]
        other = mark[by_hash[1:]] != mark[by_hash[:-1]]
    return by_hash, np.concatenate([[True], differ | other])


def marks(least: np.ndarray) -> np.ndarray:
    return (least >> np.uint64(16)).astype(np.uint32).view(np.int32)


@dataclass(frozen=True)
class Buckets:
    """Where the windows of each group go: ``many`` buckets, and further ones for split groups."""

    many: int
    split: np.ndarray  # sorted smallest parts
    parts: np.ndarray  # buckets of each

    def of(self, least: np.ndarray, window: np.ndarray) -> np.ndarray:
        bucket = (least % np.uint64(self.many)).astype(np.int64)
        if len(self.split):
            at = np.minimum(np.searchsorted(self.split, least), len(self.split) - 1)
            hot = np.flatnonzero(self.split[at] == least)
            own = at[hot]
            # By the high bits: a bucket's windows are sorted by all of them later.
            part = (window[hot] >> np.uint64(32)) % self.parts[own].astype(np.uint64)
            bucket[hot] = self.many + run_starts(self.parts)[own] + part.astype(np.int64)
        return bucket


def chosen_buckets(docs: DataFrame, size: int) -> Buckets:
    """From a sample of the rows: the number of buckets, and groups with more windows than one should have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_BLOCK):
                parts = [window_parts(h, size)[1] for h in hashed_rows([plain_words(text) for text in block])]
                least, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch([pa.array(least.view(np.int64)), pa.array(n.astype(np.int64))], ["least", "n"])

    sampled = docs.select("text").sample(SAMPLE_SHARE, seed=5).mapInArrow(run, "least bigint, n bigint")
    counted = kept_table(docs.sparkSession, sampled.groupBy("least").agg(F.sum("n").alias("n")), "window-counts")
    total = (counted.agg(F.sum("n")).first()[0] or 0) / SAMPLE_SHARE
    hot = counted.where(F.col("n") > SAMPLE_SHARE * WINDOWS_PER_BUCKET).collect()  # at most the total's share
    hot = sorted((np.uint64(r["least"] % 2**64), r["n"]) for r in hot)
    many = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // WINDOWS_PER_BUCKET))
    split = np.array([x for x, _ in hot], np.uint64)
    parts = np.array([1 + int(n / SAMPLE_SHARE) // WINDOWS_PER_BUCKET for _, n in hot], np.int64)
    return Buckets(many, split, 2 * parts)


def intervals(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """One row for each document with its runs of covered windows as start, length, ..."""
    starts, lengths = runs_of(doc, place)
    owner = doc[starts]
    first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1]) if len(owner) else np.zeros(0, np.int64)
    flat = np.column_stack([place[starts], lengths]).astype(np.int32).reshape(-1)
    offsets = np.concatenate([first * 2, [len(flat)]]).astype(np.int32) if len(owner) else np.zeros(1, np.int32)
    own = owner[first]
    return pa.record_batch(
        [pa.array(ids[own]), pa.array(tags[own]), pa.ListArray.from_arrays(offsets, flat)],
        ["doc_id", "tag", "spans"],
    )


def task_groups(
    ids: np.ndarray, tags: np.ndarray, rows: list[np.ndarray], size: int, buckets: Buckets
) -> Iterator[tuple]:
    """Rows of GROUP_SCHEMA for one task's documents; bucket -1 - b carries settled intervals."""
    order = np.argsort(ids, kind="stable")
    parts = [window_parts(rows[i], size) for i in order]
    counts = np.array([len(w) for w, _ in parts], np.int64)
    if not counts.sum():
        return
    window = np.concatenate([w for w, _ in parts])
    least = np.concatenate([p for _, p in parts])
    ids, tags = ids[order], tags[order]
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    place = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
    # Documents are in id order, so the first of equal hashes has the smallest id.
    by_hash, fresh = grouped_order(window, marks(least))
    smallest = np.empty(len(doc), np.int64)
    smallest[by_hash] = ids[doc[by_hash[np.flatnonzero(fresh)]]][np.cumsum(fresh) - 1]
    settled = ids[doc] > smallest
    at = np.flatnonzero(settled)
    if len(at):
        done = intervals(ids, tags, doc[at], place[at])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, done.schema) as writer:
            writer.write_batch(done)
        yield (-1 - int(ids[doc[at[0]]] % buckets.many), b"", sink.getvalue().to_pybytes(), b"", b"")
    left = np.flatnonzero(~settled)
    of_window = buckets.of(least[left], window[left])
    start, length = runs_of(doc[left], place[left], least[left], of_window)
    bucket = of_window[start]
    start = left[start]
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
    for group in np.split(by_bucket, cuts):
        at, n = start[group], length[group]
        own, index = np.unique(doc[at], return_inverse=True)
        table = np.column_stack([index, place[at], n, marks(least[at])]).astype(np.int32).reshape(-1, 4)
        yield (
            int(bucket[group[0]]),
            window[spread(at, n)].tobytes(),
            planes(np.ascontiguousarray(table.T).reshape(-1)),
            planes(ids[own]),
            planes(tags[own]),
        )


def settle(groups: list[dict]) -> pa.RecordBatch:
    """Covered intervals of one bucket's windows."""
    hashes = [np.frombuffer(g["hashes"], np.uint64) for g in groups]
    ids = [from_planes(g["docs"], np.int64) for g in groups]
    tags = np.concatenate([from_planes(g["tags"], np.int32) for g in groups])
    base = run_starts(np.array([len(x) for x in ids]))
    runs = [from_planes(g["runs"], np.int32).reshape(4, -1).astype(np.int64) for g in groups]
    index = np.concatenate([r[0] + b for r, b in zip(runs, base, strict=True)])
    start = np.concatenate([r[1] for r in runs])
    length = np.concatenate([r[2] for r in runs])
    all_ids, window = np.concatenate(ids), np.concatenate(hashes)
    doc = np.repeat(index, length)
    place = spread(start, length)
    by_hash, fresh = grouped_order(window, np.repeat(np.concatenate([r[3] for r in runs]), length))
    firsts = np.flatnonzero(fresh)
    least = np.minimum.reduceat(all_ids[doc[by_hash]], firsts)
    covered = np.zeros(len(doc), bool)
    covered[by_hash] = all_ids[doc[by_hash]] > least[np.cumsum(fresh) - 1]
    at = np.flatnonzero(covered)
    at = at[np.lexsort((place[at], doc[at]))]
    return intervals(all_ids, tags, doc[at], place[at])


def repeated_spans(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, tag of the row, and the covered windows as start, length, ...; many rows for a document."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    buckets = chosen_buckets(rows, size)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tags, rows, total = [], [], [], 0

        def flush():
            found = list(task_groups(np.array(ids, np.int64), np.array(tags, np.int32), rows, size, buckets))
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = [pa.int32(), *[pa.binary()] * 4]
            names = ["bucket", "hashes", "runs", "docs", "tags"]
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_BLOCK):
                rows += hashed_rows([plain_words(text) for text in block])
                ids += batch.column("doc_id").slice(done, len(block)).to_pylist()
                tags += batch.column("tag").slice(done, len(block)).to_pylist()
                done += len(block)
                total += sum(map(len, rows[-len(block) :]))
                if total >= WINDOWS_PER_FLUSH:
                    yield flush()
                    ids, tags, rows, total = [], [], [], 0
        yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] < 0:
                    yield from pa.ipc.open_stream(row["runs"])
                    continue
                if waiting and waiting[0]["bucket"] != row["bucket"]:
                    yield settle(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield settle(waiting)

    grouped = rows.select(F.col("doc_id").cast("bigint"), "text", "tag").mapInArrow(group, GROUP_SCHEMA)
    met = grouped.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(meet, "doc_id bigint, tag int, spans array<int>")


def kept_words(words: list[bytes], spans: list[list[int]] | None, size: int) -> list[bytes]:
    """The words that no covered window holds."""
    if not spans:
        return words
    runs = np.concatenate([np.array(x, np.int64) for x in spans]).reshape(-1, 2)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1] + size - 1, -1)
    return [w for w, n in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not n]


def deduplicated(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text with its white space as single spaces and without repeats, n_words and n_removed."""
    return _finished(docs, size, lambda kept: b" ".join(kept).decode("utf-8", "surrogatepass"), "kept")


def digest(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The columns of the registered query."""
    return _finished(docs, size, lambda kept: hashlib.sha256(b" ".join(kept)).hexdigest(), "kept_sha256")


def _finished(docs: DataFrame, size: int, made, name: str) -> DataFrame:
    rows = picked(docs)
    rows = rows.withColumn("tag", F.hash(F.coalesce("text", F.lit(""))))
    spans = (
        repeated_spans(rows, size)
        .groupBy(F.col("doc_id").alias("own_id"), F.col("tag").alias("own_tag"))
        .agg(F.collect_list("spans").alias("spans"))
    )
    same = (F.col("doc_id") == F.col("own_id")) & (F.col("tag") == F.col("own_tag"))
    joined = rows.join(spans, same, "left").select("doc_id", "text", "spans")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = plain_words(text)
                kept = kept_words(words, found, size)
                out.append((len(words), len(words) - len(kept), made(kept)))
            n, gone, result = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(result, pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n_words", "n_removed", name])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(finish, f"doc_id {kind}, n_words bigint, n_removed bigint, {name} string")
