"""MinHash near-duplicate groups by an LSH forest.

A document's set is its distinct word shingles. Equal sets are one class from the start,
and one document stands for it. A class's signature is sorted in several orders, each
starting at other values. In each order, classes with the same first ``DEPTH`` values
form a region; neighbours there share the longest prefixes and are candidates. A large
region is cut by the values that follow, deeper and deeper, so depth adapts to density.
In each region every class is also a candidate with the most central one, which finds
the original among thousands of edited copies. Pairs of a region that are still in
different groups after that are compared too (``rest_links``), so no link hangs on its
place in an order or on how well signatures agree.

Candidates whose signatures agree too little wait for ``rest_links``, which leaves out
only what sizes and bucket counts of the sets prove to be no link; all others are
confirmed on their full sets. Groups are connected components of the confirmed links.

Null texts and texts without words have empty sets and no links. Shorter texts have
their whole word sequence as the only shingle. Repeated rows are in one group. Rows with
a null id get a null group and link nothing. Ids are whole numbers. An empty table gives an
empty one. A text of any length is one set, held whole by a task; other columns can have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept_table, picked, ship_by_value, small_side
from .vectors import blocks, hashed_rows, mixed, plain_words, rolling

ship_by_value(__name__)

SIMILAR = 80
VALUES = 160
ORDERS = 24
DEPTH = 5
LEVELS = 4
# The chance that a link's 2-bit sketches agree less than this is about one in ten thousand.
LEAST_AGREEMENT = 0.66
# Shingles are counted in so many buckets; the smaller counts of two sets bound what they share.
BUCKETS = 128
DENSE = 24
PIECE = 500

_draw = np.random.default_rng(20)
FACTORS = _draw.integers(0, 2**63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _draw.integers(0, 2**63, VALUES, np.uint64)
# Of a byte with four 2-bit values: how many aren't zero.
DIFFER = np.array([sum((x >> s) & 3 > 0 for s in (0, 2, 4, 6)) for x in range(256)], np.uint8)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a word sequence."""
    return np.unique(rolling(hashes, min(size, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def text_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    return [shingle_set(h, size) for h in hashed_rows([plain_words(t, lower=True) for t in texts])]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function, as 16 bits."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        values = shingles[at : at + 256, None] * FACTORS + SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def bucket_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles of a set are in each bucket."""
    return np.bincount((mixed(shingles) >> np.uint64(32)).astype(np.int64) % BUCKETS, minlength=BUCKETS).astype(np.uint32)


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (null if empty), signature and bucket counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), 4_000_000):
                sets = text_sets(block, size)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                signs = [signature(s).tobytes() if len(s) else None for s in sets]
                buckets = [bucket_counts(s).tobytes() if len(s) else None for s in sets]
                ids = batch.column("doc_id").slice(done, len(block))
                done += len(block)
                counts = pa.array([len(s) for s in sets], pa.int64())
                columns = [ids, counts, *[pa.array(x, pa.binary()) for x in (keys, signs, buckets)]]
                yield pa.record_batch(columns, ["doc_id", "n_shingles", "set_key", "signature", "buckets"])

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, signature binary, buckets binary")


def forest_rows(classes: DataFrame, whole: bool = False) -> DataFrame:
    """One row for each class and order: region, the values that follow, and 2 bits of each value.

    ``classes`` has doc_id, label (its group so far), signature and buckets. With ``whole``
    the sketch is the bucket counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(n, VALUES)
            low = (signs & 3).astype(np.uint8).reshape(n, -1, 4)
            sketch = low[:, :, 0] | low[:, :, 1] << 2 | low[:, :, 2] << 4 | low[:, :, 3] << 6
            sketches = batch.column("buckets") if whole else pa.array([x.tobytes() for x in sketch], pa.binary())
            for order in range(ORDERS):
                columns = (order * DEPTH + np.arange(DEPTH + LEVELS)) % VALUES
                own = signs[:, columns].astype(np.uint64)
                region = np.full(n, order + 1, np.uint64)
                for j in range(DEPTH):
                    region = mixed(region * np.uint64(65_537) + own[:, j])
                follow = np.zeros(n, np.uint64)
                for j in range(DEPTH, DEPTH + LEVELS):
                    follow = follow << np.uint64(16) | own[:, j]
                yield pa.record_batch(
                    [
                        pa.array(region.view(np.int64)),
                        pa.array(follow.view(np.int64)),
                        batch.column("doc_id"),
                        batch.column("label"),
                        sketches,
                    ],
                    ["region", "follow", "doc_id", "label", "sketch"],
                )

    return classes.mapInArrow(run, "region bigint, follow bigint, doc_id bigint, label bigint, sketch binary")


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches; unequal values agree in 2 bits one time in four."""
    same = 1 - DIFFER[left ^ right].sum(axis=-1) / VALUES
    return (same - 0.25) / 0.75


def most_central(sketch: np.ndarray) -> int:
    """The row that agrees most with the region's most common values."""
    bits = (sketch[:, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
    flat = bits.reshape(len(sketch), -1)
    counts = np.stack([(flat == v).sum(axis=0) for v in range(4)])
    return int((flat == counts.argmax(axis=0)).sum(axis=1).argmax())


def region_pairs(follow: np.ndarray, sketch: np.ndarray, base: int, out: list[tuple], depth: int = 0) -> None:
    """Candidates of one region as (position, position, is_central), deeper where it is dense."""
    n = len(follow)
    if n < 2:
        return
    centre = most_central(sketch) if n > 2 else 0
    good = agreement(sketch, sketch[centre]) >= LEAST_AGREEMENT
    good[centre] = False
    out += [(base + centre, base + int(i), depth == 0) for i in np.flatnonzero(good)]
    if n > DENSE and depth < LEVELS:
        level = (follow.view(np.uint64) >> np.uint64(16 * (LEVELS - 1 - depth))) & np.uint64(0xFFFF)
        cuts = np.concatenate([[0], np.flatnonzero(level[1:] != level[:-1]) + 1, [n]])
        if len(cuts) > 2:
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                region_pairs(follow[a:b], sketch[a:b], base + a, out, depth + 1)


def candidates(forest: DataFrame) -> DataFrame:
    """Candidate pairs a < b with ``central``, and rows without b: what meets a range's bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [b for b in batches if b.num_rows]
        if not whole:
            return
        table = pa.Table.from_batches(whole)
        region, follow, ids = (table.column(c).to_numpy() for c in ("region", "follow", "doc_id"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        cuts = np.concatenate([[0], np.flatnonzero(region[1:] != region[:-1]) + 1, [len(ids)]])
        pairs: list[tuple] = []
        for i in np.flatnonzero(np.diff(cuts) > 1).tolist():
            a, b = cuts[i], cuts[i + 1]
            region_pairs(follow[a:b], sketch[a:b], int(a), pairs)
        beside = np.flatnonzero(region[1:] == region[:-1])
        beside = beside[agreement(sketch[beside], sketch[beside + 1]) >= LEAST_AGREEMENT]
        first = np.array([p[0] for p in pairs] + beside.tolist(), np.int64)
        second = np.array([p[1] for p in pairs] + (beside + 1).tolist(), np.int64)
        central = np.array([p[2] for p in pairs] + [False] * len(beside), bool)
        a, b = np.minimum(ids[first], ids[second]), np.maximum(ids[first], ids[second])
        # A region can go on in the next range: its ends and centre meet the other pieces'.
        meets = set()
        for x, y in ((cuts[0], cuts[1]), (cuts[-2], cuts[-1])):
            for i in (x, y - 1, x + (most_central(sketch[x:y]) if y - x > 2 else 0)):
                meets.add((int(region[i]), int(ids[i])))
        where, who = (np.array(v, np.int64) for v in zip(*sorted(meets), strict=True))
        n, m = len(a), len(who)
        columns = [
            pa.array(np.concatenate([np.zeros(n, np.int64), where])),
            pa.array(np.concatenate([a, who])),
            pa.array(np.concatenate([b, np.zeros(m, np.int64)]), mask=np.arange(n + m) >= n),
            pa.array(np.concatenate([central, np.ones(m, bool)])),
        ]
        yield pa.record_batch(columns, ["region", "a", "b", "central"])

    ordered = forest.repartitionByRange("region", "follow", "doc_id").sortWithinPartitions("region", "follow", "doc_id")
    return ordered.mapInArrow(run, "region bigint, a bigint, b bigint, central boolean")


def distinct_pairs(found: DataFrame) -> DataFrame:
    """Each pair once, with the number of times it was found.

    Pieces of a region are few, at most three ids for each end of a partition.
    """
    pieces = found.where("b IS NULL").groupBy("region").agg(F.array_sort(F.collect_set("a")).alias("ids"))
    steps = F.transform(
        F.sequence(F.lit(1), F.size("ids") - 1),
        lambda i: F.struct(F.get("ids", i - 1).alias("a"), F.get("ids", i).alias("b")),
    )
    joined = pieces.where(F.size("ids") > 1).select(F.explode(steps).alias("p")).select("p.a", "p.b", F.lit(True).alias("central"))
    pairs = found.where("b IS NOT NULL").select("a", "b", "central").unionByName(joined)
    return pairs.groupBy("a", "b").agg(F.max("central").alias("central"), F.count(F.lit(1)).alias("times"))


def first_pairs(pairs: DataFrame) -> DataFrame:
    """For each class the central pair that was found most often, so at most one pair for each class."""
    best = F.max(F.struct("times", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("best")
    ends = pairs.where("central").select(F.explode(F.array("a", "b")).alias("doc_id"), "times", "a", "b")
    return ends.groupBy("doc_id").agg(best).select((-F.col("best.a")).alias("a"), (-F.col("best.b")).alias("b")).distinct()


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id and shingle set of the documents named in ``ids`` (distinct, named doc_id)."""
    rows = docs.join(small_side(docs.sparkSession, ids), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), 4_000_000):
                sets = pa.array([s.tobytes() for s in text_sets(block, size)], pa.binary())
                yield pa.record_batch([batch.column("doc_id").slice(done, len(block)), sets], ["doc_id", "shingles"])
                done += len(block)

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id bigint, shingles binary")


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two full sets are a link, by whole numbers."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= SIMILAR * (len(left) + len(right) - both)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b that are links on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                keep.append(similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a bigint, b bigint")


def components(spark: SparkSession, links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id and the smallest id it reaches, for every document with a link.

    ``known`` has the groups by links seen before. Each round hooks every end of a link to
    its smallest neighbour, follows the hooks to their roots, and goes on with the links
    between different roots only, so a round joins far fewer links than the one before.
    """
    if known is not None:
        links = _between(links, known)
    links = kept_table(spark, links.select("a", "b").distinct(), "links")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("doc_id")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
        hooks = _roots(spark, kept_table(spark, hooks, "hooks"))
        known = hooks if known is None else kept_table(spark, _relabelled(known, hooks), "labels")
        links = kept_table(spark, _between(links, hooks), "links")
    return known if known is not None else links.select(F.col("a").alias("doc_id"), F.col("b").alias("label"))


def _roots(spark: SparkSession, hooks: DataFrame) -> DataFrame:
    """Each id with the root of its hooks; every round doubles the steps."""
    while True:
        own = hooks.select(F.col("doc_id").alias("label"), F.col("label").alias("next"))
        jumped = hooks.join(own, "label").select("doc_id", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved"))
        jumped = kept_table(spark, jumped, "hooks")
        if jumped.where("moved").isEmpty():
            return jumped.drop("moved")
        hooks = jumped.drop("moved")


def _relabelled(known: DataFrame, hooks: DataFrame) -> DataFrame:
    """The groups after their labels were hooked, and ids that had none before."""
    moved = hooks.select(F.col("doc_id").alias("old"), F.col("label").alias("new"))
    again = known.join(moved, F.col("label") == F.col("old"), "left").select("doc_id", F.coalesce("new", "label").alias("label"))
    return again.unionByName(hooks.join(known.select("doc_id"), "doc_id", "left_anti"))


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between different groups, as pairs of labels."""
    joined = _with_labels(links, labels).where("label_a <> label_b")
    return joined.select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct()


def _with_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """a and b of each pair with their groups so far, which are their own ids without a label."""
    a = labels.select(F.col("doc_id").alias("a"), F.col("label").alias("of_a"))
    b = labels.select(F.col("doc_id").alias("b"), F.col("label").alias("of_b"))
    joined = pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    return joined.select("a", "b", F.coalesce("of_a", "a").alias("label_a"), F.coalesce("of_b", "b").alias("label_b"))


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different groups so far."""
    return _with_labels(pairs, labels).where("label_a <> label_b").select("a", "b")


def rest_members(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """Who must still be compared: group, doc_id, label and whether the class visits the group.

    In a region with several groups, members of the largest one are compared with the
    others only, which are its visitors. Regions are cut into pieces of some ``PIECE``
    members and visitors go to every piece, so no task holds a large region. Classes
    that can't have a link to another group there are left out.
    """
    sizes = forest_rows(classes).groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed_regions = (
        sizes.groupBy("region")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("groups"), F.max(F.struct("n", "label")).alias("most"))
        .where("groups > 1")
        .select("region", F.col("most.label").alias("largest"), F.ceil(F.col("total") / PIECE).cast("int").alias("pieces"))
    )
    rows = forest_rows(classes, whole=True).join(small_side(spark, mixed_regions), "region")
    met = _with_visitors(rows, F.col("label") != F.col("largest"), ["region"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["region", "piece"]):
            found, largest = {}, None
            for visitor, partners in _possible(group):
                largest = visitor["largest"]
                found[visitor["doc_id"]] = (visitor["label"], True)
                for x in partners:
                    found.setdefault(x["doc_id"], (x["label"], False))
            rows = [(largest, doc_id, *marks) for doc_id, marks in sorted(found.items())]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [*[pa.int64()] * 3, pa.bool_()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["largest", "doc_id", "label", "visitor"]
            )

    found = met.mapInArrow(run, "largest bigint, doc_id bigint, label bigint, visitor boolean")
    return found.groupBy("largest", "doc_id", "label").agg(F.max("visitor").alias("visits"))


def rest_links(spark: SparkSession, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Links between groups that no candidate pair has found, confirmed on full sets.

    Sets travel once for each piece of a group that a class is in or visits. A pair whose
    groups a link of the piece has joined already is left out, so fewer links than groups come out.
    """
    members = kept_table(spark, rest_members(spark, classes), "rest")
    sets = kept_table(spark, full_sets(docs, members.select("doc_id").distinct(), size), "sets")
    counts = members.groupBy("largest").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    signs = classes.select("doc_id", F.col("buckets").alias("sketch"))
    rows = members.join(small_side(spark, counts), "largest").join(signs, "doc_id").join(sets, "doc_id")
    met = _with_visitors(rows, F.col("visits"), ["largest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["largest", "piece"]):
            links, root = [], {}

            def find(label: int) -> int:
                while (up := root.get(label, label)) != label:
                    label = up
                return label

            for visitor, partners in _possible(group):
                own = np.frombuffer(visitor["shingles"], np.uint64)
                for x in partners:
                    low, high = sorted((find(visitor["label"]), find(x["label"])))
                    if low != high and similar(own, np.frombuffer(x["shingles"], np.uint64)):
                        root[high] = low
                        links.append(tuple(sorted((visitor["doc_id"], x["doc_id"]))))
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return met.mapInArrow(run, "a bigint, b bigint").distinct()


def _with_visitors(rows: DataFrame, visits: Column, by: list[str]) -> DataFrame:
    """Each row in its own piece, and rows that visit once more in every piece, by group and piece."""
    own = F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int")
    members = rows.withColumns({"piece": own, "visitor": F.lit(False)})
    visitors = rows.where(visits).withColumn("visitor", F.lit(True))
    visitors = visitors.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return members.unionByName(visitors).repartition(*by, "piece").sortWithinPartitions(*by, "piece", "visitor")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[Iterator[dict]]:
    """Runs of rows with the same key, from rows in order."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return (group for _, group in groupby(rows, itemgetter(*by)))


def _possible(group: Iterator[dict]) -> Iterator[tuple[dict, list[dict]]]:
    """Each visitor with the members of other groups that can be links. Members come first.

    Two sets share at most the sum of the smaller bucket counts, so no link is left out.
    """
    members: list[dict] = []
    counts = None
    for row in group:
        if not row["visitor"]:
            members.append(row)
            continue
        if not members:
            return
        if counts is None:
            counts = np.frombuffer(b"".join(r["sketch"] for r in members), np.uint32).reshape(len(members), -1)
            sizes, labels = counts.sum(axis=1, dtype=np.int64), np.array([r["label"] for r in members], np.int64)
        own = np.frombuffer(row["sketch"], np.uint32)
        size = int(own.sum(dtype=np.int64))
        enough = 100 * np.minimum(sizes, size) >= SIMILAR * np.maximum(sizes, size)
        at = np.flatnonzero(enough & (labels != row["label"]))
        shared = np.minimum(counts[at], own).sum(axis=1, dtype=np.int64)
        at = at[(100 + SIMILAR) * shared >= SIMILAR * (sizes[at] + size)]
        if len(at):
            yield row, [members[i] for i in at.tolist()]


def labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The classes with their group so far: a label, or their own id."""
    found = labels.withColumnsRenamed({"doc_id": "own", "label": "found"})
    joined = classes.join(found, F.col("doc_id") == F.col("own"), "left")
    return joined.select("set_key", "doc_id", F.coalesce("found", "doc_id").alias("label"), "signature", "buckets")


def grouped(spark: SparkSession, docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    rows = picked(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = kept_table(spark, signed(rows, size), "signed")
    classes = kept_table(
        spark,
        marked.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("signature", "buckets")]),
        "classes",
    )
    alone = classes.withColumn("label", F.col("doc_id"))
    found = kept_table(spark, candidates(forest_rows(alone)), "candidates")
    pairs = kept_table(spark, distinct_pairs(found), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = kept_table(spark, full_sets(rows, ids, size), "sets")
    # One pair for each class joins most of a dense group; pairs inside a group so far are left out after that.
    labels = components(spark, confirmed(first_pairs(pairs), sets))
    for later in (pairs.where("central"), pairs.where("NOT central")):
        more = kept_table(spark, across(later, labels), "pairs")
        labels = components(spark, confirmed(more, sets), labels)
    labels = components(spark, rest_links(spark, labelled(classes, labels), rows, size), labels)
    named = labelled(classes, labels)
    named = kept_table(spark, named.select("set_key", F.col("label").alias("component")), "components")
    joined = marked.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def digest(spark: SparkSession, docs: DataFrame, size: int = 2) -> DataFrame:
    """The columns of the registered query."""
    rows = grouped(spark, docs, size)
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def kept_documents(spark: SparkSession, docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest id, with all its columns.

    Of rows that share an id and have words one stays. Rows with a null id and rows without
    words are in no group and stay, whatever id they have.
    """
    groups = kept_table(spark, grouped(spark, docs, size), "groups").where("doc_id IS NOT NULL AND n_shingles > 0")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    twice = groups.groupBy(F.col("doc_id").alias("__id")).count().where("count > 1").select("__id")
    gone, twice = small_side(spark, gone), small_side(spark, twice)
    has_words = F.coalesce(docs["text"].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = docs["doc_id"] == F.col("__id")
    kept = docs.where(has_words).join(gone, same, "left_anti")
    place = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    again = kept.join(twice, same, "left_semi").withColumn("__place", F.row_number().over(place))
    once = kept.join(twice, same, "left_anti").unionByName(again.where("__place = 1").drop("__place"))
    return once.unionByName(docs.where(~has_words))
