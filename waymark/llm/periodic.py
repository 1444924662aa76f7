"""Periodic runs of a text's words by descending-LCP Kruskal over its suffixes.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``LEAST_WORDS`` and two periods long, that no neighbouring word extends.

Suffixes are sorted by prefix doubling, many texts in one array, and the length of the
common prefix (LCP) of neighbours comes from the ranks of the doublings. The neighbours
are then edges, taken by decreasing LCP: union-find joins two classes of suffixes, the
smaller one's positions enter the larger one's ordered set, and positions that become
adjacent there at a distance within the LCP seed a run: it starts at the first of them
and ends LCP words after the second. Positions of a class share LCP words, so a smaller
period would put a position between the two; the distance is the smallest period. A seed
that the word before extends is part of a longer run and is left out.

A run of 12 words or more, two periods or more long, joins its suffixes at an LCP of 6 or
more, so only words whose next six stand elsewhere in the text too are sorted further.

Words are UTF-8 runs of characters other than space, tab, line feed, vertical tab, form
feed and return. Null and empty texts have no words and no runs. Every row is taken by
itself, so repeated rows and null ids get their own results; an empty table gives an
empty one; other columns can have any name. A whole text is in one task with some 100
bytes for each word.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked, ship_by_value
from .vectors import blocks, plain_words, run_starts

ship_by_value(__name__)

LEAST_WORDS = 12
CHARS_PER_BLOCK = 3_000_000


def word_numbers(rows: list[list[bytes]]) -> np.ndarray:
    """Equal words of a block as equal numbers from 1, with a number of its own after each row."""
    number = defaultdict(count(1).__next__)
    flat = np.fromiter((x for row in rows for x in (*map(number.__getitem__, row), 0)), np.int64)
    ends = np.flatnonzero(flat == 0)
    flat[ends] = len(number) + 1 + np.arange(len(ends))
    return flat


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where each group of equal ones starts, and each group's size."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, first, np.diff(np.concatenate([first, [len(keys)]]))


def sorted_suffixes(words: np.ndarray, owner: np.ndarray, common: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes that may share ``common`` words with another one of their text, in order,
    and every doubling's ranks: equal where the first 1, 2, 4, ... words (and texts) are.
    """
    n = len(words)
    order, first, sizes = _ranked(owner * np.int64(words.max() + 1) + words) if n else _ranked(words)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, sizes)
    ranks = [rank]
    width = 1
    tied = order[np.repeat(sizes > 1, sizes)]
    shared = tied
    while len(tied):
        # A tied suffix has ``width`` more words at least, as every text ends with a number of its own.
        own = rank[tied].astype(np.int64)
        by, first, sizes = _ranked(own * n + rank[tied + width])
        ordered = tied[by]
        rank = rank.copy()
        base = own[by]
        start = np.flatnonzero(np.concatenate([[True], base[1:] != base[:-1]]))
        within = np.arange(len(base)) - np.repeat(start, np.diff(np.concatenate([start, [len(base)]])))
        rank[ordered] = np.repeat((base + within)[first], sizes)
        ranks.append(rank)
        width *= 2
        tied = ordered[np.repeat(sizes > 1, sizes)]
        if width <= common:
            shared = tied
    return shared[np.argsort(ranks[-1][shared], kind="stable")], ranks


def neighbour_lcp(suffixes: np.ndarray, ranks: list[np.ndarray], owner: np.ndarray) -> np.ndarray:
    """Number of words that each sorted suffix shares with the next, 0 across texts."""
    a, b = suffixes[:-1], suffixes[1:]
    length = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][a + length] == ranks[level][b + length]
        length += same * (1 << level)
    return np.where(owner[a] == owner[b], length, 0)


def seeds(left: list[int], right: list[int], length: list[int]) -> Iterator[tuple[int, int, int]]:
    """Positions p, q and their LCP, for each pair that becomes adjacent within its LCP.

    Edges come by decreasing LCP. A class is kept as the ordered list of its positions
    under one of them; ``root`` leads there.
    """
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for p, q, lcp in zip(left, right, length, strict=True):
        a, b = find(p), find(q)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        root[b] = a
        members[a] = large
        if len(small) == 1:
            x = small[0]
            at = bisect_left(large, x)
            large.insert(at, x)
            if at and x - large[at - 1] <= lcp:
                yield large[at - 1], x, lcp
            if at + 1 < len(large) and large[at + 1] - x <= lcp:
                yield x, large[at + 1], lcp
            continue
        places = []
        for x in small:  # in order, so each place holds after those before it
            at = bisect_left(large, x)
            large.insert(at, x)
            places.append(at)
        last = -1
        for at, x in zip(places, small, strict=True):
            if at and last != at - 1 and x - large[at - 1] <= lcp:
                yield large[at - 1], x, lcp
            if at + 1 < len(large) and (y := large[at + 1]) - x <= lcp:
                i = bisect_left(small, y)
                if i == len(small) or small[i] != y:
                    yield x, y, lcp
            last = at


def block_runs(rows: list[list[bytes]], least: int = LEAST_WORDS) -> list[np.ndarray]:
    """The runs of each row as start, length, period, by start and then period."""
    words = word_numbers(rows)
    sizes = np.array([len(row) + 1 for row in rows], np.int64)
    starts = run_starts(sizes)
    owner = np.repeat(np.arange(len(rows)), sizes)
    common = (least + 1) // 2  # a run's suffixes share half of it at least
    suffixes, ranks = sorted_suffixes(words, owner, common)
    lcp = neighbour_lcp(suffixes, ranks, owner)
    edges = np.flatnonzero(lcp >= common)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    columns = (suffixes[edges], suffixes[edges + 1], lcp[edges])
    del ranks
    found = np.array(list(seeds(*(c.tolist() for c in columns))), np.int64).reshape(-1, 3)
    first, second, shared = found.T
    before = np.maximum(first - 1, 0)
    extended = (owner[before] == owner[first]) & (first > 0) & (words[before] == words[second - 1])
    period = second - first
    length = period + shared
    keep = ~extended & (length >= least)
    text, start, length, period = owner[first][keep], first[keep], length[keep], period[keep]
    order = np.lexsort((period, start))  # starts grow with texts
    text = text[order]
    runs = np.column_stack([start - starts[owner[first][keep]], length, period])[order]
    cuts = np.searchsorted(text, np.arange(1, len(rows)))
    return np.split(runs, cuts)


def kept_places(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words stays: it is in no run after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def _per_row(docs: DataFrame, least: int, made, fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """doc_id and what ``made`` gives for the words and runs of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_BLOCK):
                rows = [plain_words(text) for text in block]
                out = [made(words, runs) for words, runs in zip(rows, block_runs(rows, least), strict=True)]
                ids = batch.column("doc_id").slice(done, len(block))
                done += len(block)
                columns = [pa.array(x, kind) for x, (_, _, kind) in zip(zip(*out, strict=True), fields, strict=True)]
                yield pa.record_batch([ids, *columns], ["doc_id", *[name for name, _, _ in fields]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, ", ".join([f"doc_id {kind}", *[f"{name} {sql}" for name, sql, _ in fields]]))


def collapsed_words(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    return b" ".join(w for w, stays in zip(words, kept_places(len(words), runs).tolist(), strict=True) if stays)


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period of each) and the text with one period of each run."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def made(words: list[bytes], runs: np.ndarray) -> tuple:
        rows = [dict(zip(("start", "length", "period"), x, strict=True)) for x in runs.tolist()]
        return rows, collapsed_words(words, runs).decode("utf-8", "surrogatepass")

    fields = [
        ("runs", "array<struct<start:bigint,length:bigint,period:bigint>>", pa.list_(run)),
        ("collapsed", "string", pa.string()),
    ]
    return _per_row(picked(docs, doc_id, text), least, made, fields)


def with_loops(docs: DataFrame) -> DataFrame:
    """The registered query's input: one document in ten repeats a part of its own words.

    With h = crc32(doc_id as text), g = floor(h / 10), n words, a = g mod n and
    p = 1 + floor((n - a) / (3 + g mod 8)): where h mod 10 = 0, each word i >= a becomes
    word a + (i - a) mod p. Rows with a null id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.withColumns({"h": h, "g": F.floor(h / 10).cast("bigint")}).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    )
    n = F.size("words")
    sized = chosen.withColumn("n", F.when(n > 0, n)).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    sized = sized.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    part = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(part, F.ceil(rest / F.col("p")).cast("int")))
    looped = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), rest))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""

    def made(words: list[bytes], runs: np.ndarray) -> tuple:
        best: tuple = (None, None, None, None)
        if len(runs):
            start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
            best = (start, length, period, 1000 * length // period)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
        hashes = [hashlib.sha256(x).hexdigest() for x in (listed.encode(), collapsed_words(words, runs))]
        return len(runs), *best, *hashes

    numbers = ["n_runs", "start", "length", "period", "exponent_milli"]
    fields = [(name, "bigint", pa.int64()) for name in numbers]
    fields += [(name, "string", pa.string()) for name in ("runs_sha256", "collapsed_sha256")]
    return _per_row(with_loops(picked(docs)), LEAST_WORDS, made, fields)
