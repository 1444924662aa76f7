"""Alignment of two tokenizers' ids over a corpus, with a fast path for ids of the same bytes.

Each text is encoded by A (byte-level BPE) and by B (pieces with byte fallback). Byte
offsets where a token of both ends cut the tokens into groups, and an A and a B token of
one group are linked. A pair of ids counts in how many documents it is linked.

No token of either spans the space between two words, so both end there and groups are
made of single words: a task aligns each distinct word once, many of them joined to one
text, and puts every document together from its words. It keeps words up to a bound and
starts anew beyond. Where a word fails by itself, or the vocabularies don't keep to words,
the whole text is aligned.

An array made beforehand gives for each A id the B id of the same bytes. Groups of one
such pair need no shuffle: a task counts them in vectors as long as A's vocabulary, and
only those are added up. Pairs of other groups are counted by a shuffle, one row for each
distinct pair of a document, with partial counts in each task. (A pair of the same bytes
inside a larger group goes to the vector as well, so each pair is counted in one place.)

Scoring the documents needs counts again. Vectors of A's length are sent to every task, and
so are the heaviest pairs: those that have one ``MOST_HEAVY``-th of all rows at least,
which ``MOST_HEAVY`` pairs at most can have. Only a document's lighter pairs are joined in
a shuffle, where no key has many rows.

Tokenizers' own strings for special tokens are plain text. Null and empty texts, and texts
whose tokens' bytes aren't the text with a space before it, have no tokens: zeros and an
empty list of groups. Rows that share an id are documents of their own; an empty table
gives an empty one; other columns can have any name. A text of any length is encoded
whole; its groups' pairs are made from distinct ids, so a long stretch without a common
offset needs no more than its distinct ids squared.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import kept_table, picked, ship_by_value
from .vectors import blocks, run_starts, spread

ship_by_value(__name__)

CHARS_PER_BLOCK = 500_000
LONG_TEXT = 200_000
MOST_HEAVY = 500_000
# What a task keeps of the words that it has aligned, and how many characters of new ones it aligns at a time.
MOST_WORDS, MOST_CHARS, MOST_PAIRS = 200_000, 10_000_000, 2_000_000
CHARS_PER_RUN = 50_000
# Groups with more pairs than this are counted by their distinct ids.
LARGE_GROUP = 4096
# Fixed value: how byte-level vocabularies of this kind cut a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
SPACE_INSIDE = re.compile("[^▁]▁")
# A space behind another character than white space, with more than white space to come.
BETWEEN_WORDS = re.compile(r" (?<=\S )(?=\s*\S)")


class ByteLevel:
    """Tokenizer A from its file's text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        loaded = json.loads(spec)
        vocab = loaded["model"]["vocab"]
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t["content"] for t in loaded["added_tokens"]}
        self.size = max([*vocab.values(), *(t["id"] for t in loaded["added_tokens"])]) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in special else bytes(byte[x] for x in token)
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.ranked = self._ranked(loaded)

    def _ranked(self, spec: dict):
        """The same encoding from ranks, which is faster; None if the ids aren't ranks or the pieces differ."""
        import tiktoken

        model, cut = spec["model"], spec["pre_tokenizer"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        in_order = all(model["vocab"][token] == 256 + i for i, token in enumerate(merged))
        plain = cut["type"] == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
        if not (in_order and plain and spec["normalizer"] is None and not model.get("ignore_merges")):
            return None
        ranks = {self.bytes[i]: i for i in range(256 + len(merged))}
        if len(ranks) != 256 + len(merged) or any(len(self.bytes[i]) != 1 for i in range(256)):
            return None
        return tiktoken.Encoding("ranked", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is not None and len(text) <= LONG_TEXT:  # a long run of blanks overflows its stack
            return np.array(self.ranked.encode_ordinary(text), np.int64)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Tokenizer B from its file's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.library.get_piece_size()
        self.bytes = []
        for i in range(self.size):
            piece = self.library.id_to_piece(i)
            as_byte = BYTE_PIECE.fullmatch(piece) if self.library.is_byte(i) else None
            plain = not (self.library.is_control(i) or self.library.is_unknown(i))
            value = bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode()
            self.bytes.append(value if plain else b"")
        self.by_words = self._by_words(model)

    def _by_words(self, model: bytes) -> bool:
        """Whether no piece has a space behind another character, and texts are encoded as they are."""
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:  # without protobuf the model's settings can't be read
            return False
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        clean, of = spec.normalizer_spec, spec.trainer_spec
        as_is = not clean.precompiled_charsmap and clean.add_dummy_prefix and clean.escape_whitespaces
        plain = of.model_type == of.BPE and not of.treat_whitespace_as_suffix
        return as_is and not clean.remove_extra_whitespaces and plain and not any(SPACE_INSIDE.search(x.piece) for x in spec.pieces)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, num_threads=1), np.int64)


def same_bytes(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 without one. A piece goes before a byte's own id."""
    ids: dict[bytes, int] = {}
    for i, value in enumerate(b):
        if value and (value not in ids or len(value) == 1):
            ids[value] = i
    return np.array([ids.get(value, -1) if value else -1 for value in a], np.int64)


class Digits:
    """Decimal ids with one more character each, in one buffer."""

    def __init__(self, size: int):
        texts = [f"{i}," for i in range(size)]
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.starts = run_starts(self.lengths)
        self.bytes = np.frombuffer("".join(texts).encode(), np.uint8)

    def joined(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids as bytes, each followed by its mark, and the length of each with it."""
        lengths = self.lengths[ids]
        out = self.bytes[spread(self.starts[ids], lengths)]
        out[np.cumsum(lengths) - 1] = marks
        return out, lengths


class Aligner:
    """Both tokenizers with the tables that alignment needs."""

    def __init__(self, spec_a: str, model_b: bytes):
        self.a, self.b = ByteLevel(spec_a), Pieces(model_b)
        self.sizes_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.sizes_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.texts_a, self.texts_b = (np.array(x, dtype=object) for x in (self.a.bytes, self.b.bytes))
        self.same = same_bytes(self.a.bytes, self.b.bytes)
        self.digits = Digits(max(self.a.size, self.b.size))
        # A's ranks come with PIECES, where a space stands only before a word or among white space.
        self.by_words = self.a.ranked is not None and self.b.by_words
        self._forget()

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none if the bytes of either aren't the text with a space before it."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = b" " + text.encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for ids, sizes, values in ((a, self.sizes_a, self.texts_a), (b, self.sizes_b, self.texts_b)):
            if sizes[ids].sum() != len(data) or b"".join(values[ids].tolist()) != data:
                return none
        return a, b

    def aligned(self, texts: list[str | None]) -> tuple:
        """Counts (a row each of n_a, n_b, n_groups, n_links), groups as texts, and distinct pairs: row, pair, links."""
        if len(self.number) > MOST_WORDS or self.chars > MOST_CHARS or len(self.codes) > MOST_PAIRS:
            self._forget()
        rows = [self._numbers(self._parts(text)) for text in texts]
        self._learn()
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        # A part that failed by itself: its whole text decides.
        for i in np.unique(owner[~self.known[np.concatenate(rows)]]).tolist():
            rows[i] = self._numbers([(texts[i],)])
        self._learn()
        lengths = np.array([len(x) for x in rows], np.int64)
        words = np.concatenate(rows)
        before = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(self.counts[:, words], axis=1)], axis=1)
        ends = np.cumsum(lengths)
        counts = before[:, ends] - before[:, ends - lengths]
        sizes = self.sizes[words]
        text = self.text[spread(run_starts(self.sizes)[words], sizes)].tobytes()
        after = np.concatenate([[0], np.cumsum(sizes)])[[ends - lengths, ends]].T.tolist()
        groups = [text[x : max(x, y - 1)] for x, y in after]
        n_pairs = self.n_pairs[words]
        at = spread(run_starts(self.n_pairs)[words], n_pairs)
        row, pairs, links = _distinct(np.repeat(np.repeat(np.arange(len(rows)), lengths), n_pairs), self.codes[at], self.times[at])
        return counts, groups, row, pairs, links

    def _parts(self, text: str | None) -> list[str | tuple[str]]:
        """Words where no token of either can span the space between two. What is aligned by itself is a tuple."""
        if not text:
            return []
        if not self.by_words:
            return [(text,)]
        parts = BETWEEN_WORDS.split(text)
        if text[-1].isspace():  # cut in view of what follows
            parts[-1] = (parts[-1],)
        return parts

    def _numbers(self, parts: list[str | tuple[str]]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))

    def _forget(self) -> None:
        """Start with no words."""
        self.number: dict[str | tuple[str], int] = defaultdict(count().__next__)
        self.chars = 0
        self.known = np.zeros(0, bool)
        self.counts = np.zeros((4, 0), np.int64)
        self.text = np.zeros(0, np.uint8)
        self.sizes, self.n_pairs, self.codes, self.times = (np.zeros(0, np.int64) for _ in range(4))

    def _learn(self) -> None:
        """Align the parts that have a number only, many words at a time as one text."""
        new = list(islice(self.number, len(self.known), None))
        if not new:
            return
        alone = np.array([isinstance(x, tuple) for x in new])
        words = [x[0] if isinstance(x, tuple) else x for x in new]
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        self.chars += int(after[-1])
        run = after // CHARS_PER_RUN
        cuts = np.flatnonzero((run[1:] != run[:-1]) | alone[1:] | alone[:-1]) + 1
        found = []
        for first, end in pairwise([0, *cuts.tolist(), len(words)]):
            self._add(words[first:end], found)
        counts, *lists = zip(*found, strict=True)
        self.counts = np.concatenate([self.counts, *counts], axis=1)
        names = ("sizes", "text", "n_pairs", "codes", "times")
        for name, arrays in zip(names, lists, strict=True):
            setattr(self, name, np.concatenate([getattr(self, name), *arrays]))
        self.known = self.sizes > 0

    def _add(self, words: list[str], found: list[tuple]) -> None:
        """What ``_entries`` gives for words, in halves where a run fails; nothing for a word that fails by itself."""
        entries = self._entries(words)
        if entries is not None:
            found.append(entries)
        elif len(words) > 1:
            half = len(words) // 2
            self._add(words[:half], found)
            self._add(words[half:], found)
        else:
            none, zero = np.zeros(0, np.int64), np.zeros(1, np.int64)
            found.append((np.zeros((4, 1), np.int64), zero, none.astype(np.uint8), zero, none, none))

    def _entries(self, words: list[str]) -> tuple | None:
        """Counts, size of the groups' text, the text (a mark behind each group), number of pairs, pairs and links.

        None if the words joined by spaces have no tokens, or a word's end isn't a common offset.
        """
        a, b = self.tokens(" ".join(words))
        if not len(a):
            return None
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        # Both grow, so what they share needs no sorting; tokens without bytes stay in the group before them.
        common = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(b) - 1)] == ends_a]
        common = common[np.diff(common, prepend=0) > 0]
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)) + 1)
        last = np.searchsorted(common, ends)
        if (common[last] != ends).any():
            return None
        cut_a = np.searchsorted(ends_a, common, side="right")
        cut_b = np.searchsorted(ends_b, common, side="right")
        n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        start_a, start_b = cut_a - n_a, cut_b - n_b
        # A's tokens of a group, then B's: each goes behind the tokens of the groups before.
        order = np.empty(len(a) + len(b), np.int64)
        marks = np.full(len(order), ord(","), np.uint8)
        begin = run_starts(n_a + n_b)
        order[spread(begin, n_a)] = a
        order[spread(begin + n_a, n_b)] = b
        marks[begin + n_a - 1] = ord("|")
        marks[begin + n_a + n_b - 1] = ord(";")
        text, lengths = self.digits.joined(order, marks)
        sizes = np.diff(np.cumsum(lengths)[(cut_a + cut_b)[last] - 1], prepend=0)
        links = n_a * n_b
        sums = np.stack([cut_a, cut_b, np.arange(1, len(common) + 1), np.cumsum(links)])[:, last]
        owner = np.repeat(np.arange(len(words)), np.diff(last, prepend=-1))
        owner, codes, times = self._links(a, b, n_a, n_b, start_a, start_b, links, owner)
        return np.diff(sums, axis=1, prepend=0), sizes, text, np.bincount(owner, minlength=len(words)), codes, times

    def _links(self, a, b, n_a, n_b, start_a, start_b, links, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs of each word as a * (size of B) + b, and how many token pairs each stands for."""
        codes = np.int64(self.b.size)
        one = links == 1
        single = a[start_a[one]] * codes + b[start_b[one]]
        some = np.flatnonzero(~one & (links <= LARGE_GROUP))
        group = np.repeat(some, n_a[some])
        token = a[spread(start_a[some], n_a[some])]
        many = np.repeat(token, n_b[group]) * codes + b[spread(start_b[group], n_b[group])]
        pairs = np.concatenate([single, many])
        found = [(np.concatenate([owner[one], np.repeat(owner[some], links[some])]), pairs, np.ones(len(pairs), np.int64))]
        for g in np.flatnonzero(links > LARGE_GROUP).tolist():
            x, x_times = np.unique(a[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
            y, y_times = np.unique(b[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
            pairs = (x[:, None] * codes + y).reshape(-1)
            found.append((np.full(len(pairs), owner[g]), pairs, (x_times[:, None] * y_times).reshape(-1)))
        return _distinct(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _distinct(owner: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner's distinct pairs in order, with their times added up."""
    keys = (owner << 31) + pairs
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    total = np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)
    keys = keys[first]
    return keys >> 31, keys & (2**31 - 1), total


COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]
LISTS = ["same", "same_links", "pairs", "pair_links"]


def read_bytes(path: str) -> bytes:
    """A tokenizer's file, read where this runs and sent along inside the plan."""
    with open(path, "rb") as file:
        return file.read()


def encoded(docs: DataFrame, spec_a: str, model_b: bytes, with_groups: bool = False) -> DataFrame:
    """doc_id, counts, groups (their hash, or with ``with_groups`` their text) and linked pairs of every row."""
    packed = base64.b64encode(model_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(spec_a, base64.b64decode(packed))
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_BLOCK):
                counts, texts, row, pairs, links = aligner.aligned(block)
                own = batch.slice(done, len(block))
                done += len(block)
                groups = [x.decode() if with_groups else hashlib.sha256(x).hexdigest() if x else "" for x in texts]
                columns = [own.column("doc_id"), own.column("row"), *map(pa.array, counts), pa.array(groups, pa.string())]
                left = pairs // aligner.b.size
                even = aligner.same[left] == pairs % aligner.b.size
                for kind, ids in ((even, left), (~even, pairs)):
                    offsets = np.concatenate([[0], np.cumsum(np.bincount(row[kind], minlength=len(block)))]).astype(np.int32)
                    columns += [pa.ListArray.from_arrays(offsets, x[kind].astype(np.int32)) for x in (ids, links)]
                yield pa.record_batch(columns, ["doc_id", "row", *COLUMNS, "groups", *LISTS])

    rows = docs.withColumn("row", F.monotonically_increasing_id())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = [f"doc_id {kind}", "row bigint", *[f"{c} bigint" for c in COLUMNS], "groups string"]
    return rows.mapInArrow(run, ", ".join([*schema, *[f"{c} array<int>" for c in LISTS]]))


def vector_counts(rows: DataFrame, size: int) -> DataFrame:
    """a and n: in how many documents each A id is linked with the B id of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, np.int64)
        for batch in batches:
            vector += np.bincount(batch.column("same").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(vector)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(vector[at])], ["a", "n"])

    counted = rows.select("same").mapInArrow(run, "a int, n bigint")
    return counted.groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair and n: in how many documents each other pair is linked."""
    return rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def scored(rows: DataFrame, vector: np.ndarray, best: np.ndarray, heavy: tuple[np.ndarray, np.ndarray], size_b: int) -> DataFrame:
    """row, n_best and count_sum by the vector and the heavy pairs, and the pairs left over."""
    codes, counts = heavy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            flat = {c: batch.column(c).flatten().to_numpy().astype(np.int64) for c in LISTS}
            lists = {c: np.repeat(np.arange(n), batch.column(c).value_lengths().to_numpy()) for c in ("same", "pairs")}
            count = vector[flat["same"]]
            most = flat["same_links"] * (count == best[flat["same"]])
            n_best = np.bincount(lists["same"], most, n)
            total = _row_sums(lists["same"], flat["same_links"] * count, n)
            if len(codes):
                at = np.minimum(np.searchsorted(codes, flat["pairs"]), len(codes) - 1)
                known = codes[at] == flat["pairs"]
                count = np.where(known, counts[at], 0)
            else:
                known = np.zeros(len(flat["pairs"]), bool)
                count = np.zeros(len(flat["pairs"]), np.int64)
            most = flat["pair_links"] * (known & (count == best[flat["pairs"] // size_b]))
            n_best += np.bincount(lists["pairs"], most, n)
            total += _row_sums(lists["pairs"], flat["pair_links"] * count, n)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(lists["pairs"][~known], minlength=n))]).astype(np.int32)
            left = [pa.ListArray.from_arrays(offsets, flat[c][~known].astype(np.int32)) for c in ("pairs", "pair_links")]
            names = ["doc_id", "row", *COLUMNS, "groups"]
            columns = [*[batch.column(c) for c in names], pa.array(n_best.astype(np.int64)), pa.array(total), *left]
            yield pa.record_batch(columns, [*names, "n_best", "count_sum", "pairs", "pair_links"])

    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in LISTS]
    schema = [*kept, "n_best bigint", "count_sum bigint", "pairs array<int>", "pair_links array<int>"]
    return rows.mapInArrow(run, ", ".join(schema))


def _row_sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of each row's values; rows come in order."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.searchsorted(owner, np.arange(n), side="right")
    return total[ends] - total[np.searchsorted(owner, np.arange(n))]


def _columns(rows: DataFrame, *names: str) -> list[np.ndarray]:
    """A table of bounded size on the driver."""
    found = rows.select(*names).toArrow()
    return [found.column(c).to_numpy().astype(np.int64) for c in names]


def alignment(
    spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text",
    most_heavy: int = MOST_HEAVY, with_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, counts, groups, n_best, count_sum) and id pairs (a, b, n, whether n is a's highest)."""
    spec_a, model_b = read_bytes(path_a).decode(), read_bytes(path_b)
    aligner = Aligner(spec_a, model_b)
    size_a, size_b = aligner.a.size, aligner.b.size
    if size_a * size_b > 2**31:
        raise ValueError("pairs of ids of these vocabularies don't fit into 31 bits")
    rows = kept_table(spark, encoded(picked(docs, doc_id, text), spec_a, model_b, with_groups), "aligned")
    same = kept_table(spark, vector_counts(rows, size_a), "same-bytes")
    pairs = kept_table(spark, pair_counts(rows), "pairs")
    # One number for each A id: the count of its own bytes' pair, and the highest of all its pairs.
    vector, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    a, n = _columns(same, "a", "n")
    vector[a] = best[a] = n
    highest = pairs.groupBy(F.floor(F.col("pair") / size_b).cast("int").alias("a")).agg(F.max("n").alias("n"))
    a, n = _columns(highest, "a", "n")
    best[a] = np.maximum(best[a], n)
    linked = pairs.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * most_heavy >= linked
    codes, n = _columns(pairs.where(is_heavy), "pair", "n")
    order = np.argsort(codes)
    marked = kept_table(spark, scored(rows, vector, best, (codes[order], n[order]), size_b), "scored")
    tops = spark.createDataFrame(pa.table({"top_a": np.arange(size_a, dtype=np.int32), "top": best}))
    named = pairs.withColumn("a", F.floor(F.col("pair") / size_b).cast("int"))
    named = named.join(F.broadcast(tops), F.col("a") == F.col("top_a")).withColumn("is_best", F.col("n") == F.col("top"))
    light = named.where(~is_heavy).select(F.col("pair").alias("__pair"), "n", "is_best")
    rest = marked.select("row", F.explode(F.arrays_zip("pairs", "pair_links")).alias("x")).select("row", "x.*")
    met = rest.join(light, F.col("pairs") == F.col("__pair"))
    extra = met.groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.when(F.col("is_best"), F.col("pair_links")).otherwise(0)).cast("bigint").alias("__best"),
        F.sum(F.col("pair_links") * F.col("n")).alias("__sum"),
    )
    joined = marked.join(extra, F.col("row") == F.col("__row"), "left")
    documents = joined.select(
        "doc_id", *COLUMNS, "groups",
        (F.col("n_best") + F.coalesce("__best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("__sum", F.lit(0))).alias("count_sum"),
    )
    even = spark.createDataFrame(pa.table({"same_a": np.arange(size_a, dtype=np.int32), "b": aligner.same.astype(np.int32), "top": best}))
    own = same.join(F.broadcast(even), F.col("a") == F.col("same_a")).select("a", "b", "n", (F.col("n") == F.col("top")).alias("is_best"))
    others = named.select("a", (F.col("pair") - F.col("a") * size_b).alias("b"), "n", "is_best")
    return documents, own.unionByName(others)


def digest(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The columns of the registered query."""
    documents, _ = alignment(spark, docs, path_a, path_b)
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *COLUMNS, "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
