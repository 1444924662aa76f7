"""Byte-pair encoding and decoding with a pair occurrence index.

Each Arrow batch is cut at white space, and its distinct words become one array of
symbols. An index maps every pair that has a rank to all its positions; ranks are taken
in ascending order, each merge is applied at all its positions at once, and the pairs
next to a merge are entered under their own ranks. Every word's ids are then looked up.

Null and empty texts encode to no tokens. Repeated rows encode alike, whatever their ids; an
empty table gives an empty one. A long text is encoded whole, in memory proportional to
its length; other columns can have any name. The tokenizer's
strings for special tokens become their ids wherever they stand in a text, as the
tokenizers library does. A vocabulary whose merges share a result isn't supported,
since ascending order would not be the per-word order then; loading one raises ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import picked, ship_by_value
from .vectors import blocks, run_starts, spread

ship_by_value(__name__)

# What a task holds at a time: characters that are encoded together, tokens of one record batch.
CHARS_PER_ENCODED_BLOCK = 1_000_000
TOKENS_PER_BATCH = 200_000

# The white space of the Unicode property of that name.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_SPLIT = re.compile(f"[{WHITE}]+")
# str.split() also cuts at these four, which are not white space by that property.
SEPARATOR_CONTROLS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = count(256)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Tokenizer:
    """Tables of one tokenizer file: symbols of bytes, ranks of pairs, and the text of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = np.full(self.size, "", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + suffix] for x in letters], dtype=np.int64)
        self.left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.result = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        if len(np.unique(self.result)) < len(merges):
            raise ValueError("two merges of this vocabulary have the same result")
        pairs = self.left * self.size + self.right
        self.rank_of_pair = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.rank_of_pair]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary has no such merge."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.rank_of_pair[at], -1)

    def parts(self, chunk: str) -> list[str | int]:
        """The words of a text without white space; special tokens as ids."""
        if "<" in chunk:
            out: list[str | int] = []
            for piece in self.cut(chunk):
                out += [self.special[piece]] if piece in self.special else self._words(piece)
            return out
        return self._words(chunk)

    def _words(self, chunk: str) -> list[str]:
        # Lower-casing is by character, without the rule for a final sigma.
        return self.pieces(unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3").lower())


class PairIndex:
    """Symbols of many words in one array, with every mergeable pair's positions by rank."""

    def __init__(self, words: list[str], tokenizer: Tokenizer):
        self.t = tokenizer
        encoded = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        data = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum(lengths)
        self.starts = ends - lengths
        self.symbol = tokenizer.inner[data]
        self.symbol[ends - 1] = tokenizer.last[data[ends - 1]]
        n = len(data)
        self.next = np.arange(1, n + 1)
        self.next[ends - 1] = -1
        self.before = np.arange(-1, n - 1)
        self.before[self.starts] = -1
        self.at: dict[int, list[np.ndarray]] = defaultdict(list)
        self.active: list[int] = []
        self._enter(np.flatnonzero(self.next >= 0))

    def _enter(self, positions: np.ndarray) -> None:
        """Add the pairs that start at these positions under their ranks."""
        ranks = self.t.ranks(self.symbol[positions], self.symbol[self.next[positions]])
        known = ranks >= 0
        positions, ranks = positions[known], ranks[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, group in zip(ranks[[0, *cuts]].tolist(), np.split(positions, cuts), strict=True):
            if rank not in self.at:
                heapq.heappush(self.active, rank)
            self.at[rank].append(group)

    def _apply(self, rank: int) -> None:
        left, right = self.t.left[rank], self.t.right[rank]
        at = np.unique(np.concatenate(self.at.pop(rank)))
        follow = self.next[at]
        real = (self.symbol[at] == left) & (follow >= 0) & (self.symbol[follow] == right)
        at, follow = at[real], follow[real]
        if left == right and len(at) > 1:
            keep, taken = [], -1
            for i, (p, q) in enumerate(zip(at.tolist(), follow.tolist(), strict=True)):
                if p != taken:
                    keep.append(i)
                    taken = q
            at, follow = at[keep], follow[keep]
        if not len(at):
            return
        beyond = self.next[follow]
        self.symbol[at] = self.t.result[rank]
        self.symbol[follow] = -1
        self.next[at] = beyond
        self.before[beyond[beyond >= 0]] = at[beyond >= 0]
        before = self.before[at]
        changed = np.unique(np.concatenate([before[before >= 0], at[beyond >= 0]]))
        self._enter(changed)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids in word order, and how many each word has."""
        while self.active:
            self._apply(heapq.heappop(self.active))
        left = self.symbol >= 0
        counts = np.add.reduceat(left, self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)
        return self.symbol[left], counts


def encode_texts(texts: list[str | None], tokenizer: Tokenizer) -> Iterator[np.ndarray]:
    """The ids of each text."""
    number = defaultdict(count().__next__)
    rows = []
    for text in texts:
        text = text or ""
        chunks = SPACE_SPLIT.split(text) if SEPARATOR_CONTROLS.search(text) else text.split()
        rows.append(np.fromiter((number[c] for c in chunks if c), np.int64))
    words = defaultdict(count().__next__)
    parts = [[p if isinstance(p, int) else ~words[p] for p in tokenizer.parts(c)] for c in number]
    ids, counts = PairIndex(list(words), tokenizer).merged()
    # Special tokens stand behind the words as words of one id.
    ids = np.concatenate([ids, np.arange(tokenizer.size)])
    counts = np.concatenate([counts, np.ones(tokenizer.size, np.int64)])
    starts = run_starts(counts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.fromiter((x for p in parts for x in p), np.int64, int(sizes.sum()))
    flat = np.where(flat < 0, ~flat, flat + len(words))
    first = run_starts(sizes)
    for row in rows:
        own = flat[spread(first[row], sizes[row])]
        yield ids[spread(starts[own], counts[own])]


def decode_ids(ids: np.ndarray, tokenizer: Tokenizer) -> str:
    """Token texts joined by spaces: these vocabularies name no decoder."""
    return " ".join(tokenizer.text[ids])


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row."""
    return _encoded(docs, path, doc_id, text, False).select("doc_id", "ids")


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens and the text decoded from the ids, in one pass: equal to ``decode`` of ``encode``."""
    return _encoded(docs, path, doc_id, text, True)


def _encoded(docs: DataFrame, path: str, doc_id: str, text: str, with_text: bool) -> DataFrame:
    """Rows leave in record batches of some ``TOKENS_PER_BATCH``, so a task holds one block and one batch."""

    def run(batches):
        tokenizer = Tokenizer(path)
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_ENCODED_BLOCK):
                for ids in token_batches(encode_texts(block, tokenizer)):
                    own = batch.column("doc_id").slice(done, len(ids))
                    done += len(ids)
                    counts = np.array([len(x) for x in ids], np.int64)
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    columns = [own, pa.ListArray.from_arrays(offsets, np.concatenate(ids)), pa.array(counts)]
                    names = ["doc_id", "ids", "n_tokens"]
                    if with_text:
                        columns.append(pa.array([decode_ids(x, tokenizer) for x in ids], pa.string()))
                        names.append("decoded")
                    yield pa.record_batch(columns, names)

    rows = picked(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_tokens bigint"
    return rows.mapInArrow(run, f"{schema}, decoded string" if with_text else schema)


def token_batches(rows: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Consecutive rows of ids, as many as have ``TOKENS_PER_BATCH`` tokens, and one at least."""
    held, size = [], 0
    for ids in rows:
        held.append(ids.astype(np.int32))
        size += len(ids)
        if size >= TOKENS_PER_BATCH:
            yield held
            held, size = [], 0
    if held:
        yield held


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of each row's ids; null ids give an empty text."""

    def run(batches):
        tokenizer = Tokenizer(path)
        for batch in batches:
            column = batch.column(ids)
            counts = column.value_lengths().fill_null(0).to_numpy()
            flat = column.flatten().to_numpy()
            starts = run_starts(counts)
            # Rows are cut where the tokens before them pass a bound.
            part = starts // TOKENS_PER_BATCH
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(counts)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                texts = [decode_ids(flat[i : i + n], tokenizer) for i, n in zip(starts[a:b], counts[a:b], strict=True)]
                rows = batch.slice(a, b - a)
                yield pa.record_batch([*rows.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, `{out}` string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        tokenizer = Tokenizer(path)
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist()):
                counts, ids_sha, text_sha = [], [], []
                for ids in encode_texts(block, tokenizer):
                    counts.append(len(ids))
                    ids_sha.append(sha(ids.astype("<u4").tobytes()))
                    text_sha.append(sha(decode_ids(ids, tokenizer).encode()))
                columns = [batch.column("doc_id").slice(done, len(block)), pa.array(counts, pa.int64()), ids_sha, text_sha]
                yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                done += len(block)

    rows = picked(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
