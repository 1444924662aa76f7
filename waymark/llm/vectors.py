"""Array helpers for Arrow batches of texts: blocks, runs, numbered words and hashed n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import xxhash

from .common import ship_by_value

ship_by_value(__name__)

CHARS_PER_BLOCK = 6_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)
ROLL = np.uint64(0xD6E8FEB86659FD93)


def blocks(texts: Iterable[str | None], chars: int = CHARS_PER_BLOCK) -> Iterator[list[str | None]]:
    """Consecutive runs of whole texts that bound a block's memory."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each of many runs."""
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(len(shift))


def run_starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def run_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of values; empty runs give zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def numbered(texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """Each text's words, cut at white space, as numbers, and the distinct words."""
    number = defaultdict(count().__next__)
    rows = [np.array([number[w] for w in (text or "").split()], np.int64) for text in texts]
    return rows, list(number)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * MIX
    return values ^ (values >> np.uint64(29))


class Grams:
    """Code points of many words, each between two marks, for hashing parts of words."""

    def __init__(self, words: list[str], marks: str = "<>"):
        lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        text = "".join(f"{marks[0]}{w}{marks[1]}" for w in words)
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.lengths, self.starts = lengths, run_starts(lengths)
        self.word = np.repeat(np.arange(len(words)), lengths)
        self.place = np.arange(len(self.codes)) - np.repeat(self.starts, lengths)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Word number and hash of every n-gram, by word."""
        room = self.place + n <= self.lengths[self.word]
        at = np.flatnonzero(room)
        value = np.full(len(at), n, np.uint64)
        for j in range(n):
            value = value * np.uint64(1_000_003) + self.codes[at + j]
        return self.word[at], mixed(value)

    def affixes(self, n: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The first and the last n code points of each word with the mark, where it is long enough."""
        word, value = self.grams(n + 1)
        first = np.concatenate([[True], word[1:] != word[:-1]]) if len(word) else np.zeros(0, bool)
        last = np.concatenate([word[1:] != word[:-1], [True]]) if len(word) else np.zeros(0, bool)
        return (word[first], value[first]), (word[last], value[last])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each whole word."""
        power = np.uint64(1_000_003) ** (self.place % 64).astype(np.uint64) * (self.place // 64 + 1).astype(np.uint64)
        value = np.add.reduceat(mixed(self.codes + np.uint64(7)) * power, self.starts) if len(self.starts) else np.zeros(0, np.uint64)
        return np.arange(len(self.starts)), mixed(value)


def plain_words(text: str | None, lower: bool = False) -> list[bytes]:
    """UTF-8 runs of characters other than space, tab, line feed, vertical tab, form feed and return.

    Splitting and lower-casing bytes touches ASCII only.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashed_rows(rows: Iterable[list[bytes]]) -> list[np.ndarray]:
    """64-bit hashes of each row's words; every distinct word is hashed once."""
    known = _Hashes()
    return [np.fromiter(map(known.__getitem__, row), np.uint64, len(row)) for row in rows]


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``n`` neighbours, modulo 2**64."""
    size = max(len(values) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out = out * ROLL + values[j : j + size]
    return mixed(out)
