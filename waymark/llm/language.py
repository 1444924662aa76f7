"""Language identification with a linear-chain conditional random field over words.

Every word with a letter is a position, every learned language a state. A word's
features are its affixes, character n-grams, itself, and the lexicon it is found in;
feature weights and transitions are learned together by numpy gradient steps on the
likelihood, in batches of whole documents from a bounded sample. Forward-backward gives
each word's language by its neighbours too, so runs of another language stand out in
code-switched text. A document gets the language with the largest share.

Null texts and texts without letters (by Unicode category) are ``und`` with score 0.
Repeated rows get equal results, rows with a null id too. Without training rows every text
is ``und``; an empty table gives an empty one. A long text is tagged whole, in memory
proportional to its words; other columns can have any name.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked, ship_by_value
from .quality import remainder
from .vectors import Grams, blocks, numbered, run_starts, run_sums, spread

ship_by_value(__name__)

BUCKETS = 1 << 17
SAMPLE_ROWS = 1200
BATCH = 100
EPOCHS = 3
RATE = 0.3
LEXICON_WORDS = 2000
CHARS_PER_BLOCK = 4_000_000
WORDS_AT_ONCE = 20_000
UNKNOWN = "und"
# Letters by their Unicode category: no fractions, powers or Roman numerals.
LETTERS = regex.compile(r"\p{L}+")


def letters(chunk: str) -> str:
    """The letters of a chunk between white space, in lower case."""
    return "".join(LETTERS.findall(chunk)).lower()


def word_rows(texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """Each text's words as numbers, without chunks that have no letter, and the distinct words."""
    rows, chunks = numbered(texts)
    number: dict[str, int] = {}
    to = np.array([number.setdefault(w, len(number)) if (w := letters(c)) else -1 for c in chunks], np.int64)
    return [to[row][to[row] >= 0] if len(row) else row for row in rows], list(number)


def features(words: list[str], lexicon: dict[str, int], states: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of every word, word by word, and how many each has.

    The last ``states + 1`` numbers are the lexicon features: a state's list, or none.
    """
    grams = Grams(words)
    found = [grams.whole(), *[grams.grams(n) for n in (2, 3, 4)]]
    for n in (1, 2, 3):
        found += [(w, v ^ np.uint64(kind)) for kind, (w, v) in enumerate(grams.affixes(n), 11 * n)]
    owner = np.concatenate([w for w, _ in found] + [np.arange(len(words))])
    listed = np.array([lexicon.get(w, states) for w in words], np.int64)
    bucket = np.concatenate([v for _, v in found]) % np.uint64(BUCKETS)
    bucket = np.concatenate([bucket.astype(np.int64), BUCKETS + listed])
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def chains(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts longest first, where each starts among all positions, and how many reach each step."""
    sizes = np.array([len(r) for r in rows], np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts = run_starts(sizes)[order]
    reach = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
    return order, starts, reach


def forward_backward(
    emission: np.ndarray, starts: np.ndarray, reach: np.ndarray, move: np.ndarray, count_moves: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every position, and expected transitions if counted, of many chains side by side.

    ``emission`` holds log scores by position; chains advance together, one step at a time.
    """
    local = np.exp(emission - emission.max(axis=1, keepdims=True, initial=-1e9))
    step = np.exp(move)
    forward, backward = np.empty_like(local), np.ones_like(local)
    for t, m in enumerate(reach):
        at = starts[:m] + t
        value = local[at] if t == 0 else (forward[at - 1] @ step) * local[at]
        forward[at] = value / value.sum(axis=1, keepdims=True)
    moved = np.zeros_like(step)
    for t in range(len(reach) - 2, -1, -1):
        at = starts[: reach[t + 1]] + t
        ahead = backward[at + 1] * local[at + 1]
        value = ahead @ step.T
        backward[at] = value / value.sum(axis=1, keepdims=True)
        if count_moves:
            pair = forward[at][:, :, None] * step * ahead[:, None, :]
            moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    marginal = forward * backward
    return marginal / marginal.sum(axis=1, keepdims=True), moved


@dataclass
class Tagger:
    """Learned states, feature weights, transitions and lexicon."""

    states: list[str]
    weight: np.ndarray
    move: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, words: list[str]) -> np.ndarray:
        parts = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            flat, counts = features(words[at : at + WORDS_AT_ONCE], self.lexicon, len(self.states))
            parts.append(run_sums(self.weight[flat], counts))
        return np.concatenate(parts)

    def word_languages(self, texts: list[str | None]) -> list[np.ndarray]:
        """Probabilities of each state for each word of each text."""
        rows, words = word_rows(texts)
        if not words or not self.states:
            return [np.zeros((len(r), len(self.states))) for r in rows]
        _, starts, reach = chains(rows)
        marginal, _ = forward_backward(self.emissions(words)[np.concatenate(rows)], starts, reach, self.move)
        return np.split(marginal, np.cumsum([len(r) for r in rows])[:-1])

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for marginal in self.word_languages(texts):
            if not marginal.size:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            share = marginal.mean(axis=0)
            best = int(share.argmax())
            names.append(self.states[best])
            scores.append(float(min(max(share[best], 0.0), 1.0)))
        return names, scores


def lexicon_of(texts: list[str], labels: np.ndarray, states: int) -> dict[str, int]:
    """Frequent words that one language has at least nine times in ten."""
    totals: Counter = Counter()
    own = [Counter() for _ in range(states)]
    for text, label in zip(texts, labels, strict=True):
        found = Counter(filter(None, map(letters, text.split())))
        totals.update(found)
        own[label].update(found)
    return {
        w: k
        for k in range(states)
        for w, n in sorted(own[k].items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]
        if n >= 3 and 10 * n >= 9 * totals[w]
    }


def train(texts: list[str], langs: list[str], seed: int = 1) -> Tagger:
    """Adaptive gradient steps on the chains' log likelihood; every word carries its text's label."""
    states = sorted(set(langs))
    k = len(states)
    labels = np.array([states.index(x) for x in langs], np.int64)
    lexicon = lexicon_of(texts, labels, k)
    tagger = Tagger(states, np.zeros((BUCKETS + k + 1, k)), np.zeros((k, k)), lexicon)
    seen_weight, seen_move = np.full_like(tagger.weight, 1e-6), np.full_like(tagger.move, 1e-6)
    draw = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        turn = draw.permutation(len(texts))
        for at in range(0, len(turn), BATCH):
            batch = turn[at : at + BATCH]
            rows, words = word_rows([texts[i] for i in batch])
            if not words:
                continue
            flat, counts = features(words, lexicon, k)
            sequence = np.concatenate(rows)
            _, starts, reach = chains(rows)
            emission = run_sums(tagger.weight[flat], counts)[sequence]
            marginal, moved = forward_backward(emission, starts, reach, tagger.move, count_moves=True)
            sizes = np.array([len(r) for r in rows])
            gap = -marginal
            gap[np.arange(len(sequence)), np.repeat(labels[batch], sizes)] += 1
            own = np.stack([np.bincount(sequence, gap[:, s], len(words)) for s in range(k)], axis=1)
            slope = np.stack(
                [np.bincount(flat, np.repeat(own[:, s], counts), len(tagger.weight)) for s in range(k)], axis=1
            ) / len(sequence)
            seen_weight += slope**2
            tagger.weight += RATE * slope / np.sqrt(seen_weight)
            stay = np.bincount(labels[batch], np.maximum(sizes - 1, 0), k)
            change = (np.diag(stay) - moved) / len(sequence)
            seen_move += change**2
            tagger.move += RATE * change / np.sqrt(seen_move)
    tagger.weight = tagger.weight.astype(np.float32)
    return tagger


def training_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` rows with a language outside the held-out fold, chosen by a hash of their id."""
    named = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    fold = named.where(remainder(F.col("doc_id"), 3) != 1)
    chosen = (
        fold.select("doc_id", F.xxhash64("doc_id").alias("turn")).distinct().orderBy("turn", "doc_id").limit(rows)
    )
    return fold.select("doc_id", "text", "lang").join(F.broadcast(chosen.select("doc_id")), "doc_id")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Tagger:
    """Learn from the bounded sample; its texts come to the driver, nothing else does."""
    sample = sorted((r.doc_id, r.text, r.lang) for r in training_rows(docs, rows).collect())
    return train([x[1] for x in sample], [x[2] for x in sample])


def identified(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def run(batches):
        for batch in batches:
            done = 0
            for block in blocks(batch.column("text").to_pylist(), CHARS_PER_BLOCK):
                names, scores = tagger.documents(block)
                columns = [batch.column("doc_id").slice(done, len(block)), names, pa.array(scores, pa.float64())]
                done += len(block)
                yield pa.record_batch(columns, ["doc_id", "lang_pred", "score"])

    rows = picked(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return identified(docs, fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
