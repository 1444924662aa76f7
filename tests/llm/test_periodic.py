"""Periodic runs against brute force in plain Python."""

import hashlib
import random
import zlib

import pytest

from waymark.llm import periodic


def brute_runs(words, least=12):
    n, found = len(words), {}
    for d in range(1, n // 2 + 1):
        i = 0
        while i < n - d:
            start = i
            while i < n - d and words[i] == words[i + d]:
                i += 1
            if i - start + d >= max(least, 2 * d):
                found.setdefault((start, i - start + d), d)
            i = max(i, start + 1)
    return sorted((start, length, d) for (start, length), d in found.items())


def split(text):
    return (text or "").encode().split()


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_digest(docs):
    out = []
    for doc_id, text in docs:
        words = looped(doc_id, split(text))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        sums = [hashlib.sha256(x).hexdigest() for x in (listed, collapsed(words, runs))]
        out.append((doc_id, len(runs), *longest, *sums))
    return out


def random_words(draw):
    n, kinds = draw.choice([0, 1, 11, 12, 13, 30, 90]), draw.choice([1, 2, 2, 3, 6])
    words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
    if n and draw.random() < 0.5:
        a = draw.randrange(n)
        p = 1 + draw.randrange(max(1, (n - a) // 2))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_random_words(least):
    draw = random.Random(least)
    rows = [[w.encode() for w in random_words(draw)] for _ in range(300)]
    for words, runs in zip(rows, periodic.block_runs(rows, least), strict=True):
        assert list(map(tuple, runs.tolist())) == brute_runs(words, least)


def test_digest_against_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(periodic, "CHARS_PER_BLOCK", 2000)
    draw = random.Random(3)
    docs = [(draw.randrange(-500, 500), draw.choice([" ", " \n", "\t\x0b"]).join(random_words(draw))) for _ in range(400)]
    docs += [(i, " ".join(f"u{i}_{k}" for k in range(draw.randrange(60)))) for i in range(300)]
    docs += [(1, None), (2, ""), (3, " \n"), (None, "a " * 40), (None, None), docs[0], docs[0], (4, "x\xa0x " * 30)]
    looped_ids = [i for i in range(2000, 4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs += [(looped_ids[0], None), (looped_ids[1], "\t"), (looped_ids[2], "one"), (looped_ids[3], " ".join(map(str, range(500))))]
    assert in_order(periodic.digest(documents(docs)).collect()) == in_order(brute_digest(docs))
    assert periodic.digest(documents([])).count() == 0


def test_runs_and_collapsed_text(spark, documents):
    df = documents([(1, "a " + "b c " * 6 + "d"), (2, None)]).selectExpr("doc_id AS id", "text AS body", "'x' AS doc_id", "1 AS runs")
    got = {r.doc_id: r for r in periodic.periodic_runs(df, 12, "id", "body").collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 12, 2)] and got[1].collapsed == "a b c d"
    assert got[2].runs == [] and got[2].collapsed == ""


@pytest.mark.parametrize("words", [["a"] * 200_000, ["a", "b"] * 50_000 + ["c"], [f"{i}" for i in range(1000)] * 100])
def test_one_long_text(words):
    runs = periodic.block_runs([[w.encode() for w in words]])[0]
    q = len(set(words)) - ("c" in words)
    assert runs.tolist() == [[0, len(words) - ("c" in words), q]]
