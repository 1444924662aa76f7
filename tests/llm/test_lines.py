"""Line dedup against brute force in plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest
from conftest_llm import ASCII

from waymark.llm import lines

BLANKS = " \t\n\x0b\f\r"


def brute_lines(docs, least_chars=20, least_documents=3):
    key = lambda line: line.strip(BLANKS).translate(ASCII)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        own = (text or "").split("\n")
        gone = [doc_id is not None and len(holders.get(key(x), ())) >= least_documents and doc_id != max(holders[key(x)]) for x in own]
        out.append((doc_id, len(own), sum(gone), "\n".join(x for x, g in zip(own, gone, strict=True) if not g)))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sample_docs():
    draw = random.Random(13)
    shared = [f"  Shared line number {i} of the corpus\t" for i in range(6)] + ["short one", "ünïcödé līne wïth 2é chärs"]
    docs = []
    for i in range(120):
        own = [f"own line {i} {k} with some more words" for k in range(draw.randint(0, 4))]
        own += [draw.choice([x, x.upper(), x.strip(), x + "\r"]) for x in draw.choices(shared, k=draw.randint(0, 5))]
        draw.shuffle(own)
        docs.append((draw.randint(-50, 50), "\n".join(own)))
    two = "only two documents have this line"
    docs += [(200, f"{two}\n{two}\n{two}"), (201, two), (202, "\n"), (203, ""), (204, None), (None, shared[0]), (None, None)]
    docs += [(205, "x" * 20 + "\n" + "y" * 19), (206, "X" * 20), (207, "x" * 20 + "\n\n"), (208, "y" * 19), (209, "y" * 19)]
    docs += [docs[0], docs[0], (5, None), (5, docs[3][1])]
    return docs


@pytest.mark.parametrize("most", [lines.MOST_BROADCAST_ROWS, 2])
def test_lines_against_brute_force(spark, documents, monkeypatch, most):
    monkeypatch.setattr(lines.lines_of, "__defaults__", (most,))
    monkeypatch.setattr(lines, "MOST_BROADCAST_BYTES", most)
    docs = sample_docs()
    got = lines.deduplicated(spark, documents(docs)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    expected = [(d, n, k, None if t is None else x) for (d, n, k, x), (_, t) in zip(brute_lines(docs), docs, strict=True)]
    assert in_order(got) == in_order(expected)
    digests = lines.digest(spark, documents(docs)).collect()
    assert in_order(digests) == in_order((d, n, k, hashlib.sha256(x.encode()).hexdigest()) for d, n, k, x in brute_lines(docs))


def test_lines_with_other_bounds_and_columns(spark, documents):
    docs = [(1, "ab\ncd"), (2, "AB\nef"), (3, "ab "), (4, None)]
    df = documents([(d, t) for d, t in docs]).selectExpr("doc_id AS id", "text AS body", "'x' AS doc_id", "'y' AS text", "'z' AS place")
    got = lines.deduplicated(spark, df, 2, 2, "id", "body")
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    assert {r.id: (r.body, r.n_dropped) for r in got.collect()} == {1: ("cd", 1), 2: ("ef", 1), 3: ("ab ", 0), 4: (None, 0)}
    assert lines.digest(spark, documents([])).count() == 0


def test_one_long_text(spark, documents):
    """Every other line of 60,000 goes; marking them takes time in proportion."""
    text = "\n".join("a line that three documents have" if i % 2 else f"{i}" for i in range(60_000))
    common = "a line that three documents have"
    got = {r.doc_id: r for r in lines.deduplicated(spark, documents([(1, text), (2, common), (3, common)])).collect()}
    assert (got[1].n_lines, got[1].n_dropped) == (60_000, 30_000)
    assert got[1].text == "\n".join(str(i) for i in range(0, 60_000, 2))
    assert (got[2].text, got[3].text) == ("", common)


def test_lines_run_no_python(spark, documents):
    plan = lines.deduplicated(spark, documents([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
