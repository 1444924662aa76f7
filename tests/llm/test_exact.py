"""Operators with one right answer, against brute force in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import ASCII, words_of

import __spark_entry__ as contract
from waymark.llm import decontaminate, near, search, sharding, substrings, webtext


def random_texts(n, vocabulary, seed, longest=60):
    draw = random.Random(seed)
    return [" ".join(draw.choices(vocabulary, k=draw.randint(0, longest))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination ----------------------------------------------------------


def brute_contamination(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda x: pattern.findall((x or "").translate(ASCII))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i : i + 13])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("most", [decontaminate.MOST_BROADCAST_WINDOWS, 0])
def test_contamination_against_brute_force(spark, documents, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST_WINDOWS", most)
    vocabulary = ["The", "a", "ü1", "No", "zwei", "x"]
    docs = list(enumerate(random_texts(60, vocabulary, 1, 80)))
    items = list(enumerate(random_texts(12, vocabulary, 2, 20))) + [(50, None), (51, "No"), (52, "qq " * 40)]
    docs += [(900, "qq " * 100), (901, None), (902, "--"), (903, docs[5][1]), (903, docs[6][1]), (None, docs[7][1])]
    benchmark = spark.createDataFrame(items, "item_id INT, text STRING")
    got = decontaminate.digest(decontaminate.contamination(spark, documents(docs), benchmark))
    assert in_order(got.collect()) == in_order(brute_contamination(docs, items))


def test_clean_documents_keeps_rows_and_columns(spark, documents):
    passage = " ".join(f"test{i}" for i in range(20))
    docs = documents([(1, passage), (2, "clean"), (2, "clean"), (None, passage), (3, None), (4, passage + " y" * 500)])
    benchmark = spark.createDataFrame([(1, passage)], "item_id INT, text STRING")
    kept = decontaminate.clean_documents(spark, docs, benchmark)
    assert kept.columns == docs.columns
    assert in_order((r.doc_id,) for r in kept.collect()) == in_order([(2,), (2,), (3,), (4,)])
    none = benchmark.where("item_id > 1")
    assert decontaminate.clean_documents(spark, docs, none).count() == 6
    assert decontaminate.contamination(spark, docs.where("doc_id < 0"), benchmark).count() == 0


# --- substrings ---------------------------------------------------------------


def brute_substrings(docs, size=13):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if d is not None:
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and least[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("windows_per_flush", [1_200_000, 40])
def test_substrings_against_brute_force(spark, documents, monkeypatch, windows_per_flush):
    monkeypatch.setattr(substrings, "WINDOWS_PER_FLUSH", windows_per_flush)
    monkeypatch.setattr(substrings, "CHARS_PER_BLOCK", 200)
    draw = random.Random(3)
    passages = [" ".join(f"p{j}x{i}" for i in range(30)) for j in range(4)]
    docs = []
    for i in range(80):
        parts = [" ".join(f"u{i}_{k}" for k in range(draw.randint(0, 12))) for _ in range(3)]
        parts.insert(draw.randint(0, 3), draw.choice(passages))
        docs.append((draw.randint(-40, 40), " \n".join(parts)))
    docs += [(99, "a " * 50), (98, "a " * 13), (97, "b " * 12), (None, passages[0]), (5, None), (6, "x\xa0y\x1cz " * 14)]
    docs += [docs[0], docs[0]]
    got = substrings.digest(documents(docs))
    assert in_order(got.collect()) == in_order(brute_substrings(docs))
    kept = {r.doc_id: r.kept for r in substrings.deduplicated(documents([(1, passages[1]), (2, "q " + passages[1])])).collect()}
    assert kept == {1: passages[1], 2: "q"}


def test_a_hot_group_is_split(spark, documents, monkeypatch):
    """A four-word phrase with other words around it in every text fills many buckets, each with few windows."""
    monkeypatch.setattr(substrings, "SAMPLE_SHARE", 0.5)
    monkeypatch.setattr(substrings, "WINDOWS_PER_BUCKET", 60)
    draw = random.Random(21)
    around = lambda: " ".join(f"z{draw.randint(0, 4)}" for _ in range(9))
    docs = [(i, f"{around()} the same four words {around()} end {draw.randint(0, 5)}") for i in range(150)]
    docs += [(200 + i, docs[i][1]) for i in range(40)]
    rows = documents(docs).selectExpr("doc_id", "text", "1 AS tag")
    buckets = substrings.chosen_buckets(rows.select("doc_id", "text", "tag"), 13)
    assert len(buckets.split) and (buckets.parts > 1).any() and buckets.many >= 2000 // 60
    sizes = Counter()
    for _, text in docs:
        words = [w.encode() for w in text.split()]
        window, least = substrings.window_parts(substrings.hashed_rows([words])[0], 13)
        sizes.update(buckets.of(least, window).tolist())
    assert max(sizes.values()) < 0.2 * sum(sizes.values())
    assert in_order(substrings.digest(documents(docs)).collect()) == in_order(brute_substrings(docs))


def test_windows_whose_hashes_meet_are_told_apart(spark, documents, monkeypatch):
    real = substrings.window_parts
    monkeypatch.setattr(substrings, "window_parts", lambda h, n: (real(h, n)[0] % 4, real(h, n)[0]))
    docs = list(enumerate(random_texts(60, ["a", "b", "c"], 5, 40)))
    words = [substrings.plain_words(t) for _, t in docs]
    rows = substrings.hashed_rows(words)
    ids, tags = substrings.np.arange(60), substrings.np.zeros(60, substrings.np.int32)
    buckets = substrings.Buckets(3, substrings.np.zeros(0, substrings.np.uint64), substrings.np.zeros(0, substrings.np.int64))
    covered = defaultdict(list)
    groups = defaultdict(list)
    for bucket, hashes, runs, owners, marks in substrings.task_groups(ids, tags, rows, 13, buckets):
        if bucket < 0:
            found = substrings.pa.ipc.open_stream(runs).read_all().to_pylist()
        else:
            groups[bucket].append({"hashes": hashes, "runs": runs, "docs": owners, "tags": marks})
            continue
        for row in found:
            covered[row["doc_id"]].append(row["spans"])
    for group in groups.values():
        for row in substrings.settle(group).to_pylist():
            covered[row["doc_id"]].append(row["spans"])
    got = [len(w) - len(substrings.kept_words(w, covered.get(i), 13)) for i, w in enumerate(words)]
    assert got == [gone for _, _, gone, _ in brute_substrings(docs)]


# --- near duplicates ----------------------------------------------------------


def brute_groups(docs, size):
    def shingles(text):
        w = (text or "").translate(ASCII).encode().split()
        return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()

    sets = defaultdict(list)
    for d, t in docs:
        sets[d].append(shingles(t))
    ids = [d for d in sets if d is not None]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            pairs = ((x, y) for x in sets[a] for y in sets[b] if x and y)
            if any(100 * len(x & y) >= 80 * len(x | y) for x, y in pairs):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    rows = []
    for d, t in docs:
        rows.append((d, len(shingles(t)), None if d is None else find(d), d is not None and find(d) == d))
    return rows


def edited(text, share, draw):
    words = text.split()
    for i in range(len(words)):
        if draw.random() < share:
            words[i] = f"e{draw.randint(0, 10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_against_brute_force(spark, documents, size):
    draw = random.Random(4)
    base = [" ".join(f"v{draw.randint(0, 400)}" for _ in range(150)) for _ in range(6)]
    docs = [(i, t) for i, t in enumerate(base)]
    # A group of edited copies around an original, where many copies only link to it.
    for i in range(120):
        docs.append((1000 + i, edited(base[0], draw.choice([0.01, 0.04, 0.05, 0.06, 0.08]), draw)))
    # A chain: each text a copy of the one before.
    text = base[1]
    for i in range(12):
        text = edited(text, 0.03, draw)
        docs.append((3000 - i, text))
    docs += [(50, base[2]), (51, base[2].upper()), (52, base[2] + " z")]
    docs += [(60, "one"), (61, "ONE"), (62, "one two"), (63, None), (64, " \n"), (None, base[3]), (70, base[3]), (70, base[3])]
    got = near.digest(spark, documents(docs), size)
    assert in_order(got.collect()) == in_order(brute_groups(docs, size))


@pytest.mark.parametrize("seed", [16623, 32923])
def test_links_whose_signatures_agree_little_are_found(spark, documents, seed):
    """Exactly 0.8 similar, 111 or 112 of 160 values agree, and one region of two holds them."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(10**6)}" for _ in range(91)]
    other = [f"n{draw.randrange(10**6)}" if i in (9, 29, 49, 69, 89) else w for i, w in enumerate(words)]
    docs = [(1, " ".join(words)), (2, " ".join(other)), (3, "x y z")]
    got = near.digest(spark, documents(docs), 2)
    assert in_order(got.collect()) == in_order(brute_groups(docs, 2))


def test_bucket_counts_leave_out_no_link():
    draw = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    texts = [edited(" ".join(words[:n]), share, draw) for n in (5, 90, 110, 400) for share in (0, 0.02, 0.05, 0.06, 0.3)]
    sets = near.text_sets(texts, 2)
    rows = [
        {"doc_id": i, "label": i, "sketch": near.bucket_counts(x).tobytes(), "visitor": v}
        for v in (False, True)
        for i, x in enumerate(sets)
    ]
    met = {(v["doc_id"], x["doc_id"]) for v, partners in near._possible(iter(rows)) for x in partners}
    links = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j and near.similar(x, y)}
    assert links <= met and len(links) > 10 and len(met) < len(sets) ** 2 / 2


def test_components_against_union_find(spark):
    draw = random.Random(8)
    chain = [(i, i + 1) for i in range(60)]  # hooks only ever lead one step down
    links = [*chain, *[(draw.randint(100, 300), draw.randint(100, 300)) for _ in range(90)], (500, 400), (500, 401), (400, 402)]
    links = [(min(x), max(x)) for x in links if x[0] != x[1]]
    root = {i: i for pair in links for i in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    expected = {i: find(i) for i in root}
    df = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    assert {r.doc_id: r.label for r in near.components(spark, df).collect()} == expected
    known = near.components(spark, df.where("a % 3 = 0"))
    assert {r.doc_id: r.label for r in near.components(spark, df, known).collect()} == expected
    assert near.components(spark, df.where("a < 0")).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark, documents):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(3, text), (1, text), (1, text), (2, text + " z"), (4, "other"), (5, None), (5, None), (None, text)]
    rows += [(3, None), (3, " \n"), (1, ""), (6, "some words"), (6, None)]
    docs = documents(rows)
    kept = near.kept_documents(spark, docs)
    assert kept.columns == docs.columns
    expected = [(1, text), (4, "other"), (5, None), (5, None), (None, text), (3, None), (3, " \n"), (1, ""), (6, "some words"), (6, None)]
    assert in_order((r.doc_id, r.text) for r in kept.collect()) == in_order(expected)
    assert near.kept_documents(spark, docs.where("doc_id < 0")).count() == 0


# --- sharding -----------------------------------------------------------------


def test_sharding_places_every_row_once(spark, documents):
    draw = random.Random(5)
    docs = [(i, "é" * draw.randint(0, 900)) for i in range(3000)] + [(1, None), (1, None), (None, "x"), (7, "y" * 20_000)]
    rows = sharding.shard_documents(spark, documents(docs), shards=40).collect()
    assert len(rows) == len(docs)
    expected = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    places, sizes = defaultdict(list), Counter()
    for r in rows:
        places[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert sorted(places) == list(range(40))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    assert sharding.shard_documents(spark, documents([]), shards=40).count() == 0


def test_growing_moves_records_only_into_the_new_shard(spark, documents):
    rows = sharding.records(documents([(i, "x" * (i % 300)) for i in range(4000)]), slots=512)
    old = sharding.rebalanced(sharding.first_map(sharding.slot_loads(rows, 512), 8), 8).cache()
    new = sharding.grown(old, 8)
    before, after = ({r.virtual_slot: r.shard for r in m.collect()} for m in (old, new))
    assert set(before) == set(after) == set(range(512))
    assert {after[s] for s in after if after[s] != before[s]} == {8}
    loads = [r.b for r in new.groupBy("shard").agg({"bytes": "sum"}).toDF("shard", "b").collect()]
    assert len(loads) == 9 and max(loads) < 1.1 * min(loads)


# --- search -------------------------------------------------------------------


def test_search_against_brute_force(spark, documents):
    draw = random.Random(6)
    common, rare = [f"c{i}" for i in range(15)], [f"r{i}" for i in range(400)]
    docs = [(i, " ".join(draw.choices(common, k=20) + draw.choices(rare, k=draw.randint(0, 15)))) for i in range(400)]
    docs += [(1000, None), (1001, "--"), (1002, docs[3][1]), (1050, docs[3][1].upper()), (None, "c1 c2")]
    queries = [d for d in docs if d[0] is not None and d[0] % 25 == 0]
    got = search.top_k(spark, documents(docs), documents(queries), k=7).collect()
    tf = [(d, Counter(words_of(t))) for d, t in docs]
    n, mean = len(tf), sum(sum(c.values()) for _, c in tf) / len(tf)
    df = Counter(w for _, c in tf for w in c)
    import math

    expected = []
    for q, own in [(d, c) for d, c in tf if d is not None and d % 25 == 0]:
        scores = []
        for d, c in tf:
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(
                m * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w, m in own.items() if w in c
            )
            if s > 0 and d is not None and d != q:
                scores.append((-round(s, 6), d))
        expected += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:7])]
    assert in_order(got) == in_order(expected)
    assert search.top_k(spark, documents([]), documents([])).count() == 0


def test_search_with_repeated_rows(spark, documents):
    """A repeated document is found as often as it stands there; rows of one query id are one query."""
    docs = [(1, "red fox"), (1, "red fox"), (2, "red hen"), (3, "blue fox"), (4, None), (50, "red"), (50, "fox")]
    got = search.top_k(spark, documents(docs), documents([(50, "red"), (50, "fox")]), k=10).collect()
    both = search.top_k(spark, documents(docs), documents([(50, "red fox")]), k=10).collect()
    assert [(r.rank, r.doc_id, r.score) for r in got] == [(r.rank, r.doc_id, r.score) for r in both]
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"])][:2] == [1, 1] and {r.doc_id for r in got} == {1, 2, 3}


def test_search_leaves_out_documents_without_an_id(spark, documents):
    docs = documents([(None, "red fox"), (1, "red"), (50, "red fox"), (2, None)])
    assert [(r.query_id, r.doc_id) for r in search.top_k(spark, docs, docs.where("doc_id = 50")).collect()] == [(50, 1)]


@pytest.mark.parametrize("cells, scores, postings", [(4_000_000, 500_000, 50_000), (900, 700, 40), (0, 1, 1)])
def test_shard_scores_many_queries_at_once(monkeypatch, cells, scores, postings):
    """Terms in the matrix and beside it, in blocks of any size, give the sums of all common terms."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(search, "CELLS", cells)
    monkeypatch.setattr(search, "SCORES", scores)
    monkeypatch.setattr(search, "POSTINGS", postings)
    draw = random.Random(8)
    texts = [" ".join(draw.choices("abcde", k=4) + [f"r{draw.randint(0, 60)}" for _ in range(draw.randint(0, 9))]) for _ in range(300)]
    texts[7], texts[8], texts[9] = "", texts[0], None
    ids = [*range(290), 3, 4, *[None] * 8]
    found = search.term_counts(texts)
    held = sorted((t, i, n) for i, row in enumerate(found) for t, n in zip(*(x.tolist() for x in row), strict=True))
    terms = Counter(t for t, _, _ in held)
    lengths = [int(n.sum()) for _, n in found]
    mean = sum(lengths) / len(lengths)
    shard = search.Shard(
        pa.array(ids, pa.int64()),
        np.array(lengths),
        np.array(sorted(terms)),
        np.array([terms[t] for t in sorted(terms)], np.int32),
        np.array([i for _, i, _ in held], np.int32).tobytes(),
        np.array([n for _, _, n in held], np.int32).tobytes(),
        mean,
    )
    assert len(shard.matrix) == (0 if cells == 0 else min(cells // 300, sum(n > 0.05 * 300 for n in terms.values())))
    asked = [(q, {t: 1 + n / 7 for t, n in zip(*(x.tolist() for x in found[q]), strict=True)} | {5: 2.0}) for q in range(0, 290, 5)]
    flat = [x for _, own in asked for x in sorted(own.items())]
    columns = [q for q, _ in asked], [len(own) for _, own in asked], [t for t, _ in flat], [w for _, w in flat]
    columns, known = [np.array(x) for x in columns], np.zeros((len(asked), 4))
    got = shard.best(*columns, known)
    expected = []
    for q, own in asked:
        score = Counter()
        for t, i, n in held:
            if t in own and ids[i] not in (None, q):
                score[i] += own[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * lengths[i] / mean))
        expected += [(q, ids[i], round(s, 6)) for i, s in sorted(score.items(), key=lambda x: (-round(x[1], 6), ids[x[0]]))[:4]]
    assert list(zip(*(x.tolist() for x in got), strict=True)) == expected
    # With these scores as thresholds a block of documents goes only if it can't reach them.
    assert [s for _, _, s in expected if s] == [s for row in known.tolist() for s in sorted(row)[::-1] if s]
    again = shard.best(*columns, known.copy())
    assert list(zip(*(x.tolist() for x in again), strict=True)) == expected
    assert not len(shard.best(*columns, known + 99)[0])
    seen = []
    monkeypatch.setattr(search.Shard, "in_reach", lambda *x, f=search.Shard.in_reach: seen.append(f(*x)) or seen[-1])
    shard.best(*(x[: columns[1][0]] if x is columns[2] or x is columns[3] else x[:1] for x in columns), known[:1] + 99)
    assert len(seen) == 1 and not len(seen[0])


def test_search_sends_bounded_batches_to_python(spark, documents, monkeypatch):
    """An executor's memory holds one shard or a few MB of texts for a task, and the session's limit comes back."""
    limits, key = [], search.BATCH_KEY
    kept = lambda s, rows, label, f=search.kept_table: limits.append((label, s.conf.get(key, None))) or f(s, rows, label)
    monkeypatch.setattr(search, "kept_table", kept)
    before = spark.conf.get(key, None)
    docs = documents([(i, f"red w{i} w{i // 2}") for i in range(60)])
    search.top_k(spark, docs, docs.where("doc_id % 20 = 0"))
    bounded = str(search.BATCH_BYTES)
    assert limits == [("shards", bounded), ("query-terms", bounded), ("queries", before), ("found", bounded)]
    assert spark.conf.get(key, None) == before
    monkeypatch.setattr(search, "BATCH_BYTES", 40_000)
    texts = spark.range(0, 400, 1, 1).selectExpr("repeat('x', 1000) AS text")

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes], pa.int64())], ["size"])

    found = [r["size"] for r in search.kept_in_batches(spark, texts.mapInArrow(sizes, "size bigint"), "sizes").collect()]
    assert sum(found) > 400_000 and max(found) < 50_000
    with pytest.raises(Exception, match="no_such"):
        search.kept_in_batches(spark, texts.selectExpr("raise_error('no_such')"), "failed")
    assert spark.conf.get(key, None) == before


def test_search_shards_span_batches_and_blocks_hold_bounded_terms(spark, documents, monkeypatch):
    texts = [(i, f"red w{i} w{i // 2}" + " blue" * (300 if i == 7 else i % 3)) for i in range(90)] + [(None, "red"), (90, None)]
    docs = documents(texts).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        (shard,) = search.shards(docs.select("doc_id", "text")).collect()
        assert sorted(shard.docs, key=str) == sorted((d for d, _ in texts), key=str)
        assert len(shard.places) == sum(shard.counts) and len(shard.tfs) == 2 * sum(shard.counts)  # 92 documents, 300 times blue
        whole = in_order(search.top_k(spark, docs, docs.where("doc_id % 9 = 0")).collect())
        monkeypatch.setattr(search, "CHARS_PER_SHARD", 200)
        monkeypatch.setattr(search, "TERMS_PER_BLOCK", 9)
        labels = []
        kept = lambda s, rows, label, f=search.kept_table: labels.append(label) or f(s, rows, label)
        monkeypatch.setattr(search, "kept_table", kept)
        assert in_order(search.top_k(spark, docs, docs.where("doc_id % 9 = 0")).collect()) == whole
        assert labels.count("found") > 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_registered_shards_follow_their_law(spark):
    rows = contract.queries()["op7_sharding"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    expected = {(r.doc_id, len(r.text.encode()) + 16, zlib.crc32(r.text.encode())) for r in docs}
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == expected and len(rows) == len(docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    loads, places = Counter(), defaultdict(list)
    for r in rows:
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(loads) == list(range(40)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(loads.values()) < 1.5 * min(loads.values())


def test_long_texts_and_empty_tables(spark, documents):
    long_text = " ".join(f"w{i}" for i in range(300_000))
    docs = documents([(1, long_text), (2, long_text), (3, None)])
    sizes = {r.doc_id: r.size for r in sharding.shard_documents(spark, docs, shards=40).collect()}
    assert sizes == {1: len(long_text) + 16, 2: len(long_text) + 16, 3: 16}
    removed = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.digest(docs).collect()}
    assert removed == {1: (300_000, 0), 2: (300_000, 300_000), 3: (0, 0)}
    assert substrings.digest(documents([])).count() == 0
    page = "<article>" + "".join(f"<p>line {i}</p>" for i in range(100_000)) + "</article>"
    pages = spark.createDataFrame([(1, "http://l.org/1", page), (2, "http://l.org/2", page + "<p>end of the page</p>")], "page_id BIGINT, url STRING, html STRING")
    texts = {r.page_id: r.text.count("\n\n") for r in webtext.extracted(pages).collect()}
    assert texts == {1: 99_999, 2: 100_000}


# --- web pages ----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
%s<div id="comments"><article>reader says</article></div><form><p>search</p></form>
<p>Shared tail line</p><footer>&copy; 2024</footer><script>var t="</p>";</script></body></html>"""
ARTICLE = "<article><header><h1>Head &amp; line %s</h1></header><p>Own  text\n%s<p><b>bold</b> 1 &lt; 2<br>end</article>"


def test_main_text(spark):
    pages = [(i, f"https://h.org/a/{i}?x={i}", PAGE % (ARTICLE % (i, i))) for i in range(40)]
    pages += [(100, "https://h.org/copy/1", PAGE % (ARTICLE % (1, 1))), (101, "https://h.org/copy/2", PAGE % (ARTICLE % (1, 1)))]
    pages += [(102, "https://h.org/d", PAGE % (ARTICLE % (2, 2)))]
    pages += [(200, None, None), (201, "https://o.org/", ""), (202, "https://h.org/b", "<p>plain <i>page</i></p><p>Shared tail line</p>")]
    pages += [(203, "http://cut.org/1", "<article><p>one</p><p>tw"), (204, "http://cut.org/2", "a &amp; b <br"), (205, "x", "<nav>m<article>t</article>")]
    df = spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING").repartition(5).selectExpr("*", "1 AS range", "2 AS lines")
    got = {r.page_id: r for r in webtext.extracted(df).collect()}
    assert len(got) == len(pages)
    for i in (*range(40), 100, 101):
        n = 1 if i >= 100 else i
        assert got[i].text == f"Head & line {n}\n\nOwn text {n}\n\nbold 1 < 2 end"
    assert (got[200].text, got[200].n_chars, got[200].url, got[201].text) == ("", 0, None, "")
    assert got[202].text == "plain page"  # the other line is shared with the nearest page of the host
    assert [got[i].text for i in (203, 204, 205)] == ["one\n\ntw", "a & b", "t"]


@pytest.mark.parametrize(
    "tag", ["div class='content has-sidebar'", "div id='layout-with-sidebar'", "article class='post comments-open'", "article class='sponsored'"]
)
def test_a_class_that_names_something_else_marks_nothing(tag):
    page = f"<body><div class='sidebar'>side</div><{tag}><p>text</p></{tag.split()[0]}><article class='comment'>reader</article></body>"
    assert [x for x, kind in webtext.page_lines(page) if kind != webtext.TEMPLATE] == ["text"]


PARAGRAPHS = [f"Paragraph {i} of the text that the page is about, with some words of its own." for i in range(3)]


def body(*lines):
    return "<body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body>"


def test_copies_in_plain_pages_keep_their_text(spark):
    """Pages without an article element: copies under another title stay, shared template lines go."""
    own = lambda i: [f"Page {i} says something that no other page says, line {k} of it." for k in range(4)]
    frame = ["Home of the site", "Write to us"]
    pages = [(i, f"http://a.org/{i:03}", body(frame[0], *own(i), frame[1])) for i in range(60)]
    pages += [(i, f"http://b.org/{i}", body(f"Title {i}", *PARAGRAPHS)) for i in (100, 101)]
    pages += [(110, "http://c.org/1", body("Quote of all", *own(1))), (111, "http://c.org/2", body(*own(2))), (112, "http://c.org/3", body("Quote of all", *own(3)))]
    pages += [(113, "http://c.org/4", body(*own(4))), (114, "http://c.org/5", body(*own(5)))]
    df = spark.createDataFrame(pages, "page_id STRING, url STRING, html STRING").repartition(6)
    got = {int(r.page_id): r.text.split("\n\n") for r in webtext.extracted(df).collect()}
    assert all(got[i] == own(i) for i in range(60))
    assert all(got[i] == [f"Title {i}", *PARAGRAPHS] for i in (100, 101))
    assert got[110] == ["Quote of all", *own(1)] and got[111] == own(2)  # two of five pages share it


@pytest.mark.parametrize("tag", ["div class='post social'", "section class='story related-topics'", "div class='newsletter-archive'", "p class='copyright-law'", "div class='widget'"])
def test_one_class_word_deletes_no_article(tag):
    page = f"<body><nav>menu</nav><{tag}>{PARAGRAPHS[0]}</{tag.split()[0]}><div class='sidebar-box'>side</div></body>"
    assert [x for x, kind in webtext.page_lines(page) if kind != webtext.TEMPLATE] == [PARAGRAPHS[0]] + ["side"] * (tag == "div class='widget'")


def brute_extracted(pages):
    """The whole operator in plain Python: all pages of a host in one list, alignment by the plain table."""

    def aligned(mine, other):
        best = [[0] * (len(other) + 1) for _ in range(len(mine) + 1)]
        for i, x in enumerate(mine):
            for j, y in enumerate(other):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    hosts = defaultdict(list)
    for page_id, url, html in pages:
        match = re.match(r"(?i)([a-z][a-z0-9+.-]*://([^/?#]*))?([^?#]*)", url or "")
        hosts[(match[2] or "").lower()].append((match[3], str(page_id) if page_id is not None else "", page_id, webtext.page_lines(html)))
    out = []
    for rows in hosts.values():
        rows.sort(key=lambda r: r[:2])
        for at, (_, _, page_id, lines) in enumerate(rows):
            texts, kinds = [x for x, _ in lines], [k for _, k in lines]
            beside = [[x for x, _ in r[3]] for r in rows[max(0, at - 2) : at] + rows[at + 1 : at + 3]]
            kinds_beside = [[k for _, k in r[3]] for r in rows[max(0, at - 2) : at] + rows[at + 1 : at + 3]]
            votes, witnesses = Counter(), 0
            for other, other_kinds in zip(beside, kinds_beside):
                common = webtext.common_lines(texts, other)
                assert len(common) == aligned(texts, other)
                back = webtext.common_lines(other, texts)
                enough = []
                for words, marks, shared in ((texts, kinds, common), (other, other_kinds, back)):
                    whole = sum(len(x) for x, k in zip(words, marks) if k != webtext.TEMPLATE)
                    left = sum(len(x) for i, (x, k) in enumerate(zip(words, marks)) if k != webtext.TEMPLATE and i not in shared)
                    enough.append(left >= 200 or left >= 0.3 * max(whole, 1))
                if not common or all(enough):
                    witnesses += 1
                    votes.update(common)
            kept = [x for i, (x, k) in enumerate(lines) if k == webtext.MAIN or (k == webtext.OUTSIDE and not (votes[i] and 2 * votes[i] > witnesses))]
            out.append((page_id, "\n\n".join(kept)))
    return out


def test_extraction_against_brute_force(spark):
    draw = random.Random(12)
    line = lambda: draw.choice([f"common {draw.randint(0, 6)}", f"own {draw.random()}", "a longer line of text that pages share " * 3])
    pages = []
    for i in range(250):
        parts = [f"<p>{line()}</p>" for _ in range(draw.randint(0, 9))]
        if draw.random() < 0.3:
            parts.insert(draw.randint(0, len(parts)), "<article>" + "".join(f"<p>{line()}</p>" for _ in range(3)) + "</article>")
        if draw.random() < 0.3:
            parts.append("<div class='widget'>" + line() + "</div><footer>x</footer>")
        pages.append((i, draw.choice(["http://H.org/%d?x=%d", "https://k.net/a/%d#%d", "%d/%d"]) % (draw.randint(0, 80), i), "".join(parts)))
    pages += [(1000, None, None), (1001, None, "<p>x</p>"), (1002, "http://H.org/", ""), pages[3], pages[3]]
    df = spark.createDataFrame(pages, "page_id INT, url STRING, html STRING").repartition(7)
    got = webtext.extracted(df)
    assert in_order(got.select("page_id", "text").collect()) == in_order(brute_extracted(pages))
    assert webtext.extracted(df.where("page_id < 0")).count() == 0


def test_many_lines_are_aligned_in_bit_rows():
    draw = random.Random(2)
    a, b = ([f"{draw.randint(0, 900)}" for _ in range(3000)] for _ in range(2))
    found = sorted(webtext.common_lines(a, b))
    rest = iter(b)
    assert all(a[i] in rest for i in found) and len(found) > 100


def test_common_lines_are_a_longest_common_subsequence():
    draw = random.Random(7)
    for _ in range(200):
        a, b = (draw.choices("abcde", k=draw.randint(0, 12)) for _ in range(2))
        found = sorted(webtext.common_lines(a, b))
        rest = iter(b)
        assert all(a[i] in rest for i in found)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(found) == best[-1][-1]
