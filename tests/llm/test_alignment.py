"""Cross-tokenizer alignment against the two libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from waymark.llm import alignment

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
ROOT = "/root/testdata/sf0.01"


def token_bytes():
    a = Tokenizer.from_file(PATH_A)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    of_a = {i: bytes(byte[x] for x in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    of_b = {}
    for i in range(3, b.get_piece_size()):
        p = b.id_to_piece(i)
        of_b[i] = bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    a.encode_special_tokens = True
    return a, b, of_a, of_b


def brute_alignment(docs):
    a, b, of_a, of_b = token_bytes()
    rows, counts = [], Counter()
    for doc_id, text in docs:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(of_a[i] for i in ids_a) != whole or b"".join(of_b[i] for i in ids_b) != whole:
            ids_a, ids_b = [], []
        groups, i, j, x, y = [], 0, 0, 0, 0
        own_a, own_b = [], []
        while i < len(ids_a) or j < len(ids_b):
            if x <= y:
                own_a.append(ids_a[i])
                x += len(of_a[ids_a[i]])
                i += 1
            else:
                own_b.append(ids_b[j])
                y += len(of_b[ids_b[j]])
                j += 1
            if x == y:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        links = [(p, q) for g, h in groups for p in g for q in h]
        counts.update(set(links))
        rows.append((doc_id, len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (p, _), n in counts.items():
        best[p] = max(best[p], n)
    out = []
    for doc_id, n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_best = sum(counts[x] == best[x[0]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return out, {(p, q): (n, n == best[p]) for (p, q), n in counts.items()}


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sample_docs(spark):
    texts = [r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("text").limit(60).collect()]
    texts += [None, "", " ", "a", "  two  blanks\n\n\ttab ", "<|endoftext|> </s> <s> <unk> <0x41>", "▁ piece mark", "\x00\x01", "é ́x 漢字かな 😀👍🏽"]
    texts += ["x" * 5000, "ab" * 3000 + " aab", "-" * 4001 + "=" * 333, texts[0], texts[0]]
    return [(i // 2 - 5, t) for i, t in enumerate(texts)] + [(None, texts[1]), (None, None)]


@pytest.mark.parametrize("most_heavy", [alignment.MOST_HEAVY, 40])
def test_alignment_against_brute_force(spark, documents, monkeypatch, most_heavy):
    monkeypatch.setattr(alignment, "LARGE_GROUP", 30 if most_heavy == 40 else alignment.LARGE_GROUP)
    docs = sample_docs(spark)
    expected, pairs = brute_alignment(docs)
    got, found = alignment.alignment(spark, documents(docs), PATH_A, PATH_B, most_heavy=most_heavy)
    names = ["doc_id", *alignment.COLUMNS, "n_best", "count_sum", "groups"]
    assert in_order(got.select(*names).collect()) == in_order(expected)
    assert {(r.a, r.b): (r.n, r.is_best) for r in found.collect()} == pairs
    assert sum(x[4] for x in expected) > sum(x[3] for x in expected)


def test_alignment_of_nothing(spark, documents):
    assert alignment.digest(spark, documents([]), PATH_A, PATH_B).count() == 0
    rows = alignment.digest(spark, documents([(1, None), (2, "")]), PATH_A, PATH_B).collect()
    assert in_order(rows) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_ranks_and_library_encode_alike():
    a = alignment.ByteLevel(alignment.read_bytes(PATH_A).decode())
    assert a.ranked is not None
    for text in (" It's I'LL 12ab  x\r\n\n  y", " <|endoftext|>", " " + "ab " * 500, " " * 300_000 + "x"):
        assert a.encode(text).tolist() == a.library.encode(text, add_special_tokens=False).ids


def test_groups_of_one_text_and_other_columns(spark, documents):
    df = documents([(1, "word"), (2, "words")]).selectExpr("doc_id AS id", "text AS body", "'x' AS doc_id", "'y' AS pairs")
    got, _ = alignment.alignment(spark, df, PATH_A, PATH_B, "id", "body", with_groups=True)
    a, b, *_ = token_bytes()
    for r in got.collect():
        text = {1: "word", 2: "words"}[r.doc_id]
        assert r.groups.split(";")[0].split("|")[0].startswith(str(a.encode(" " + text).ids[0]))
        assert r.n_b == len(b.encode(text))


def aligner():
    return alignment.Aligner(alignment.read_bytes(PATH_A).decode(), alignment.read_bytes(PATH_B))


def test_words_of_a_block_are_encoded_once():
    words = [f"{a}{b}" for a in ("north", "Wörter", "12", "don't") for b in ("", ".", "ing", "\nand")]
    texts = [" ".join(words[(i * j) % len(words)] for j in range(200)) for i in range(1, 60)]
    one, seen = aligner(), []
    for side in (one.a, one.b):
        side.encode = lambda text, plain=side.encode: seen.append(len(text)) or plain(text)
    counts, *_ = one.aligned(texts)
    assert counts[0].min() >= 200
    assert sum(seen) < 1000 < sum(map(len, texts))


def test_words_and_whole_texts_align_alike(monkeypatch):
    bits = [" ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "▁", "'s", "12", "word", "é", "́", "漢字", "<0x41>", "--", " the"]
    draw = random.Random(3)
    texts = ["".join(draw.choices(bits, k=draw.randint(0, 30))) for _ in range(500)]
    texts += [None, "", " ", "x ", " x", "x" * 5000, "▁ a b", "a b a"]
    by_words, whole = aligner(), aligner()
    assert by_words.by_words
    whole.by_words = False
    expected = whole.aligned(texts)
    monkeypatch.setattr(alignment, "MOST_WORDS", 50)
    for part in (texts, texts[:100], texts):
        counts, groups, row, pairs, links = by_words.aligned(part)
        kept = expected[2] < len(part)
        assert counts.tolist() == expected[0][:, : len(part)].tolist() and groups == expected[1][: len(part)]
        for got, of_whole in zip((row, pairs, links), expected[2:], strict=True):
            assert got.tolist() == of_whole[kept].tolist()
    assert sum(not x for x in groups) > 10
