"""Lexical search, streamed BPE and vector codes against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from statuta.llm import bpe_stream, maxscore, vector_codes
from statuta.llm.token_counts import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def rows(df):
    return [tuple(r) for r in df.collect()]


# -- 11 ----------------------------------------------------------------------------------------


def plain_search(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    texts = [(i, cut(t)) for i, t in docs]
    n, total = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    counted = [(i, Counter(t), len(t)) for i, t in texts]
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in counted:
            m = 100 - 75 + 75 * size * n // max(1, total)
            scores.append((i, sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in cut(text) if c[t])))
        best = sorted(((i, s) for i, s in scores if s > 0), key=lambda x: (-x[1], x[0] is None, x[0]))[:k]
        out += [(item, r + 1, i, s) for r, (i, s) in enumerate(best)]
    return out


@pytest.mark.parametrize("shard_docs, window, block", [(32_768, 512, 8_000_000), (50, 8, 8_000_000), (50, 8, 300)])
def test_search(spark, monkeypatch, shard_docs, window, block):
    for name, value in (("SHARD_DOCS", shard_docs), ("WINDOW", window), ("BLOCK_BYTES", block), ("SLICE", 100)):
        monkeypatch.setattr(maxscore, name, value)
    r = random.Random(5)
    words = [f"w{int(r.expovariate(0.02))}" for _ in range(3000)] + ["Ärger", "ÄRGER", "日本", "X1", "x1"]
    docs = [(k, " ".join(r.choice(words) for _ in range(r.choice((1, 5, 40, 300))))) for k in range(400)]
    docs += [(900 + k, docs[3][1]) for k in range(12)] + [(3, docs[3][1]), (None, docs[3][1]), (1000, None), (1001, ""), (1002, "-- !"), (1003, "X1;x1\x0bÄrger_日本"), (1004, "word " * 5000)]
    items = [(k, " ".join(r.choice(words) for _ in range(r.choice((1, 4, 30))))) for k in range(30)] + [(50, docs[3][1]), (51, None), (52, "?"), (53, "nowhere"), (54, "x1 x1 X1"), (None, "word")]
    made = spark.createDataFrame([(i, t, "a", "b") for i, t in docs], "doc_id long, text string, score string, item_id string").repartition(3)
    got = rows(maxscore.search(made, spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank int"), 10))
    assert sorted(got, key=str) == sorted(plain_search(docs, items, 10), key=str)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(maxscore.search(docs.limit(0), items)) == rows(maxscore.search(docs, items.limit(0))) == []
    assert rows(maxscore.search(docs.where("false").unionAll(docs.selectExpr("doc_id", "cast(null as string)")), items)) == []


def test_non_essential_lists_are_probed_for_candidates_alone(spark):
    """Frequent terms of low bounds are read for candidates only; results are those of reading all."""
    shard = maxscore.Shard(None)
    r = random.Random(1)
    for k in range(5000):
        shard.add(k, " ".join(["the"] * r.randrange(1, 4) + ["rare"] * (k < 40) + [f"w{r.randrange(50)}"] * 3))
    opened = maxscore.Opened({k: v[0] for k, v in shard.row().to_pydict().items()}, 5000, 5000 * 5)
    read = []
    real = maxscore.impact
    maxscore.impact = lambda tf, m: (read.append(len(tf)), real(tf, m))[1]
    try:
        top, scores = opened.best({b"the": 1, b"rare": 5000}, 10)
    finally:
        maxscore.impact = real
    assert len(top) == 10 and max(top) < 40
    assert sum(read) < 700  # of 5040 postings


# -- 12 ----------------------------------------------------------------------------------------

ODD = ["<|endoftext|>", "<|startoftext|>a<|endoftext|>b <|endoftext|", "it's I'LL we've 'tis ''s'd''", "é é ΣΑΣ İstanbul ǅ", "a\x1cb\x1dc \x85 \xa0x​z", "日本語 한국어 한 ﬁ Å K", "123 4½ ² Ⅷ ٣", "\U0001f602\U0001f602\U0001f602 \U0001f1fa\U0001f1f8", "\x00\x7f\x80﻿", "", " ", "\n\ńa", "don't'", "x'r 'v 'l y'", "a" * 300, "!" * 500, "'" * 999, "'s" * 400, "1" * 300, "́" * 300]


@pytest.fixture
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("slice_, block, longest", [(1_000_000, 4096, 256), (50, 20, 10)])
def test_bpe_equals_the_library(monkeypatch, library, slice_, block, longest):
    for name, value in (("SLICE", slice_), ("BLOCK", block), ("LONGEST", longest)):
        monkeypatch.setattr(bpe_stream, name, value)
    e, r = bpe_stream.Encoder(PATH), random.Random(3)
    letters = "abcdefgh'!é1 ́日\U0001f602<|>ΣIİ\x1cᆨ가" + "abcdefghijkl" * 2
    texts = ODD + ["".join(r.choice(letters if r.random() < 0.9 else "ab ") for _ in range(r.randrange(1, 400))) for _ in range(600)]
    for text, written in zip(texts, e.all_written(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        parts = list(written)
        assert "".join(i for i, _ in parts)[1:] == " ".join(map(str, want))
        assert "".join(n for _, n in parts)[1:] == library.decode(want, skip_special_tokens=False)
        assert [i for some in e.ids(text) for i in some] == want


@pytest.mark.parametrize("text", ["a" * 30_000, "the" * 10_000, "\U0001f602" * 8_000, "é!1'" * 5_000, "!?" * 9_000 + "'s", " " * 1_000_000 + "x", "\n\t " * 300_000])
def test_long_words(monkeypatch, library, text):
    monkeypatch.setattr(bpe_stream, "SLICE", 5_000)
    e = bpe_stream.Encoder(PATH)
    assert [i for some in e.ids(text) for i in some] == library.encode(text, add_special_tokens=False).ids


def test_transducer_emits_what_is_final_and_holds_a_block():
    """On small rule lists of many shapes: what is emitted early is what the whole piece has."""
    r = random.Random(9)
    for _ in range(150):
        tokens, rank = list("abc"), {}
        for _ in range(r.randrange(1, 12)):
            u, v = r.choice(tokens), r.choice(tokens)
            if u + v not in tokens:
                rank[u, v] = len(rank)
                tokens.append(u + v)
        rules = bpe_stream.Rules.__new__(bpe_stream.Rules)
        rules.rank, rules.lookahead, rules.id_of = rank, bpe_stream.Rules.sufficient(rank), {t: k for k, t in enumerate(tokens)}
        rules.id_of |= {chr(ord(c) + bpe_stream._LAST): 1000 + k for k, c in enumerate("abc")}
        text = "".join(r.choice("abc") for _ in range(300))
        t = bpe_stream.Transducer(rules, 8)
        got, most = [], 0
        for c in text:
            for some in t.push(c):
                got += some
            most = max(most, len(t.held))
        whole = rules.word(text)
        assert got + t.finish() == whole
        assert most <= 8 + 1 + rules.lookahead + max(map(len, tokens))


def test_rules_in_another_order_have_no_bound():
    assert bpe_stream.Rules.sufficient({("ab", "c"): 0, ("a", "b"): 1}) is None
    assert bpe_stream.Rules.sufficient({("a", "b"): 0, ("ab", "ab"): 1}) >= 2


def test_decoder_gives_text_at_once(library):
    e = bpe_stream.Encoder(PATH)
    text = "café 日本 \U0001f602\U0001f602 it's <|endoftext|>over"
    d = bpe_stream.Decoder(e.rules)
    out = "".join(d.push([i]) for some in e.ids(text) for i in some) + d.finish()
    assert out == "café 日本 \U0001f602\U0001f602 it 's <|endoftext|>over "
    d = bpe_stream.Decoder(e.rules)
    first = [i for some in e.ids("日") for i in some][:1]
    assert d.push(first) + d.finish() in ("日 ", "�")


def test_digests(spark, library):
    texts = [*ODD, None, "word " * 30_000, "word " * 30_000]
    df = spark.createDataFrame([(k or None, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")
    want = []
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((k or None, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(rows(bpe_stream.digests(df, PATH)), key=str) == sorted(want, key=str)
    assert bpe_stream.digests(df.limit(0), PATH).count() == 0
    back = dict(rows(bpe_stream.decode(bpe_stream.encode(df, PATH), PATH, named=True)))
    assert all(back[k or None] == library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for k, t in enumerate(texts))


# -- 13 ----------------------------------------------------------------------------------------


def plain_codes(vectors, entries=16, rounds=6):
    """vectors: (id, label, components). Everything one by one, in Python's integers."""
    q = [(i, label, [math.floor(4096 * x) for x in v]) for i, label, v in vectors]
    q.sort(key=lambda x: (x[0] is None, x[0], x[2]))
    w = len(q[0][2]) // 8
    part = lambda v, p: v[p * w : (p + 1) * w]
    books = [[part(v, p) for _, _, v in q[:entries]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v, p: min((far(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        found = [[nearest(v, p)[1] for _, _, v in q] for p in range(8)]
        for p in range(8):
            for k in range(len(books[p])):
                mine = [part(v, p) for (_, _, v), f in zip(q, found[p], strict=True) if f == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], Counter()
    for i, label, v in q:
        found = [nearest(v, p) for p in range(8)]
        error = sum(f for f, _ in found)
        sums[label] += error
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), error))
    return [(i, code, error, sums[label], sha) for i, label, code, error in out]


def vectors_of(n, seed=1):
    r = np.random.default_rng(seed)
    x = np.round(r.standard_normal((n, 24)), 1 if seed % 2 else 6).astype(np.float32)
    x[10:20] = x[n // 3]
    return [(k, None if k % 7 == 0 else k % 3, [float(c) for c in v]) for k, v in enumerate(x)]


@pytest.mark.parametrize("n, seed", [(250, 1), (250, 2), (9, 3), (1, 4)])
def test_codes(spark, n, seed):
    vectors = vectors_of(n, seed)
    vectors += [(vectors[-1][0], 1, vectors[0][2]), (None, 2, vectors[0][2]), (2, 2, [0.0] * 24)]
    bad = [(500, 1, None), (501, 1, [float("nan")] * 24), (502, 1, [1.0] * 23 + [float("inf")]), (503, 1, [None] * 24), (504, 1, [])]
    df = spark.createDataFrame([(*v, "x", "y") for v in vectors + bad], "vec_id long, label int, embedding array<float>, code string, error string").repartition(3)
    assert sorted(rows(vector_codes.compress(df)), key=str) == sorted(plain_codes(vectors), key=str)


def test_codes_of_odd_tables(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1, [1.0] * 16), (2, 1, [1.0] * 24), (3, 1, [2.0] * 9)], "vec_id long, label int, embedding array<double>")
    assert [r[0] for r in rows(vector_codes.compress(df))] == [1]
    assert rows(vector_codes.compress(df.limit(0))) == []
    with pytest.raises(OverflowError):
        vector_codes.compress(spark.createDataFrame([(1, 1, [1e12] * 16)], df.schema))
    monkeypatch.setattr(vector_codes, "LABELS", 0)
    vectors = vectors_of(60)
    assert sorted(rows(vector_codes.compress(spark.createDataFrame([(i, label, v) for i, label, v in vectors], df.schema))), key=str) == sorted(plain_codes(vectors), key=str)


def test_tree_equals_looking_at_all():
    r = np.random.default_rng(7)
    for n in (1, 2, 3, 5, 16, 40):
        for spread in (3, 50_000):
            entries, x = r.integers(-spread, spread, (n, 4)), r.integers(-spread, spread, (500, 4))
            far = ((x[:, None] - entries[None]) ** 2).sum(2)
            index, best = vector_codes.Tree(entries).nearest(x)
            assert (index == far.argmin(1)).all() and (best == far.min(1)).all()
    near = np.concatenate([r.integers(-50, 50, (200, 4)) + 100_000 * k for k in range(8)])
    tree, met = vector_codes.Tree(near[::100]), []
    real = tree._meet
    tree._meet = lambda entry, x, rows: (met.append(len(rows)), real(entry, x, rows))[1]
    tree.nearest(near)
    assert sum(met) < len(near) * 16 / 2  # most entries are never compared with
