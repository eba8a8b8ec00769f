"""Repeated and missing ids, words without spaces, ties at a cut, groups of near misses: against plain versions."""

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from statuta.llm import embedding_dedup, graph_ann, katz_lm, mixing, ngram_join, piece_lattice, quality_cnn, token_counts, training_order

F = graph_ann.F


# -- 1 and 8: rows, not ids ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def repeated():
    """(id, vector): ids twice with equal, opposite and unrelated vectors, ties and a null id."""
    r = np.random.default_rng(8)
    x = r.standard_normal((60, 6)).round(3)
    rows = [(k, x[k]) for k in range(60)]
    rows += [(20, x[20]), (40, -x[40]), (0, x[7]), (None, x[3]), (61, x[20]), (62, x[20]), (62, x[20])]
    return rows


def neighbours(rows, k):
    """For each query row the ids and scores of its k nearest others."""
    out = []
    for a, (i, x) in enumerate(rows):
        if i is not None and i % 20 == 0:
            near = sorted((-float(np.dot(np.array(x, float), np.array(y, float))), j, b) for b, (j, y) in enumerate(rows) if b != a and j is not None)
            out.append((i, [(j, -s) for s, j, _ in near[:k]]))
    return out


def test_queries_are_rows(spark, repeated):
    df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in repeated], "vec_id long, embedding array<double>")
    got = graph_ann.search(df, 20, F.col("id") % 20 == 0, shard_size=50).collect()
    want = neighbours(repeated, 20)
    assert len(got) == 20 * len(want)
    assert Counter((r.query_id, r["rank"], r.vec_id) for r in got) == Counter((q, k, j) for q, near in want for k, (j, _) in enumerate(near, 1))
    scores = np.array(sorted((r.query_id, r.score) for r in got))
    assert np.allclose(scores, sorted((q, s) for q, near in want for _, s in near), rtol=1e-12)


def test_links_of_repeated_and_null_ids(spark, repeated):
    df = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in repeated], "vec_id long, embedding array<double>")
    got = Counter(tuple(r) for r in embedding_dedup.near_duplicates(df).collect())
    x = np.array([v for _, v in repeated])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    top = brute.least_reachable(range(len(x)), [(a, b) for a, b in np.argwhere(near).tolist() if a < b])
    want = []
    for a, (i, _) in enumerate(repeated):
        ids = [repeated[b][0] for b in range(len(x)) if top[b] == top[a] and repeated[b][0] is not None]
        least = min(ids, default=i)
        want.append((i, int(near[a].sum()) - 1, least, i is not None and i == least))
    assert got == Counter(want)


def test_signatures_keep_what_is_near():
    r = np.random.default_rng(3)
    x = r.standard_normal((4000, 64))
    noise = r.standard_normal((4000, 64))
    noise -= (noise * x).sum(1, keepdims=True) / (x * x).sum(1, keepdims=True) * x
    y = x + noise * (np.linalg.norm(x, axis=1) / np.linalg.norm(noise, axis=1) * np.sqrt(1 / 0.9**2 - 1))[:, None]  # cosine 0.9
    apart = np.bitwise_count(embedding_dedup.signatures(x) ^ embedding_dedup.signatures(y)).sum(1)
    assert apart.max() <= embedding_dedup.far(0.9)
    unrelated = np.bitwise_count(embedding_dedup.signatures(x[:2000]) ^ embedding_dedup.signatures(x[2000:])).sum(1)
    assert (unrelated <= embedding_dedup.far(0.9)).mean() < 0.002


# -- 2: null and repeated ids ------------------------------------------------------------------------

COLUMNS = "doc_id long, text string, source string, _early int, other string"


def test_cut_among_missing_and_repeated_ids(spark):
    rows = [(None, f"w{k} " * 10, "a", k, "x") for k in range(300)]
    rows += [(k % 2, f"v{k} " * 10, "b", k, "x") for k in range(300)]
    rows += [(k, "z " * 500, "c", k, "x") for k in range(30)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = mixing.mix(df).toPandas()
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    assert Counter(mixing.mix(df.repartition(2)).collect()) == Counter(mixing.mix(df).collect())
    mixed = mixing.repeat(df)
    assert mixed.columns == df.columns
    assert mixed.groupBy("source").count().orderBy("source").collect() == [tuple(r) for r in got.groupby("source").copies.sum().reset_index().values.tolist()]


def test_cut_among_equal_rows(spark):
    rows = [(None, "same text here", "a", 0, "x")] * 400 + [(k, "other words " * 40, "b", k, "y") for k in range(40)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = mixing.mix(df).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    assert 0 < (got[got.source == "a"].copies != got[got.source == "a"].copies.min()).sum() < 400
    assert Counter(mixing.mix(df.repartition(3)).collect()) == Counter(mixing.mix(df).collect())
    assert mixing.repeat(df).count() == got.copies.sum()


# -- 4: words without spaces --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lattice():
    return piece_lattice.Lattice(token_counts.tokenizer_path("piece_bpe_32k.model"))


def test_blocks_agree_with_whole_lattices(lattice, monkeypatch):
    r = random.Random(2)
    texts = ["abcdefghij" * 30 + "x" * 500 + "日本" + "thequick" * 40, "x" * 3000, "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(2000)), "é😀ع" * 300, ""]
    keys = np.arange(len(texts))
    whole = lattice.encode(texts, keys)
    monkeypatch.setattr(piece_lattice, "BLOCK", 64)
    assert [x.tolist() for x in lattice.encode(texts, keys)] == [x.tolist() for x in whole]
    assert [lattice.decode(x).decode() for x in whole] == texts


def test_cuts_are_where_no_piece_lies(lattice):
    word = "theorderofthings日本語xyz" * 3
    cut = set(lattice._cuts([word, "b" + word])[0].tolist())
    across = {k for i in range(len(word)) for n in range(2, lattice.longest + 1) if word[i : i + n] in lattice.ids and i + n <= len(word) for k in range(i + 1, i + n)}
    assert cut == set(range(len(word) + 1)) - across


def test_long_words_are_sampled_alike(lattice, monkeypatch):
    """The same shares whether a word is cut or not."""
    word = "日" + "other" + "本"
    seen = Counter(tuple(x.tolist()) for x in lattice.encode([word] * 20_000, np.arange(20_000)))
    monkeypatch.setattr(piece_lattice, "LONG", 3)
    cut = Counter(tuple(x.tolist()) for x in lattice.encode([word] * 20_000, np.arange(20_000)))
    for way, n in seen.most_common(4):
        assert cut[way] / 20_000 == pytest.approx(n / 20_000, abs=0.015)


# -- 7: near misses, and a centre that links with nothing -----------------------------------------------


def test_rounds_until_nothing_is_held_back(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTNERS", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 9)
    monkeypatch.setattr(ngram_join, "FREQUENT_LOCAL", 2)
    monkeypatch.setattr(ngram_join, "HOT", 5)
    r = random.Random(6)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for group in range(6):
        base = r.sample(words, 150)
        for k in range(22):
            w = list(base)
            for _ in range(r.choice((0, 3, 5, 7, 9))):
                w[r.randrange(150)] = r.choice(words)
            rows.append((100 * group + k, " ".join(w)))
    rows += [(None, rows[0][1]), (5000, rows[0][1]), (5000, "other words entirely in this one here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes, top = brute.jaccard_components([(k, t) for k, (_, t) in enumerate(rows)], 4, 85, 100)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top[j] == top[k] and rows[j][0] is not None]
        want.append((i, sizes[k], min(ids, default=i)))
    got = ngram_join.ngram_join(df, 4, 85, 100).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_folded_rows_bound_the_overlap():
    r = np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[: int(r.integers(0, len(a) + 1))], r.integers(0, 2**63, int(r.integers(1, 400)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert ngram_join.may_link(ngram_join.folded(a), ngram_join.folded(b), len(a), len(b), 85, 100)
    # few buckets: every count above the planes
    over, planes = ngram_join.rows_of([ngram_join.folded(np.arange(64, dtype=np.uint64))])
    assert over[0] == 64 - ngram_join.PLANES and int(np.bitwise_count(planes).sum()) == ngram_join.PLANES


def test_equal_rows_leave_one(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a")] * 5 + [(None, text, None)] * 3 + [(2, text + " eight", "a"), (3, "", "b"), (3, "", "b"), (4, None, "b")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(3))
    assert Counter(map(tuple, kept.collect())) == Counter([(1, text, "a"), (2, text + " eight", "a"), (3, "", "b"), (3, "", "b"), (4, None, "b")])


# -- 9, 10 -------------------------------------------------------------------------------------------------


def test_frequent_words_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "TASK_WORDS", 50)
    rows = [(f"rare{k} common",) for k in range(400)] + [("late late",)] * 300
    path = token_counts.tokenizer_path("word_bpe_49k.json")
    table = token_counts._frequent(spark.createDataFrame(rows, "text string").repartition(3), path, 2)
    assert set(table) == {"common", "late"}


def test_training_sample_of_repeated_ids(spark):
    docs = spark.createDataFrame([(k % 40, f"{'good' if k % 2 else 'bad'} text {k}") for k in range(400)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, 1), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    seen = []
    old, quality_cnn.fit = quality_cnn.fit, lambda texts, y, seed: seen.append((texts, y))
    try:
        quality_cnn.train(docs, labels)
    finally:
        quality_cnn.fit = old
    texts, y = seen[0]
    assert 20 < len(texts) == len(set(texts)) <= 40
    assert all((t.startswith(b"good")) == bool(label) for t, label in zip(texts, y))


# -- 6: odd rows, and contexts that Good-Turing leaves nothing --------------------------------------------


def test_katz_of_odd_and_repeated_rows(spark):
    text = "the same words again and again " * 12
    rows = [(None, "one two one two"), (5, None), (5, ""), (5, " \t"), (9, "日本 \x00 日本"), (9, "日本 \x00 日本"), (None, text), (11, text), (12, "new words " * 9)]
    rows += [(k, "a b") for k in range(100, 140)]  # a is followed by b, more often than K times
    rows += [(k, "a c b a") for k in range(200, 203)] + [(k, "x y x z") for k in range(300, 302)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, conditional, counts = brute.katz([(k, t) for k, (_, t) in enumerate(rows)], held={k for k, (i, _) in enumerate(rows) if i is not None and zlib.crc32(str(i).encode()) % 7 == 2})
    for chunk in (20, 10**6):
        got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz_lm.score(df, chunk_tokens=chunk).collect())
        assert got == Counter((rows[k][0], *w[:4], round(w[4], 6), round(w[5], 6)) for k, w in want.items())
    for v in (("a",), ("again",), (1,), ("unseen",), (1, "a"), ("a", "b"), ("words", "again"), ("x", "y")):
        assert sum(conditional(v, w) for w in counts) + conditional(v, "another") == pytest.approx(1)


def test_katz_where_every_count_is_large(spark):
    """Nothing is discounted: all counts lose the tail, and unknown words keep a probability."""
    rows = [(k, "a b a b") for k in range(60)] + [(1000 + k, "a q") for k in range(30) if zlib.crc32(str(1000 + k).encode()) % 7 == 2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, conditional, counts = brute.katz(rows)
    got = {r.doc_id: r.score for r in katz_lm.score(df).collect()}
    assert got == pytest.approx({k: w[5] for k, w in want.items()}, rel=1e-9)
    for v in (("a",), ("b",), (1,), ("a", "b"), (1, "a")):
        assert sum(conditional(v, w) for w in counts) + conditional(v, "another") == pytest.approx(1)


# -- 3: the order itself ------------------------------------------------------------------------------------


def test_slots_are_the_networks(spark, tmp_path):
    path = token_counts.tokenizer_path("byte_bpe_50k.tiktoken")
    rows = [(k, "some words of a text " * (k * 7 % 60)) for k in range(80)] + [(3, "a repeated id"), (None, "no id " * 90), (80, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).orderBy(F.spark_partition_id())
    got = training_order.materialise(df, f"file://{tmp_path}/shards", path, seq_len=16, per_shard=64).collect()
    encode, want, number = training_order.encoder(path), {}, 0
    records = []
    for k, text in [tuple(r) for r in df.collect()]:
        ids = [*encode(text or "").tolist(), training_order.END]
        for seq, at in enumerate(range(0, len(ids), 16)):
            records.append((k, seq, (ids[at : at + 16] + [training_order.END] * 16)[:16], min(16, len(ids) - at)))
    for number, (k, seq, ids, n) in enumerate(records):
        want[brute.slot(number, len(records), training_order.KEY)] = (k, seq, n, zlib.crc32(np.array(ids, "<u2").tobytes()))
    assert {r.slot: (r.doc_id, r.seq, r.n_tokens, r.crc) for r in got} == want
    assert [r.tolist() for r in training_order.read(f"file://{tmp_path}/shards", 0, len(records), 16, 64)] == [records[n][2] for n in np.argsort([brute.slot(k, len(records), training_order.KEY) for k in range(len(records))])]


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 300])
def test_network(n):
    assert training_order.feistel(np.arange(n), n, 99).tolist() == [brute.slot(k, n, 99) for k in range(n)]
