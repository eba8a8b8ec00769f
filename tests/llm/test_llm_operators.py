"""The operators against brute force, exact round trips and held-out accuracy, and on odd rows."""

import random
import zlib

import brute
import numpy as np
import pytest

from statuta.llm import common, embedding_dedup, graph_ann, html_crf, katz_lm, mixing, ngram_join, piece_lattice, quality_cnn, token_counts, training_order

DOCS = "doc_id long, text string, source string, lang string, n_shingles string, _score string"
ODD = [
    (1, None, None, "x", "a", "b"),
    (2, "", "s1", "x", "a", "b"),
    (3, "  \t\n ", "s1", "x", "a", "b"),
    (4, "one", "s2", "x", "a", "b"),
    (4, "one", "s2", "x", "a", "b"),
    (None, "one two three four five six", "s2", "x", "a", "b"),
    (6, "One TWO three\x0bfour five six", None, None, None, None),
    (7, "日本語 😀 ▁ \x00 é" * 3, "ñ", "x", "a", "b"),
    (8, "word " * 30_000, "s3", "x", "a", "b"),
    (9, "x" * 5000, "s3", "x", "a", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with copies, near copies and shared passages."""
    r = random.Random(3)
    vocabulary = ["w%d" % k for k in range(400)]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, rows = say(40), []
    for k in range(160):
        w = say(r.choice((3, 12, 60, 120)))
        if k % 9 == 0:
            w[5:5] = passage
        rows.append(w)
    base = say(200)
    for _ in range(40):  # copies of one text, with a few words changed
        w = list(base)
        for _ in range(r.choice((0, 1, 2, 3, 5))):
            w[r.randrange(200)] = r.choice(vocabulary)
        rows.append(w)
    rows += [list(w) for w in rows[:10]]
    r.shuffle(rows)
    docs = [(k, " ".join(w), "s%d" % (k % 5 if k % 3 else 0), "en", "", "") for k, w in enumerate(rows)]
    return spark.createDataFrame(docs, DOCS).repartition(7).cache()


def plain(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


# -- shared ------------------------------------------------------------------------------------


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    got = dict(common.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    want = brute.least_reachable({x for p in pairs for x in p}, pairs)
    assert all(got.get(k, k) == v for k, v in want.items())
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    keys = spark.createDataFrame([(2,), (7,)], "k long")
    assert plain(common.only(df, "k", keys), "v") == plain(common.only(df, "k", keys, most=0), "v") == [("b",)]
    assert common.only(df, "k", keys.where("k > 9")).count() == 0


# -- 1 -----------------------------------------------------------------------------------------


def test_embeddings(spark):
    r = np.random.default_rng(2)
    x = r.standard_normal((300, 16))
    for k in range(100, 200):
        x[k] = x[k % 10] + r.standard_normal(16) * 0.12
    x[200:240] = x[0]
    rows = [(k, [float(c) for c in v], 1) for k, v in enumerate(x.astype(np.float32))]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [1.0] * 15, 1), (904, [], 1), (905, [1.0, 2.0], 1), (906, [None] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    got = {k[0]: k[1:] for k in plain(embedding_dedup.near_duplicates(df), "id", "n_links", "component_id", "kept")}
    y = x.astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1)[:, None]
    links = np.argwhere(np.triu(y @ y.T >= 0.9, 1))
    top = brute.least_reachable(range(300), links.tolist())
    degree = np.bincount(links.ravel(), minlength=300)
    assert all(got[k] == (degree[k], top[k], top[k] == k) for k in range(300))
    assert all(got[k] == (0, k, True) for k in range(900, 907))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_large_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MOST", 16)
    r = np.random.default_rng(4)
    centre = r.standard_normal(8)
    rows = [(k, [float(c) for c in centre + 0.05 * r.standard_normal(8)]) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicates(df).collect()
    assert {(g.n_links, g.component_id) for g in got} == {(119, 0)}


# -- 2 -----------------------------------------------------------------------------------------


def test_mixing(spark, corpus):
    got = mixing.mix(corpus).toPandas()
    assert (got.taken <= 3 * got["size"]).all() and (got.taken % got["size"].clip(lower=1) == 0).all()
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"), of=("source_size", "first"))
    assert (by["size"] == by.of).all() and abs(by.target.sum() - by["size"].sum()) < 1e-6
    assert ((by.taken - by.target).abs() <= by.most).all() and (by.target <= 3 * by["size"] + 1e-9).all()
    again = mixing.mix(corpus.repartition(3)).toPandas()
    assert got.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1), ("c", 100), (None, 5)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.water_filling(sizes).collect()}
    # weights 1, 2, 3, 1: b and null stop at three times their size, then a at its, c takes the rest
    total, free = 116.0, {"a": (10, 1), "b": (1, 2), "c": (100, 3), None: (5, 1)}
    want: dict = {}
    while True:
        level = (total - sum(want.values())) / sum(w for k, (_, w) in free.items() if k not in want)
        over = [k for k, (s, w) in free.items() if k not in want and level * w >= 3 * s]
        if not over:
            break
        want |= {k: 3.0 * free[k][0] for k in over}
    want |= {k: level * w for k, (_, w) in free.items() if k not in want}
    assert got == pytest.approx(want)


def test_mixing_odd_rows(odd, nothing):
    got = {tuple(r) for r in mixing.mix(odd).select("doc_id", "size", "source_size").collect()}
    assert {(1, 0, 6), (2, 0, 0), (3, 0, 0), (4, 1, 8), (6, 6, 6), (8, 30000, 30001), (9, 1, 30001)} <= got
    assert mixing.repeat(odd).columns == odd.columns and mixing.mix(nothing).count() == 0 and mixing.repeat(nothing).count() == 0


# -- 3 -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(training_order.feistel(np.arange(n), n, 7).tolist()) == list(range(n))


def test_training_order(spark, odd, nothing, tmp_path):
    path, folder = token_counts.tokenizer_path("byte_bpe_50k.tiktoken"), f"file://{tmp_path}/shards"
    got = training_order.materialise(odd.repartition(3), folder, path, seq_len=64, per_shard=50).toPandas()
    assert sorted(got.slot) == list(range(len(got)))
    records = list(training_order.read(folder, 0, len(got), 64, 50))
    assert all(zlib.crc32(records[r.slot].tobytes()) == r.crc and r.byte_offset == r.slot % 50 * 128 for r in got.itertuples())
    assert np.array_equal(next(training_order.read(folder, 73, 1, 64, 50)), records[73])
    encode = training_order.encoder(path)
    for k in (1, 2, 7, 8, 9):
        mine = got[got.doc_id == k].sort_values("seq")
        ids = np.concatenate([records[s][:n] for s, n in zip(mine.slot, mine.n_tokens, strict=True)])
        text = next(t for i, t, *_ in ODD if i == k) or ""
        assert ids.tolist() == [*encode(text).tolist(), training_order.END]
    assert training_order.materialise(nothing, f"file://{tmp_path}/none", path).count() == 0


# -- 4 -----------------------------------------------------------------------------------------


def test_segmentation(odd, nothing):
    path = token_counts.tokenizer_path("piece_bpe_32k.model")
    got = piece_lattice.encode(odd, path)
    assert got.where("not _lossless").count() == 0 and got.columns[: len(odd.columns)] == odd.columns
    back = piece_lattice.decode(got, path).select("text", "_text").collect()
    assert all((r.text or "") == r._text for r in back)
    assert plain(got, "doc_id", "_ids") == plain(piece_lattice.encode(odd.repartition(5), path), "doc_id", "_ids")
    assert piece_lattice.encode(nothing, path).count() == 0


def test_sampling_follows_the_lattice():
    m = piece_lattice.Lattice(token_counts.tokenizer_path("piece_bpe_32k.model"))

    def ways(s):
        if not s:
            yield (), 1.0
        for n in range(1, len(s) + 1):
            if (i := m.ids.get(s[:n])) is not None:
                for rest, p in ways(s[n:]):
                    yield (i, *rest), p * m.weight[i]

    share = dict(ways(" other"))
    total = sum(share.values())
    seen = [tuple(x.tolist()) for x in m.encode(["other"] * 20_000, np.arange(20_000))]
    for way, p in sorted(share.items(), key=lambda x: -x[1])[:3]:
        assert seen.count(way) / 20_000 == pytest.approx(p / total, abs=0.01)


# -- 5 -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def crf():
    return html_crf.fit(html_crf.labelled_pages(250))


def test_held_out_pages(crf):
    right = blocks = 0
    for source in html_crf.labelled_pages(100, seed=99):
        page = html_crf.parse(source)
        labels = html_crf.viterbi(html_crf.emissions(page, crf), crf)
        right += sum(y == (b.gold or 0) for y, b in zip(labels, page.blocks, strict=True))
        blocks += len(labels)
    assert right / blocks > 0.98


def test_viterbi_is_the_best_path():
    import itertools

    m = {"0>0": 0.3, "1>1": 0.5, "0>1": -0.4, "1>0": -0.2}
    r = random.Random(1)
    for _ in range(20):
        e = [r.uniform(-1, 1) for _ in range(7)]
        value = lambda y, e=e: sum(x for x, k in zip(e, y, strict=True) if k) + sum(m[f"{a}>{b}"] for a, b in zip(y, y[1:]))
        assert value(html_crf.viterbi(e, m)) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=7))))


def test_pages(spark, crf):
    article = "<h1>A &amp; B</h1><p>First  line,\n of <b>some</b> text here.<script>x</script></p><p>Second one, with more words in it.<br>Third &eacute;.</p>"
    page = f"<html><head><title>T</title></head><body><nav><a href=1>home</a></nav><!-- x --><article>{article}</article><footer>&copy; us</footer></body>"
    rows = [(1, "u", page, "k"), (2, "u", None, "k"), (3, "u", "", "k"), (4, "u", "<<p <b", "k"), (1, "u", page, "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r._text, r._n_chars) for r in html_crf.extract(df, crf).collect()}
    text = "A & B First line, of some text here. Second one, with more words in it. Third é."
    assert (1, text, len(text)) in got and (2, "", 0) in got and (3, "", 0) in got
    assert html_crf.extract(df.limit(0), crf).count() == 0


# -- 6 -----------------------------------------------------------------------------------------


def test_katz(spark, corpus, odd, nothing):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    want, conditional, counts = brute.katz(rows)
    for chunk in (500, 10**6):
        got = {r.doc_id: tuple(r)[1:] for r in katz_lm.score(corpus, chunk_tokens=chunk).collect()}
        assert got.keys() == want.keys()
        for k, w in want.items():
            assert got[k][:4] == w[:4] and got[k][4:] == pytest.approx(w[4:], rel=1e-9)
    for v in (("w1",), ("w7",), (1,), ("unseen",), ("w1", "w7"), (1, "w3"), tuple(rows[0][1].split()[:2])):
        assert sum(conditional(v, w) for w in counts) + conditional(v, "another") == pytest.approx(1)
    assert katz_lm.score(odd).count() == len(ODD) and katz_lm.score(nothing).count() == 0


# -- 7 -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (2, 60)])
def test_ngram_join(spark, corpus, n, num):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    sizes, top = brute.jaccard_components(rows, n, num, 100)
    got = {r[0]: tuple(r)[1:] for r in ngram_join.ngram_join(corpus, n, num, 100).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == {k: (sizes[k], top[k]) for k in sizes}
    kept = sorted(r.doc_id for r in ngram_join.keep_one(corpus, n, num, 100).collect())
    assert kept == sorted(k for k, v in top.items() if k == v)


def test_ngram_blocks_are_cut(spark, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "FEW_PAIRS", 0)
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    top = brute.jaccard_components(rows, 4, 85, 100)[1]
    assert dict(ngram_join.ngram_join(corpus, 4, 85, 100).select("doc_id", "component_id").collect()) == top


def test_ngram_odd_rows(odd, nothing):
    got = plain(ngram_join.ngram_join(odd, 4, 85, 100), "doc_id", "n_shingles", "component_id")
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (None, 3, 6), (6, 3, 6), (8, 1, 8), (9, 1, 9)} <= set(got) and len(got) == len(ODD)
    kept = ngram_join.keep_one(odd, 4, 85, 100)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    assert ngram_join.ngram_join(nothing).count() == 0 and ngram_join.keep_one(nothing).count() == 0


# -- 8 -----------------------------------------------------------------------------------------


def test_neighbours(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((1500, 12)) * r.uniform(0.5, 2, (1500, 1))
    x[100:140] = x[60]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)] + [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = graph_ann.search(df, 20, graph_ann.F.col("id") % 20 == 0, shard_size=400).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21)) and np.allclose(g.score, s[g.vec_id], rtol=1e-12)
        assert (np.diff(g.score) <= 0).all()
        hit += len(set(want) & set(g.vec_id))
    assert got.query_id.nunique() == 75 and hit / (75 * 20) > 0.97
    few = graph_ann.search(df.where("vec_id < 5"), 20, graph_ann.F.col("id") % 20 == 0)
    assert few.count() == 4 and graph_ann.search(df.limit(0), 20).count() == 0


# -- 9 -----------------------------------------------------------------------------------------


def test_token_counts(spark, corpus, odd, nothing):
    from tokenizers import Tokenizer

    path = token_counts.tokenizer_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    strange = [(20, "it's I'LL don't\x1cSTOP <|endoftext|> a<|startoftext|>b"), (21, "ΣΑΣ İ ﬁ é  x y​z"), (22, "1234 ++ --- ...!?")]
    rows = [(i, s) for i, s, *_ in ODD] + strange
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((i, len((s or "").encode()), len(t.encode(s or "", add_special_tokens=False).ids)) for i, s in rows), key=str)
    assert plain(token_counts.token_counts(df, path), "doc_id", "n_bytes", "n_tokens") == want
    assert plain(token_counts.token_counts(df, path, table_entries=2, cache_bytes=300), "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.token_counts(nothing, path).count() == 0
    pieces = token_counts.token_counts(df.where("doc_id < 8"), token_counts.tokenizer_path("piece_bpe_32k.model"))
    assert pieces.where("n_tokens > 0").count() > 0


# -- 10 ----------------------------------------------------------------------------------------


def test_gradient():
    r = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in quality_cnn.initial().items()}
    texts, y = [r.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 5, 130, 700, 1500)], np.array([0, 1, 0, 1, 1.0])

    def loss():
        p = quality_cnn.score_texts(m, texts)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    g = quality_cnn._gradient(m, texts, y, np.ones(5))
    for name in ("conv", "conv_b", "dense", "out", "out_b"):
        at = tuple(r.integers(0, n) for n in m[name].shape)
        old = m[name][at]
        m[name][at] = old + 1e-5
        high = loss()
        m[name][at] = old - 1e-5
        low = loss()
        m[name][at] = old
        assert (high - low) / 2e-5 == pytest.approx(g[name][at], abs=2e-4, rel=0.05)


def test_long_texts_are_scored_whole():
    m = quality_cnn.initial()
    r = np.random.default_rng(1)
    text = r.integers(0, 256, 128 * (quality_cnn.BLOCK + 40) + 3).astype(np.uint8).tobytes()
    whole = quality_cnn.pooled(m, text)
    assert not np.allclose(whole, quality_cnn.pooled(m, text[:-600]), atol=1e-7)
    old, quality_cnn.BLOCK = quality_cnn.BLOCK, 10**6
    try:
        assert np.allclose(whole, quality_cnn.pooled(m, text), atol=1e-5)
    finally:
        quality_cnn.BLOCK = old


def test_classifier(spark, odd, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_cnn.train(docs, labels)
    got = quality_cnn.classify(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(quality_cnn.remainder("doc_id", 5) == 0).select("_predicted", "quality").collect()
    assert sum(r._predicted == r.quality for r in got) / len(got) > 0.9
    scored = quality_cnn.classify(odd, model)
    assert scored.where("_score between 0 and 1").count() == len(ODD)
    none = quality_cnn.train(docs, labels.limit(0))
    assert quality_cnn.classify(nothing, none).count() == 0


# -- the pipeline --------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = P.quality(spark, docs, sf).cache()
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    one = P.near_duplicates(spark, kept, sf).cache()
    top = brute.jaccard_components([(r.doc_id, r.text) for r in kept.collect()], 5, 80, 100)[1]
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted(k for k, v in top.items() if k == v)
    mixed = P.mixture(spark, one, sf).cache()
    copies = dict(mixed.groupBy("doc_id").count().collect())
    assert mixed.columns == columns and copies == {r.doc_id: r.copies for r in mixing.mix(one).collect() if r.copies}
    out = P.pieces(spark, mixed, sf)
    assert out.count() == mixed.count() and out.where("not lossless").count() == 0
