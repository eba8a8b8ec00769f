"""The classifier's forward pass as plain loops; caches bounded by bytes."""

import numpy as np
from tokenizers import Tokenizer

from statuta.llm import quality_cnn as q
from statuta.llm import token_counts


def plain_score(m, text):
    """One window, one chunk, one filter at a time."""
    starts = [0]
    while starts[-1] + q.WIDTH < len(text):
        starts.append(starts[-1] + q.STRIDE)
    seen = []
    for s in starts:
        x = [c for k in range(q.WIDTH) for c in m["embed"][text[s + k] if s + k < len(text) else 0]]
        seen.append([max(0.0, sum(a * b for a, b in zip(x, m["conv"][:, f], strict=True)) + m["conv_b"][f]) for f in range(q.FILTERS)])
    halves = [seen[k : k + q.HALF] for k in range(0, len(seen), q.HALF)]
    hidden = []
    for k in range(max(1, len(halves) - 1)):
        rows = halves[k] + (halves[k + 1] if k + 1 < len(halves) else [])
        top = [max(r[f] for r in rows) for f in range(q.FILTERS)]
        if len(rows) < q.HALF:
            top = [max(t, 0.0) for t in top]
        feats = [*top, *(sum(r[f] for r in rows) / len(rows) for f in range(q.FILTERS)), len(rows) / (2 * q.HALF)]
        hidden.append([max(0.0, sum(a * b for a, b in zip(feats, m["dense"][:, h], strict=True)) + m["dense_b"][h]) for h in range(q.HIDDEN)])
    both = [max(h[k] for h in hidden) for k in range(q.HIDDEN)] + [sum(h[k] for h in hidden) / len(hidden) for k in range(q.HIDDEN)]
    return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(both, m["out"], strict=True)) + m["out_b"][0])))


def test_scores_equal_plain_loops():
    r = np.random.default_rng(3)
    m = {k: (v + r.standard_normal(v.shape) * 0.05).astype(np.float64) for k, v in q.initial().items()}
    texts = [r.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 7, 8, 9, 12, 13, 127, 128, 132, 133, 260, 700, 1500)]
    for text, score in zip(texts, q.score_texts(m, texts), strict=True):
        assert abs(score - plain_score(m, text)) < 1e-6


def test_long_words_are_counted_and_not_kept(spark):
    path = token_counts.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["x" * 3000 + " short", "y" * 65 + " " + "z" * 64, "short " * 50, "\U0001f602" * 100]
    cache = token_counts.Cache()
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.count_texts(texts, path, {}, cache) == want
    assert set(cache) == {"short", "z" * 64} and cache.size < 600
    assert token_counts.count_texts(texts, path, {}, cache, cache_bytes=0) == want and cache.size < 600
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts.token_counts(df, path).collect()) == list(enumerate(want))
