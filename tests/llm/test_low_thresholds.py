"""The n-gram join below a similarity of one half, where sizes that fit differ by more than a fold."""

import itertools

import numpy as np
import pytest

from statuta.llm import ngram_join


@pytest.mark.parametrize(("num", "den"), [(1, 10), (20, 100), (1, 2), (80, 100)])
def test_products_find_what_may_link(num, den):
    r = np.random.default_rng(5)
    universe = np.unique(r.integers(0, 2**64 - 1, 4000, np.uint64, endpoint=True))
    sets = sorted((np.sort(r.choice(universe[: r.integers(200, 4000)], size=int(n), replace=False)) for n in r.integers(10, 200, 40)), key=len)
    folds, size = [ngram_join.folded(s) for s in sets], np.array([len(s) for s in sets])
    i, j, more = ngram_join.product(np.arange(len(sets)), size, None, folds, num, den, len(sets))
    want = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if ngram_join.may_link(folds[a], folds[b], len(sets[a]), len(sets[b]), num, den)}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and not more


def test_join_equals_brute_force(spark):
    r = np.random.default_rng(9)
    words = [f"w{k}" for k in range(40)]
    long = " ".join(r.choice(words, 200))
    docs = [(k, " ".join(long.split()[a : a + n])) for k, (a, n) in enumerate(zip(r.integers(0, 150, 60).tolist(), r.integers(3, 120, 60).tolist(), strict=True))]
    sets = {k: {tuple(t.split()[i : i + 4]) for i in range(max(1, len(t.split()) - 3))} for k, t in docs}
    least = {k: k for k in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 20 * len(sets[a] | sets[b]):
                least[a] = least[b] = min(least[a], least[b])
    got = ngram_join.ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), 4, 20, 100).collect()
    assert {x.doc_id: x.component_id for x in got} == least
