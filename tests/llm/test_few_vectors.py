"""Fewer distinct vectors than the search expands together."""

import pytest

from statuta.llm import graph_ann

SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("n", [1, 2, 3])
def test_one_to_three_vectors(spark, n):
    df = spark.createDataFrame([(i, [1.0 + i, 1.0]) for i in range(n)], SCHEMA)
    got = sorted(tuple(r) for r in graph_ann.search(df, 20).collect())
    want = []
    for q in range(n):
        best = sorted((-((1.0 + q) * (1.0 + i) + 1.0), i) for i in range(n) if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert got == want


def test_copies_of_one_vector(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], SCHEMA)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in graph_ann.search(df, 3).collect()}
    assert got == {(q, k + 1): (i, 5.0) for q in range(6) for k, i in enumerate([i for i in range(6) if i != q][:3])}


def test_a_query_of_odd_length(spark):
    rows = [(i, [float(i % 7) + 1, float(i % 11), 1.0]) for i in range(60)] + [(100, [1.0, 1.0]), (101, [2.0, 1.0])]
    got = graph_ann.search(spark.createDataFrame(rows, SCHEMA), 5, graph_ann.F.col("id").isin(0, 100)).collect()
    assert [tuple(r) for r in got if r.query_id == 100] == [(100, 1, 101, 3.0)]
    assert sum(r.query_id == 0 for r in got) == 5
