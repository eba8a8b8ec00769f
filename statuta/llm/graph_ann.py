"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph in every shard.

Distinct vectors are dealt to shards of about ``shard_size`` by a hash. The
largest inner product becomes the nearest point by one more component,
sqrt(longest^2 - |x|^2). In each shard vectors are inserted in batches: greedy
beam searches on the graph so far propose neighbours, relaxed pruning (a
candidate goes when a kept neighbour is ``alpha`` times nearer to it than the
new vector) keeps at most ``degree`` diverse edges, and reverse edges are
pruned the same way. A shard's graph is one row of a stored table. Every block
of queries is sent to every shard, searched with a beam, and what the beam
holds is scored anew in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors
from .common import ship, stored

SHARD_SIZE = 8192
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 128, 1.2
#: Nodes expanded together in a step; queries searched together.
WIDE, TOGETHER = 4, 256
QUERY_BLOCK = 2048
SEED = 29


def beam_search(x: np.ndarray, graph: np.ndarray, start: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (rows, beam) of nodes near the rows of q, and -2 q.x + x.x (for the order); -1 and inf where there are fewer."""
    n, b, wide = len(x), len(q), min(WIDE, beam)
    norm = (x * x).sum(1)
    seen = np.zeros((b, n), bool)
    row = np.arange(b)
    ids = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, np.float32)
    s = min(len(start), beam)
    ids[:, :s] = start[:s]
    dist[:, :s] = norm[start[:s]] - 2 * (q @ x[start[:s]].T)
    seen[:, start[:s]] = True
    done = ids < 0
    live = row
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        pick = np.argpartition(open_, wide - 1, 1)[:, :wide]
        ok = np.isfinite(np.take_along_axis(open_, pick, 1))
        some = ok.any(1)
        live, pick, ok = live[some], pick[some], ok[some]
        if not len(live):
            break
        np.put_along_axis(d := done[live], pick, True, 1)
        done[live] = d
        near = np.where(ok[:, :, None], graph[np.take_along_axis(ids[live], pick, 1)], -1).reshape(len(live), -1)
        r = np.repeat(np.arange(len(live)), near.shape[1])
        flat = near.reshape(-1)
        new = (flat >= 0) & ~seen[live[r], flat]
        flat, r = flat[new], r[new]
        # the same node from two expanded ones counts once
        _, first = np.unique(r * n + flat, return_index=True)
        flat, r = flat[first], r[first]
        seen[live[r], flat] = True
        width = np.bincount(r, minlength=len(live))
        most = int(width.max()) if len(r) else 0
        if not most:
            continue
        col = np.arange(len(r)) - np.repeat(np.cumsum(width) - width, width)
        more = np.full((len(live), most), -1, np.int64)
        far = np.full((len(live), most), np.inf, np.float32)
        more[r, col] = flat
        far[r, col] = norm[flat] - 2 * np.einsum("nd,nd->n", x[flat], q[live[r]])
        all_ids = np.concatenate([ids[live], more], 1)
        all_dist = np.concatenate([dist[live], far], 1)
        all_done = np.concatenate([done[live], more < 0], 1)
        keep = np.argpartition(all_dist, beam - 1, 1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, keep, 1)
        dist[live] = np.take_along_axis(all_dist, keep, 1)
        done[live] = np.take_along_axis(all_done, keep, 1)
    return ids, dist


def prune(x: np.ndarray, p: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most degree of each row's candidates (-1: none), diverse: (rows, degree), -1 at the end."""
    c = np.where(cand == p[:, None], -1, cand)
    xs = x[c]  # of -1: any row; masked
    dist = ((xs - x[p][:, None]) ** 2).sum(2)
    dist[c < 0] = np.inf
    out = np.full((len(p), degree), -1, np.int64)
    row = np.arange(len(p))
    norm = (xs * xs).sum(2)
    left = dist.copy()
    for k in range(degree):
        best = left.argmin(1)
        ok = np.isfinite(left[row, best])
        if not ok.any():
            break
        out[ok, k] = c[row, best][ok]
        star = xs[row, best]
        between = norm + norm[row, best][:, None] - 2 * np.matmul(xs, star[:, :, None])[:, :, 0]
        left[alpha * alpha * between <= dist] = np.inf
        left[row, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(graph (n, degree), start nodes) over the rows of x."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    start = order[: min(n, 16)]
    at = 0
    while at < n:
        size = min(n - at, 256 if at == 0 else min(1024, at))
        for k in range(at, at + size, TOGETHER):
            p = order[k : min(k + TOGETHER, at + size)]
            if at == 0:
                cand = np.broadcast_to(order[:size], (len(p), size))
            else:
                cand, _ = beam_search(x, graph, start, x[p], beam)
            graph[p] = prune(x, p, cand, degree, alpha)
        _reverse(x, graph, order[at : at + size], degree, alpha)
        at += size
    return graph, start


def _reverse(x: np.ndarray, graph: np.ndarray, p: np.ndarray, degree: int, alpha: float) -> None:
    """Edges back from the neighbours of p; where there are too many, pruned."""
    to = graph[p].reshape(-1)
    back = np.repeat(p, degree)[to >= 0]
    to = to[to >= 0]
    d = ((x[to] - x[back]) ** 2).sum(1)
    order = np.lexsort((d, to))
    to, back = to[order], back[order]
    targets, first, count = np.unique(to, return_index=True, return_counts=True)
    rank = np.arange(len(to)) - np.repeat(first, count)
    keep = rank < degree  # the nearest new ones
    more = np.full((len(targets), degree), -1, np.int64)
    more[np.repeat(np.arange(len(targets)), count)[keep], rank[keep]] = back[keep]
    for k in range(0, len(targets), TOGETHER):
        t = targets[k : k + TOGETHER]
        both = np.concatenate([graph[t], more[k : k + TOGETHER]], 1)
        both.sort(1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        graph[t] = prune(x, t, both, degree, alpha)


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """float32 rows with the component that makes all equally long."""
    v = v.astype(np.float64) / longest
    extra = np.sqrt(np.maximum(0, 1 - (v * v).sum(1)))
    return np.concatenate([v, extra[:, None]], 1).astype(np.float32)


def search(rows: DataFrame, k: int, query: F.Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding", shard_size: int = SHARD_SIZE, beam: int = BEAM) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k rows of largest inner product found for every query.

    query: a condition on column ``id`` that says which rows are queries. A
    query's own row is no candidate. Ties go to the smaller id. Null, empty,
    zero and non-finite vectors take no part, nor do null ids; vectors of
    different length aren't compared. Repeated rows of an id are queries and
    candidates of their own: each has its own k rows, the others of its id
    among them where they are near. score: the inner product of the original
    vectors in double precision. Other columns are ignored. An empty
    table gives no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    members, found = vectors.classes(rows.where(F.col(id_column).isNotNull()), id_column, vector_column)
    kind = vectors.width(found)
    sizes = {r["dim"]: (-(-r["n"] // shard_size), r["longest"]) for r in found.groupBy("dim").agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("longest")).collect()}
    shards = F.coalesce(*[F.when(F.col("dim") == d, F.lit(s)) for d, (s, _) in sizes.items()], F.lit(1)).cast("long")

    def indexed(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import graph_ann as own

        dim = key[0].as_py()
        v = t.column("vec").combine_chunks().flatten().to_numpy().astype(kind).reshape(-1, dim)
        node = t.column("node").to_numpy()
        order = np.argsort(node)
        node, v = node[order], v[order]
        graph, start = own.build(own.lifted(v, sizes[dim][1]))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()), "nodes": [node.tobytes()], "vecs": [v.tobytes()], "graph": [graph.astype(np.int32).tobytes()], "start": [start.astype(np.int32).tobytes()]})

    dealt = found.select("node", "dim", "vec", F.pmod(F.xxhash64("node"), shards).alias("shard"))
    index = stored(dealt.groupBy("dim", "shard").applyInArrow(indexed, "dim int, shard long, nodes binary, vecs binary, graph binary, start binary"), "graph-index")

    asked = members.where(query if query is not None else F.lit(True)).join(found.select("node", "dim", "vec"), "node")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def gathered(key: tuple, t: pa.Table) -> pa.Table:
        v = t.column("vec").combine_chunks().flatten().to_numpy().astype(kind)
        return pa.table({"q_dim": pa.array([key[0].as_py()], pa.int32()), "ids": [t.column("row").to_numpy().astype(np.int64).tobytes()], "q": [v.tobytes()]})

    packs = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).groupBy("dim", "block").applyInArrow(gathered, "q_dim int, ids binary, q binary")
    sent = packs.withColumn("q_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(*[F.when(F.col("q_dim") == d, F.lit(s)) for d, (s, _) in sizes.items()], F.lit(1)).cast("long") - F.lit(1).cast("long"))))
    both = sent.join(index, (F.col("q_dim") == F.col("dim")) & (F.col("q_shard") == F.col("shard")))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import graph_ann as own

        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                v, q = np.frombuffer(r["vecs"], kind).reshape(-1, dim), np.frombuffer(r["q"], kind).reshape(-1, dim)
                nodes, ids = np.frombuffer(r["nodes"], np.int64), np.frombuffer(r["ids"], np.int64)
                x, graph = own.lifted(v, sizes[dim][1]), np.frombuffer(r["graph"], np.int32).reshape(len(v), -1).astype(np.int64)
                start = np.frombuffer(r["start"], np.int32).astype(np.int64)
                for i in range(0, len(q), own.TOGETHER):
                    part = q[i : i + own.TOGETHER].astype(np.float64)
                    long_ = np.concatenate([part / np.abs(part).max(1, keepdims=True), np.zeros((len(part), 1))], 1).astype(np.float32)
                    got, _ = own.beam_search(x, graph, start, long_, min(beam, len(v)))
                    row, col = np.nonzero(got >= 0)
                    at = got[row, col]
                    score = (part[row] * v[at].astype(np.float64)).sum(1)
                    order = np.lexsort((nodes[at], -score, row))
                    row, at, score = row[order], at[order], score[order]
                    rank = np.arange(len(row)) - np.searchsorted(row, row)
                    # k + 1 classes, the query's own among them, and all that tie with the last
                    last = np.full(len(part), -np.inf)
                    last[row[rank == k]] = score[rank == k]
                    keep = score >= last[row]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i + row[keep]]), pa.array(nodes[at[keep]]), pa.array(score[keep])], ["query_row", "node", "score"])

    hits = stored(both.select("dim", "nodes", "vecs", "graph", "start", "ids", "q").mapInArrow(searched, "query_row long, node long, score double"), "graph-hits")
    heads = members.where("node is not null").withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("id", "row"))).where(F.col("place") <= k + 1).select("node", "row", F.col("id").alias("vec_id"))
    best = hits.withColumn("r", F.rank().over(Window.partitionBy("query_row").orderBy(F.desc("score")))).where(F.col("r") <= k + 1).drop("r")
    named = best.join(heads, "node").where("row <> query_row")
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))).where(F.col("rank") <= k)
    ids = members.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))
    return ranked.join(ids, "query_row").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 20, F.col("id") % 20 == 0)
