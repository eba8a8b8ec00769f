"""Embedding near-dedup: random-hyperplane sign hashing, exact verification, connected components.

Equal vectors collapse into one class first. Every class gets ``tables``
codes of ``bits`` signs each, and a signature of SIGNS more signs. Buckets of
equal code hold ids and signatures only; members whose signature is within
FAR signs of another's in their bucket come back with their vectors and are
compared by cosine, as blocks of a matrix product. So vectors without a near
one never move. A pair that shares several buckets counts in the first table
only, so link counts are exact sums. Pairs never leave a bucket: it returns
link counts and a spanning forest of its links.

The number of bits grows with the logarithm of the row count, the number of
tables is what keeps the chance to miss a pair at the threshold below
``miss``; the signature adds less than a tenth of that (a pair at 0.9 differs in
37 of 256 signs, with a deviation of 5.6). A bucket beyond ``max(MOST, n / 2**14)`` rows is cut into blocks,
each pair of blocks a group of its own; the list of such buckets has at most
2**14 entries a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors
from .common import components, discard, ship, shuffle_partitions, stored
from .ngram_join import mixed

THRESHOLD = 0.9
MISS = 1e-4
SEED = 23
#: Rows of a bucket that are compared in one group, at least.
MOST = 4096
#: Rows of a matrix product's block.
BLOCK = 1024
#: Signs of a signature, and the deviations from the mean by which a pair at the threshold may differ.
SIGNS, DEVIATIONS = 256, 5.3


def plan(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for n vectors: about 256 unrelated vectors a bucket, misses below ``miss`` at the threshold."""
    bits = min(30, max(4, round(math.log2(max(n, 1) / 256)) if n > 256 else 4))
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - hit))


def planes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def codes(x: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables) codes of the rows of x."""
    sign = (x.astype(np.float64) @ planes(x.shape[1], bits, tables, seed) >= 0).reshape(len(x), tables, bits)
    return (sign * (1 << np.arange(bits))).sum(2).astype(np.int32)


def far(threshold: float) -> int:
    """The number of signs in which signatures of a pair at the threshold practically never differ."""
    p = math.acos(threshold) / math.pi
    return math.ceil(SIGNS * p + DEVIATIONS * math.sqrt(SIGNS * p * (1 - p)))


def signatures(x: np.ndarray, seed: int = SEED) -> np.ndarray:
    """(rows, SIGNS / 64) words of the rows of x."""
    signs = x.astype(np.float64) @ np.random.default_rng([seed, x.shape[1], SIGNS]).standard_normal((x.shape[1], SIGNS)) >= 0
    return np.packbits(signs, axis=1).view(np.uint64)


def bucket_names(c: np.ndarray) -> np.ndarray:
    """64-bit names of (table, code)."""
    with np.errstate(over="ignore"):
        return mixed((c.astype(np.uint64) << np.uint64(16)) + np.arange(c.shape[1], dtype=np.uint64) + np.uint64(1))


def near_duplicates(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one for each row of ``rows``.

    n_links: other rows of cosine >= threshold, in double precision;
    component_id: the smallest id reachable by links, the own id without
    links. Null, empty, zero and non-finite vectors link with nothing;
    vectors of different length don't link. Repeated rows are rows of their
    own that link with each other. A null id takes part but is a component_id
    only where no member has an id; other columns are ignored. An empty table gives
    no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    members, found = vectors.classes(rows, id_column, vector_column)
    kind = vectors.width(found)
    n = found.count()
    bits, tables = plan(n, threshold, miss)
    most = max(MOST, n >> 14)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import embedding_dedup as own

        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                x = part.column(3).flatten().to_numpy().astype(kind).reshape(len(at), dim)
                c = own.codes(x, bits, tables, seed)
                own_signs = own.signatures(x, seed)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *[pa.array([r.tobytes() for r in y], pa.binary()) for y in (x, c, own_signs)]], ["node", "dim", "count", "vec", "codes", "signs"])

    hashes = stored(found.mapInArrow(hashed, "node long, dim int, count long, vec binary, codes binary, signs binary"), "vector-codes")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import embedding_dedup as own

        for batch in batches:
            c = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, tables)
            with np.errstate(over="ignore"):
                names = own.mixed(own.bucket_names(c) + batch.column(0).to_numpy().astype(np.uint64)[:, None]).reshape(-1)
            name, size = np.unique(names, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(size.astype(np.int64))], ["bucket", "size"])

    large = hashes.select("dim", "codes").mapInArrow(named, "bucket long, size long").groupBy("bucket").agg(F.sum("size").alias("size")).where(F.col("size") > most).collect()
    blocks = spark.sparkContext.broadcast({r["bucket"] & (2**64 - 1): -(-r["size"] // most) for r in large})
    bucket_parts = max(shuffle_partitions(spark), n * tables // 200_000)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import embedding_dedup as own

        cut = blocks.value
        big = np.array(sorted(cut), np.uint64)
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                r = np.zeros(part.num_rows, own.MEMBER)
                r["node"] = part.column(0).to_numpy()
                r["signs"] = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint64).reshape(len(r), -1)
                c = np.frombuffer(b"".join(part.column(2).to_pylist()), np.int32).reshape(-1, tables)
                with np.errstate(over="ignore"):
                    names = own.mixed(own.bucket_names(c) + np.uint64(dim))
                out = {}
                for t in range(tables):
                    r["bucket"], r["table"] = names[:, t], t
                    r["side"] = 2  # the whole bucket
                    hot = np.isin(names[:, t], big)
                    sent = [r[~hot]]
                    for i in np.flatnonzero(hot):  # a row meets the rows of its own and every other block
                        nb = cut[int(names[i, t])]
                        own_block = int(own.mixed(r["node"][i : i + 1].view(np.uint64))[0] % np.uint64(nb))
                        copies = np.repeat(r[i : i + 1], nb)
                        lo, hi = np.minimum(own_block, np.arange(nb)), np.maximum(own_block, np.arange(nb))
                        with np.errstate(over="ignore"):
                            copies["bucket"] = own.mixed(names[i, t] + (lo * nb + hi + 1).astype(np.uint64))
                        copies["side"] = np.where(lo == hi, 2, np.where(own_block == lo, 0, 1))
                        sent.append(copies)
                    every = np.concatenate(sent)
                    to = (every["bucket"] % np.uint64(bucket_parts)).astype(np.int64)
                    order = np.argsort(to, kind="stable")
                    at = np.flatnonzero(np.r_[True, np.diff(to[order]) > 0]) if len(order) else []
                    for rows_ in np.split(order, at[1:]) if len(order) else []:
                        out.setdefault(int(to[rows_[0]]), []).append(every[rows_].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([int(dim)] * len(out), pa.int32()), pa.array(list(out), pa.int64()), pa.array([b"".join(v) for v in out.values()], pa.binary())], ["dim", "part", "rows"])

    # who has a near signature in a bucket
    sent = hashes.select("node", "dim", "codes", "signs").mapInArrow(packed, "dim int, part long, rows binary")
    meets = stored(sent.groupBy("dim", "part").applyInArrow(_meeting(far(threshold)), "bucket long, node long, table int, side int"), "vector-meets")
    parts = max(shuffle_partitions(spark), meets.count() // 20_000)
    both = meets.withColumn("part", F.pmod("bucket", F.lit(parts))).join(hashes.drop("signs"), "node")
    got = stored(both.groupBy("dim", "part").applyInArrow(_pairs(threshold, tables, kind), "a long, b long, n long"), "vector-links")
    discard(meets, hashes)
    links = got.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    reach = components(got.where("b is not null").select("a", "b"))
    twins = found.select(F.col("node").alias("a"), "count").where("count > 1")
    joined = members.drop("row").join(links, members["node"] == links["a"], "left").select("id", "node", "n")
    joined = joined.join(twins, joined["node"] == twins["a"], "left").select("id", "node", (F.coalesce("n", F.lit(0)) + F.coalesce("count", F.lit(1)) - 1).alias("n_links"))
    joined = joined.join(reach.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").select("id", "n_links", F.coalesce("component", "node").alias("class"))
    least = joined.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    out = joined.join(least.withColumnRenamed("class", "k"), F.col("class") == F.col("k"), "left").select("id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("least", "id").alias("component_id"))
    out = stored(out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))), "vector-result")
    discard(members, found, got, reach)
    return out


#: What a bucket gets of a member.
MEMBER = np.dtype([("bucket", "<u8"), ("node", "<i8"), ("signs", "<u8", (SIGNS // 64,)), ("table", "<i2"), ("side", "i1")])


def record(dim: int, tables: int, kind: str) -> np.dtype:
    return np.dtype([("bucket", "<i8"), ("node", "<i8"), ("count", "<i8"), ("table", "<i4"), ("side", "<i4"), ("codes", "<i4", (tables,)), ("vec", kind, (dim,))])


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """(left, right, whether these are two blocks): what a bucket compares with what."""
    cross = bool((side != 2).any())
    left = np.flatnonzero(side != 1) if cross else np.arange(len(side))
    return left, np.flatnonzero(side == 1) if cross else left, cross


def _meeting(most: int):
    """The function of one part: the members of its buckets that differ from another one in ``most`` signs or fewer."""

    def meeting(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import embedding_dedup as own

        r = np.frombuffer(b"".join(t.column("rows").to_pylist()), own.MEMBER)
        r = r[np.argsort(r["bucket"], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, r["bucket"][1:] != r["bucket"][:-1]])
        keep = np.zeros(len(r), bool)
        for a, b in zip(cuts, np.r_[cuts[1:], len(r)], strict=True):
            if b - a > 1:
                keep[a:b] = own.near_signs(r["signs"][a:b], r["side"][a:b], most)
        r = r[keep]
        return pa.table({"bucket": pa.array(r["bucket"].astype(np.int64)), "node": pa.array(r["node"].copy()), "table": pa.array(r["table"].astype(np.int32)), "side": pa.array(r["side"].astype(np.int32))})

    return meeting


def near_signs(signs: np.ndarray, side: np.ndarray, most: int) -> np.ndarray:
    """Which rows have another one within ``most`` signs (of the other side, where there are two)."""
    left, right, cross = _sides(side)
    hit = np.zeros(len(signs), bool)
    for k in range(0, len(left), BLOCK):
        rows = left[k : k + BLOCK]
        apart = np.zeros((len(rows), len(right)), np.uint16)
        for w in range(signs.shape[1]):
            apart += np.bitwise_count(signs[rows, w][:, None] ^ signs[right, w])
        close = apart <= most
        if not cross:
            close[np.arange(len(rows)), k + np.arange(len(rows))] = False
        hit[rows] |= close.any(1)
        hit[right] |= close.any(0)
    return hit


def _pairs(threshold: float, tables: int, kind: str):
    """The function of one part: link counts (a, null, n) and a spanning forest's links (a, b, null)."""

    def exact(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import embedding_dedup as own

        dim = key[0].as_py()
        r = np.zeros(t.num_rows, own.record(dim, tables, kind))
        for name in ("bucket", "node", "count", "table", "side"):
            r[name] = t.column(name).to_numpy()
        r["vec"] = np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(-1, dim)
        r["codes"] = np.frombuffer(b"".join(t.column("codes").to_pylist()), np.int32).reshape(-1, tables)
        r = r[np.argsort(r["bucket"], kind="stable")]
        cuts = np.flatnonzero(np.r_[True, r["bucket"][1:] != r["bucket"][:-1]])
        a, b, who, much = [], [], [], []
        for g in np.split(r, cuts[1:]):
            if len(g) > 1:
                own.bucket_links(g, threshold, a, b, who, much)
        node, at = np.unique(np.concatenate(who), return_inverse=True) if who else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        n = np.bincount(at, np.concatenate(much), len(node)).astype(np.int64) if who else np.zeros(0, np.int64)
        edges = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
        first = pa.table({"a": pa.array(node, pa.int64()), "b": pa.nulls(len(node), pa.int64()), "n": pa.array(n)})
        return pa.concat_tables([first, pa.table({"a": pa.array(edges[:, 0], pa.int64()), "b": pa.array(edges[:, 1], pa.int64()), "n": pa.nulls(len(edges), pa.int64())})])

    return exact


def bucket_links(g: np.ndarray, threshold: float, a: list, b: list, who: list, much: list) -> None:
    """Compares one bucket's rows g block by block."""
    x = g["vec"].astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    single = x.astype(np.float32)
    table = int(g["table"][0])
    left, right, cross = _sides(g["side"])
    if not len(left) or not len(right):
        return
    parent = np.arange(len(g))
    degree = np.zeros(len(g), np.int64)
    counts = g["count"]
    for k in range(0, len(left), BLOCK):
        rows = left[k : k + BLOCK]
        cols = right if cross else left[k:]
        s = single[rows] @ single[cols].T
        i, j = np.nonzero(s >= threshold - 1e-4)
        if not cross:
            upper = j > i
            i, j = i[upper], j[upper]
        close = np.abs(s[i, j] - threshold) <= 1e-4
        i, j = rows[i], cols[j]
        if close.any():
            keep = np.ones(len(i), bool)
            keep[close] = (x[i[close]] * x[j[close]]).sum(1) >= threshold
            i, j = i[keep], j[keep]
        for t in range(table):  # an earlier table has it
            if not len(i):
                break
            new = g["codes"][i, t] != g["codes"][j, t]
            i, j = i[new], j[new]
        if len(i):
            np.add.at(degree, i, counts[j])
            np.add.at(degree, j, counts[i])
            _forest(parent, i, j)
    some = np.flatnonzero(degree)
    who.append(g["node"][some])
    much.append(degree[some])
    tied = np.flatnonzero(parent != np.arange(len(g)))
    a.append(g["node"][tied])
    b.append(g["node"][parent[tied]])


def _forest(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins i and j in parent (each row's root, after every call), by rounds of minimum labels."""
    while True:
        x, y = parent[i], parent[j]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        open_ = lo < hi
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(parent, hi[open_], lo[open_])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumnRenamed("id", "vec_id")
