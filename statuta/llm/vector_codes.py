"""Codes for vectors, part by part: codebooks in integers, nearest entries found with a vantage-point tree.

Every position of a part has its own codebook of at most ``ENTRIES`` entries,
and over these a tree: a node has one entry, the vantage point, and two sets of
entries, the near and the far half, each with the least and greatest distance
from the vantage point, rounded down and up. A vector's part goes down the tree
branch and bound: by the triangle inequality a set is passed over only when even
its rounded bound is more than the best squared distance so far, so a set that
could hold an equal one is visited. All comparisons are of integers; of equal
distances the lower index wins. The vectors of a batch go down together.

A round is one pass: tasks add up their parts by entry, these sums (as many as
the codebooks have numbers) are added by Spark, and the driver, which holds no
more than the codebooks, divides them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, ship, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Entries of a leaf, at most; vectors that go down the tree together.
LEAF, TOGETHER = 2, 8192
#: Labels whose sums are broadcast, at most; beyond, rows of one label are dealt to so many joins.
LABELS, SALT = 1_000_000, 16


def root(squares: np.ndarray) -> np.ndarray:
    """Square roots rounded down, exactly."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    return r + ((r + 1) * (r + 1) <= squares)


def root_up(squares: np.ndarray) -> np.ndarray:
    r = root(squares)
    return r + (r * r < squares)


class Tree:
    """Nearest of some integer entries, by squared Euclidean distance, ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.top = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray) -> tuple:
        """(members,) of a leaf; (vantage, [(node, least, greatest distance), ...]) else."""
        if len(members) <= LEAF:
            return (members,)
        # the entry farthest from the members' middle: its distances differ most
        middle = self.entries[members].mean(0)
        v = members[np.argmax(((self.entries[members] - middle) ** 2).sum(1))]
        rest = members[members != v]
        far = ((self.entries[rest] - self.entries[v]) ** 2).sum(1)
        order = np.argsort(far, kind="stable")
        half = len(rest) // 2
        sets = [(rest[some], far[some]) for some in (order[:half], order[half:]) if len(some)]
        return v, [(self._node(m), int(root(d).min()), int(root_up(d).max())) for m, d in sets]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, squared distances) for the rows of x."""
        self.best = np.full(len(x), np.iinfo(np.int64).max)
        self.index = np.full(len(x), len(self.entries))
        self._visit(self.top, x, np.arange(len(x)))
        return self.index, self.best

    def _meet(self, entry: int, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        squares = ((x[rows] - self.entries[entry]) ** 2).sum(1)
        better = (squares < self.best[rows]) | ((squares == self.best[rows]) & (entry < self.index[rows]))
        self.best[rows[better]], self.index[rows[better]] = squares[better], entry
        return squares

    def _visit(self, node: tuple, x: np.ndarray, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if len(node) == 1:
            for entry in node[0].tolist():
                self._meet(entry, x, rows)
            return
        vantage, sets = node
        squares = self._meet(vantage, x, rows)
        down, up = root(squares), root_up(squares)
        bounds = np.stack([np.maximum(0, np.maximum(down - greatest, least - up)) for _, least, greatest in sets])
        # the set with the lower bound first: its finds may rule out the other
        first = bounds.argmin(0)
        for k in range(len(sets)):
            for j in [k, *(i for i in range(len(sets)) if i != k)]:
                some = np.flatnonzero(first == k)
                some = some[bounds[j, some] ** 2 <= self.best[rows[some]]]
                self._visit(sets[j][0], x, rows[some])


def batches_of(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers (rows, PARTS, width / PARTS)) of a batch, some rows at a time."""
    for k in range(0, batch.num_rows, TOGETHER):
        some = batch.column(column).slice(k, TOGETHER)
        yield k, some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), PARTS, width // PARTS)


def _first(kept: DataFrame, n: int) -> list:
    return kept.select("vec_id", "q").orderBy(F.asc_nulls_last("vec_id"), "q").limit(n).collect()


def _round(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, width) after one round."""
    parts, entries, part_width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import vector_codes as own

        sums = np.zeros((parts, entries, part_width + 1), np.int64)
        trees = [own.Tree(b) for b in books]
        for batch in batches:
            for _, x in own.batches_of(batch, "q", parts * part_width):
                for p, tree in enumerate(trees):
                    index, _ = tree.nearest(x[:, p])
                    order = np.argsort(index, kind="stable")
                    there, starts = np.unique(index[order], return_index=True)
                    sums[p, there, :-1] += np.add.reduceat(x[order, p], starts, axis=0)
                    sums[p, there, -1] += np.diff([*starts, len(order)])
        flat = sums.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.int64())], ["at", "n"])

    sums = np.zeros(parts * entries * (part_width + 1), np.int64)
    # as many rows as the codebooks have numbers, at most
    for r in kept.select("q").mapInArrow(summed, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        sums[r["at"]] = r["n"]
    sums = sums.reshape(parts, entries, part_width + 1)
    count = sums[:, :, -1:]
    return np.where(count > 0, sums[:, :, :-1] // np.maximum(1, count), books)


def compress(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", scale: int = SCALE, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Rows (vec_id, code, error, label_error, codebooks_sha256), one for each vector that is kept.

    Vectors that are null or hold null or non-finite components are dropped,
    and so are those that can't be cut into eight equal parts like the others:
    empty ones and ones of another length than the kept vector of the smallest
    id. The codebooks start as the parts of the smallest ids' vectors, of equal
    ids' the smaller vectors first and null ids last; with fewer vectors they
    have fewer entries. Repeated rows are vectors of their own, null labels are
    equal to each other, other columns are ignored, and an empty table gives no
    rows. Components so large that a vector's error could pass a long raise an
    OverflowError.
    """
    spark = rows.sparkSession
    ship(spark)
    v, big = F.col(vector_column), F.lit(float("inf"))
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < big)), F.lit(False))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    kept = rows.where(sound & (F.size(v) > 0) & (F.size(v) % PARTS == 0)).select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), whole.alias("q"))
    kept = stored(kept, "vectors-in-integers")
    schema = f"vec_id long, label {rows.schema[label_column].dataType.simpleString()}, code string, error long"
    first = _first(kept, 1)
    if not first:
        return spark.createDataFrame([], schema).select("vec_id", "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = len(first[0]["q"])
    alike = kept.where(F.size("q") == width)
    span = alike.agg(F.count("*").alias("n"), F.max(F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q")))).alias("most")).first()
    if 4 * span["most"] ** 2 * width >= 2**62 or span["most"] * span["n"] >= 2**62:
        raise OverflowError(f"components of {span['most'] / scale:.3g}: their errors may pass a long")
    books = np.array([r["q"] for r in _first(alike, entries)], np.int64).reshape(-1, PARTS, width // PARTS).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _round(alike, books)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import vector_codes as own

        trees = [own.Tree(b) for b in books]
        for batch in batches:
            for k, x in own.batches_of(batch, "q", width):
                found = [tree.nearest(x[:, p]) for p, tree in enumerate(trees)]
                code = np.stack([i for i, _ in found], 1).astype(np.uint8)
                code = [row.tobytes().hex() for row in code]
                error = sum(d for _, d in found)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").slice(k, len(x)), batch.column("label").slice(k, len(x)), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    out = stored(alike.mapInArrow(coded, schema), "vector-codes")
    discard(kept)
    sums = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= LABELS:
        both = out.join(F.broadcast(sums), same)
    else:
        salted = sums.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        both = out.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT)).cast("int")).join(salted, same & (F.col("_salt") == F.col("_other")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds, one after the other, over rows (vector, part, position, value)."""
    out = """with k as materialized (select row_number() over (order by vec_id) as r, vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as q
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 v as materialized (select r, vec_id, (i - 1) // (len(q) // 8) as part, (i - 1) % (len(q) // 8) as pos, q[i] as x from (select r, vec_id, q, unnest(generate_series(1, len(q))) as i from k)),
 c0 as materialized (select part, r - 1 as entry, pos, x from v where r <= 16)"""
    for n in range(ROUNDS + 1):
        out += f""",
 d{n} as materialized (select v.r, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) as far from v join c{n} c on c.part = v.part and c.pos = v.pos group by all),
 a{n} as materialized (select r, part, arg_min(entry, far * 16 + entry) as entry, min(far) as far from d{n} group by r, part)"""
        if n < ROUNDS:
            out += f""",
 s{n} as (select v.part, a.entry, v.pos, sum(v.x) as s, count(*) as n from v join a{n} a on a.r = v.r and a.part = v.part group by all),
 c{n + 1} as materialized (select c.part, c.entry, c.pos, case when s.n is null then c.x else cast((s.s - ((s.s % s.n) + s.n) % s.n) // s.n as bigint) end as x
  from c{n} c left join s{n} s on s.part = c.part and s.entry = c.entry and s.pos = c.pos)"""
    return (
        out
        + f""",
 e as (select k.vec_id, any_value(k.label) as label, string_agg(printf('%02x', cast(a.entry as int)), '' order by part) as code, cast(sum(far) as bigint) as error from k join a{ROUNDS} a on a.r = k.r group by k.r, k.vec_id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
 (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) from c{ROUNDS}) as codebooks_sha256 from e"""
    )


ORACLE_SQL = _oracle()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
