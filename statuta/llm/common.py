"""What the operators share: small batches, tables that come and go, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import discard, shared_folder, stored

__all__ = ["components", "discard", "give_back", "only", "pieces", "shared_folder", "ship", "shuffle_partitions", "stored"]

#: Rows of an Arrow batch, unless the session says otherwise: few texts, which may be long, are held at once.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that workers can import it; sees to small Arrow batches."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting, "10000")) in (0, 10_000):  # the default
        spark.conf.set(setting, str(BATCH_ROWS))
    session.ship(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that few texts are Python objects at once; memory is given back at the end."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    give_back()


def give_back() -> None:
    """Hands free memory to the system: a worker that waits for its next task keeps no more than it needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def only(df: DataFrame, column: str, keys: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Rows of df whose column is among keys (one distinct long column): a semi-join, of up to ``most`` keys by broadcast."""
    k = keys.select(F.col(keys.columns[0]).alias("_only"))
    return df.join(F.broadcast(k) if keys.count() <= most else k, F.col(column) == F.col("_only"), "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node, component), component the smallest node.

    Alternates large-star and small-star steps, each two shuffles of the edge
    list; every round's edges are written to the shared folder, and those of
    the round before deleted. Nodes without an edge to another node don't
    appear. Self-loops, nulls and repeated edges are ignored. Ends when a round
    changes nothing, that is, when the edges are stars around their
    components' smallest nodes. discard() takes the result.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "edges")
    seen = None
    while True:
        count = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(count) == seen or count["n"] == 0:
            break
        seen = tuple(count)
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, e = e, stored(small, "edges")
        discard(before)
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out.stored_at = e.stored_at
    return out
