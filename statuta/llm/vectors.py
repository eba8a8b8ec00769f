"""Vectors that take part in the operators on embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def usable(v: Column) -> Column:
    """Not null, not empty, every component finite, some component not zero."""
    big = F.lit(float("inf"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def classes(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, classes): equal vectors, by a 128-bit hash, are one class, named by a number.

    rows: row (a number of its own), id, node (null where the vector is
    unusable); classes: node, dim, count, vec (array). Both are stored tables
    without other columns.
    """
    kind = rows.schema[vector_column].dataType.simpleString()
    v = F.col(vector_column) if kind in ("array<float>", "array<double>") else F.col(vector_column).cast("array<double>")
    slim = rows.select(F.col(id_column).cast("long").alias("id"), F.when(usable(v), F.transform(v, lambda x: x + F.lit(0.0).cast(kind[6:-1] if kind in ("array<float>", "array<double>") else "double"))).alias("vec"))
    some = F.col("vec").isNotNull()
    named = slim.withColumn("h1", F.when(some, F.xxhash64("vec"))).withColumn("h2", F.when(some, F.xxhash64(F.lit(1), "vec")))
    each = stored(named.select(F.monotonically_increasing_id().alias("row"), "id", "h1", "h2"), "vector-rows")
    found = named.where("h1 is not null").groupBy("h1", "h2").agg(F.count("*").alias("count"), F.first("vec").alias("vec"))
    found = stored(found.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", F.size("vec").alias("dim"), "count", "vec"), "vector-classes")
    members = stored(each.join(found.select("h1", "h2", "node"), ["h1", "h2"], "left").select("row", "id", "node"), "vector-members")
    discard(each)
    out = found.drop("h1", "h2")
    out.stored_at = found.stored_at
    return members, out


def width(rows: DataFrame) -> str:
    """numpy's name of the vectors' number type."""
    return "<f4" if rows.schema["vec"].dataType.simpleString() == "array<float>" else "<f8"
