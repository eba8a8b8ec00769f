"""The lookup table of statutes: from triples, enhanced, merged without duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import is_for_fuzzy

#: Predicates of the statutes' graph, by column.
REQUIRED = ("title", "ref_version", "act_time")
OPTIONAL = ("citation", "acronymcitation", "year", "shorttitle")


def from_triples(triples: DataFrame, type_predicate: str = "type", type_value: str = "act", required: tuple[str, ...] = REQUIRED, optional: tuple[str, ...] = OPTIONAL) -> DataFrame:
    """Basic graph pattern: subjects of the type with every required predicate, optional ones where present, distinct.

    The pattern is a star, so one scan and one shuffle by subject gather the
    values of each predicate; a subject has a row for every combination of
    them, as joins of the triples would give.
    """
    o, p = F.struct("o"), F.col("p")
    star = triples.where(F.col("s").isNotNull() & p.isin(type_predicate, *required, *optional)).groupBy(F.col("s").alias("ref"))
    # a struct keeps a null value apart from none
    values = star.agg(F.max((p == type_predicate) & (F.col("o") == type_value)).alias("_typed"), *[F.collect_set(F.when(p == name, o)).alias(name) for name in (*required, *optional)])
    out = values.where("_typed").drop("_typed")
    for name in required:
        out = out.withColumn(name, F.explode(name))
    for name in optional:
        out = out.withColumn(name, F.explode_outer(name))
    return out.select("ref", *[F.col(name)["o"].alias(name) for name in (*required, *optional)])


def changed_since(acts: DataFrame, days: int | None, today: Column | None = None) -> DataFrame:
    """Acts of the last ``days`` days, today's not included; all without ``days``."""
    if not days:
        return acts
    now = today if today is not None else F.current_date()
    t = F.col("act_time").cast("date")
    return acts.where((t < now) & (t > F.date_sub(now, days)))


def enhance(acts: DataFrame, sources: tuple[str, ...] = ("title", "shorttitle", "acronymcitation")) -> DataFrame:
    """One row a candidate title: array of the titles, exploded, nulls dropped, one row a title (smallest ref), flag for_fuzzy."""
    rows = acts.withColumn("candidate_titles", F.explode(F.array(*sources))).where(F.col("candidate_titles").isNotNull())
    w = Window.partitionBy("candidate_titles").orderBy(F.asc_nulls_last("ref"), *[F.asc_nulls_last(c) for c in acts.columns if c != "ref"])
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn").withColumn("for_fuzzy", is_for_fuzzy(F.col("candidate_titles")))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new rows, equal rows once."""
    return old.unionByName(new).dropDuplicates()


def by_year(triples: DataFrame, first: int = 1800, last: int = 2025) -> DataFrame:
    """Backfill in one query: acts of all years of the range."""
    return from_triples(triples).where(F.col("year").cast("bigint").between(first, last))
