"""The citation graph and hierarchies over triples."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stored


def edges(*found: tuple[DataFrame, str]) -> DataFrame:
    """Distinct cites(src, dst) from annotations, given with the column that holds the address."""
    out = None
    for df, column in found:
        e = df.select(F.col("uri").alias("src"), F.col(column).alias("dst")).where("dst is not null and dst <> '#'")
        out = e if out is None else out.unionByName(e)
    return out.distinct()


def cited_in(cites: DataFrame) -> DataFrame:
    return cites.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def in_degree(cites: DataFrame) -> DataFrame:
    return cites.groupBy("dst").agg(F.count("*").alias("cited_by"))


def parents(addresses: DataFrame, column: str = "dst") -> DataFrame:
    """Sections' parent statutes: the address less /section/..."""
    return addresses.select(column, F.regexp_replace(column, r"/section/.*$", "").alias("parent")).where(F.col(column).contains("/section/")).distinct()


def closure(triples: DataFrame, predicate: str) -> DataFrame:
    """(top, node, depth): everything reachable over a predicate, and by how few links; cycles end by themselves.

    Pairs of the greatest depth reached are joined with all pairs, so the depth
    doubles in a round and no depth is too great. Every round is stored.
    """
    links = triples.where(F.col("p") == predicate).select(F.col("s").alias("top"), F.col("o").alias("node"), F.lit(1).alias("depth")).distinct()
    found, reach = stored(links, "closure"), 1
    # without a pair of this very depth there is none beyond it
    while not found.where(F.col("depth") == reach).isEmpty():
        far = found.where(F.col("depth") == reach).select("top", F.col("node").alias("mid"))
        rest = found.select(F.col("top").alias("mid"), "node", (F.col("depth") + reach).alias("depth"))
        before, found = found, stored(found.unionByName(far.join(rest, "mid").select("top", "node", "depth")).groupBy("top", "node").agg(F.min("depth").alias("depth")), "closure")
        discard(before)
        reach *= 2
    return found


#: Rules over triples. (sub, p, q): what p holds, q holds. (inverse, p, q): q holds it the other way round. (chain, p, q, r): p and then q is r.
CITATION_RULES = (
    ("sub", "cites", "mentions"),
    ("inverse", "cites", "citedIn"),
    ("inverse", "mentions", "mentionedIn"),
    ("chain", "partOf", "partOf", "partOf"),
    ("chain", "mentions", "partOf", "mentions"),
)


def entailed(triples: DataFrame, rules: tuple[tuple[str, ...], ...] = CITATION_RULES) -> DataFrame:
    """All triples (s, p, o) that follow from these by the rules, these included: a stored table.

    Semi-naive: a round applies the rules to what the round before found,
    chains to that on either side, and keeps what is new; it ends when nothing
    is. Every round is stored. Triples with nulls are left out.
    """
    one = lambda t, p, a="s", b="o": t.where(F.col("p") == p).select(F.col("s").alias(a), F.col("o").alias(b))
    as_triples = lambda t, p: t.select("s", F.lit(p).alias("p"), "o")
    every = stored(triples.select("s", "p", "o").dropna().distinct(), "triples")
    parts, new = [every], every
    while True:
        known, made = functools.reduce(DataFrame.unionAll, parts), []
        for kind, p, q, *r in rules:
            if kind == "chain":
                made.append(as_triples(one(new, p, b="m").join(one(known, q, a="m"), "m"), r[0]))
                if len(parts) > 1:
                    made.append(as_triples(one(known, p, b="m").join(one(new, q, a="m"), "m"), r[0]))
            else:
                made.append(as_triples(one(new, p) if kind == "sub" else one(new, p, a="o", b="s"), q))
        fresh = stored(functools.reduce(DataFrame.unionAll, made).distinct().join(known, ["s", "p", "o"], "left_anti"), "triples-new")
        if fresh.isEmpty():
            discard(fresh)
            break
        new = fresh
        parts.append(fresh)
    out = stored(known, "triples-all")
    discard(*parts)
    return out
