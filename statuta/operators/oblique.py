"""Indirect mentions: "the Act" and "the 2004 Act", joined to the statute they mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import spans as P
from ..session import stored


SPANS = "array<struct<start:int,end:int,text:string>>"


def mentions(paragraphs: DataFrame) -> DataFrame:
    """(uri, para, start, end, detected_leg, href, canonical, year) of refs to legislation in paragraphs (uri, para_no, markup).

    The text is what the ref holds, without tags. Refs without href or
    canonical form have nulls there; ``mention_errors`` selects them.
    """
    return mentions_of(paragraphs.select("uri", F.col("para_no").alias("para"), F.explode(P.refs(F.col("markup"))).alias("s")))


def mentions_of(s: DataFrame, *more: str) -> DataFrame:
    """``mentions`` of spans (uri, para, s), with more of their columns."""
    tag = F.regexp_extract(F.col("s.text"), r"^(<ref[^>]*>)", 1)
    attr = lambda name: F.nullif(F.regexp_extract(tag, rf'[\s:]{name}="([^"]*)"', 1), F.lit(""))
    leg = F.regexp_replace("s.text", "<[^>]+>", "")
    return s.select("uri", "para", F.col("s.start").alias("start"), F.col("s.end").alias("end"), leg.alias("detected_leg"), attr("href").alias("href"), attr("canonical").alias("canonical"), *more).withColumn("year", S.title_year(F.col("detected_leg")))


def mention_errors(found: DataFrame) -> DataFrame:
    return found.where("href is null or canonical is null")


def uses(paragraphs: DataFrame) -> DataFrame:
    """(uri, para, start, end, detected_ref, kind, year): kind 'act' or 'numbered_act'. Both patterns in one pass: no place matches both."""
    return uses_of(paragraphs.select("uri", F.col("para_no").alias("para"), F.explode(P.used(F.col("markup"))).alias("s")))


def uses_of(s: DataFrame) -> DataFrame:
    """``uses`` of spans (uri, para, s)."""
    year = S.title_year(F.col("s.text"))
    return s.select("uri", "para", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.text").alias("detected_ref"), F.when(year == "", "act").otherwise("numbered_act").alias("kind"), year.alias("year"))


def both(paragraphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Uses and mentions of paragraphs that are read once: the spans are stored, the paragraphs aren't."""
    sided = lambda side, s: F.transform(F.coalesce(s, F.array().cast(SPANS)), lambda x: F.struct(F.lit(side).alias("side"), x.alias("s")))
    m = F.col("markup")
    found = stored(paragraphs.select("uri", F.col("para_no").alias("para"), F.explode(F.concat(sided(0, P.refs(m)), sided(1, P.used(m)))).alias("one")).select("uri", "para", "one.*"), "spans")
    return uses_of(found.where("side = 1")), mentions_of(found.where("side = 0"))


def latest_before(used: DataFrame, found: DataFrame) -> DataFrame:
    """As-of join: every use with the last mention before it in its document; uses without one go.

    One sort by document and place, no join: mentions and uses are merged
    and the last mention seen is carried forward.
    """
    m = F.struct("detected_leg", "href", "canonical", F.col("para").alias("m_para"), F.col("start").alias("m_start"))
    left = found.select("uri", "para", "start", F.lit(0).alias("side"), m.alias("m"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("detected_ref"))
    right = used.select("uri", "para", "start", F.lit(1).alias("side"), F.lit(None).cast(left.schema["m"].dataType).alias("m"), "end", "detected_ref")
    w = Window.partitionBy("uri").orderBy("para", "start", F.desc("side")).rowsBetween(Window.unboundedPreceding, -1)
    carried = left.unionByName(right).withColumn("m", F.when(F.col("side") == 1, F.last("m", ignorenulls=True).over(w)).otherwise(F.col("m")))
    return carried.where("side = 1 and m is not null").select("uri", "para", "start", "end", "detected_ref", "m.*")


def first_of_year(used: DataFrame, found: DataFrame) -> DataFrame:
    """Every use with a year, with its document's first mention of that year in the paragraphs up to its own."""
    w = Window.partitionBy("uri", "year").orderBy("para", "start")
    firsts = found.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("uri", "year", "detected_leg", "href", "canonical", F.col("para").alias("m_para"), F.col("start").alias("m_start"))
    return used.join(firsts, ["uri", "year"]).where("m_para <= para").select("uri", "para", "start", "end", "detected_ref", "detected_leg", "href", "canonical", "m_para", "m_start")


def resolved(paragraphs: DataFrame) -> DataFrame:
    """All indirect mentions of paragraphs (uri, para_no, markup) with the statute they mean."""
    return meant(*both(paragraphs))


def meant(used: DataFrame, found: DataFrame) -> DataFrame:
    """Indirect mentions with the statute they mean, of refs that have an address."""
    found = found.where("href is not null")
    return latest_before(used.where("kind = 'act'"), found).unionByName(first_of_year(used.where("kind = 'numbered_act'"), found))
