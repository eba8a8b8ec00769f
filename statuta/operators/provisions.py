"""Section numbers joined to statutes: definitions close by, later uses by the nearest definition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import spans as P
from ..session import stored
from .oblique import SPANS, mentions_of

THRESHOLD = 30


def sections(paragraphs: DataFrame) -> DataFrame:
    """(uri, para, start, end, section, section_no) of paragraphs (uri, para_no, markup)."""
    s = paragraphs.select("uri", F.col("para_no").alias("para"), F.explode(P.sections(F.col("markup"))).alias("s"))
    return s.select("uri", "para", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.text").alias("section"), S.section_number(F.col("s.text")).alias("section_no"))


def close_pairs(found: DataFrame, statutes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Band join: sections and statutes of one paragraph fewer than threshold characters apart (0 where they overlap)."""
    m = statutes.select("uri", "para", F.col("start").alias("m_start"), F.col("end").alias("m_end"), "detected_leg", "href", "canonical")
    return found.join(m, ["uri", "para"]).withColumn("gap", _gap("start", "end", "m_start", "m_end")).where(F.col("gap") < threshold)


def _gap(start: Column | str, end: Column | str, m_start: Column | str, m_end: Column | str) -> Column:
    start, end, m_start, m_end = (F.col(c) if isinstance(c, str) else c for c in (start, end, m_start, m_end))
    return F.greatest(F.lit(0), start - m_end) + F.greatest(F.lit(0), m_start - end)


def beside(paragraphs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``sections`` of paragraphs, with the spans of the refs fewer than threshold characters apart in column near: the band join of what stands in one row, which shuffles nothing."""
    m = F.col("markup")
    both = paragraphs.select("uri", F.col("para_no").alias("para"), P.sections(m).alias("found"), F.coalesce(P.refs(m), F.array().cast(SPANS)).alias("refs"))
    close = lambda s: F.filter("refs", lambda r: _gap(s["start"], s["end"], r["start"], r["end"]) < threshold)
    s = both.select("uri", "para", F.explode(F.transform("found", lambda s: F.struct(s.alias("s"), close(s).alias("near")))).alias("one")).select("uri", "para", "one.*")
    return s.select("uri", "para", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.text").alias("section"), S.section_number(F.col("s.text")).alias("section_no"), "near")


def pairs(found: DataFrame) -> DataFrame:
    """``close_pairs`` of sections with the refs beside them."""
    s = found.select("uri", "para", F.explode("near").alias("s"), F.struct("start", "end", "section", "section_no").alias("found"))
    m = mentions_of(s, "found").withColumnsRenamed({"start": "m_start", "end": "m_end"}).select("uri", "para", "found.*", "m_start", "m_end", "detected_leg", "href", "canonical")
    return m.withColumn("gap", _gap("start", "end", "m_start", "m_end"))


def paired(paragraphs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``close_pairs`` of paragraphs (uri, para_no, markup), of which those without a ref aren't searched."""
    return pairs(beside(paragraphs.where(P.has_ref(F.col("markup"))), threshold))


def definitions(pairs: DataFrame) -> DataFrame:
    """(uri, section_no, para, pos, section_href, section_canonical, href, canonical): where a section's statute is known."""
    n = F.col("section_no")
    return pairs.select("uri", "section_no", "para", F.col("start").alias("pos"), S.section_href(F.col("href"), n).alias("section_href"), S.section_canonical(F.col("canonical"), n).alias("section_canonical"), "href", "canonical", "m_start")


def nearest(found: DataFrame, defs: DataFrame, strict: bool = False) -> DataFrame:
    """Every section with the definition of its number nearest among paragraphs up to its own.

    Nearest paragraph first; within it the definition nearest in place, on a
    tie the first. strict: where the nearest paragraph has several, the
    nearest place in any paragraph.
    """
    d = defs.select("uri", "section_no", F.col("para").alias("d_para"), F.col("pos").alias("d_pos"), "section_href", "section_canonical", "href", "canonical", "m_start")
    use = ["uri", "section_no", "para", "start"]
    if strict:
        j = found.join(d, ["uri", "section_no"])
        earlier = F.col("d_para") <= F.col("para")
        far, place = F.abs(F.col("para") - F.col("d_para")), F.abs(F.col("start") - F.col("d_pos"))
        w = Window.partitionBy(*use)
        j = j.withColumn("best", F.min(F.when(earlier, far)).over(w)).where("best is not null")
        j = j.withColumn("many", F.sum((earlier & (far == F.col("best"))).cast("int")).over(w))
        j = j.where((F.col("many") > 1) | (earlier & (far == F.col("best"))))
        ranked = j.withColumn("rn", F.row_number().over(Window.partitionBy(*use).orderBy(place, "d_para", "d_pos", "m_start"))).where("rn = 1")
    else:
        # as-of: the last paragraph with definitions is carried forward, then the nearest of its definitions taken
        one = F.struct("d_pos", "m_start", "section_href", "section_canonical")
        sets = d.groupBy("uri", "section_no", "d_para").agg(F.collect_list(one).alias("ds"))
        left = sets.select("uri", "section_no", F.col("d_para").alias("para"), F.lit(0).alias("side"), F.struct("d_para", "ds").alias("m"), *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ("start", "end", "section")])
        right = found.select("uri", "section_no", "para", F.lit(1).alias("side"), F.lit(None).cast(left.schema["m"].dataType).alias("m"), "start", "end", "section")
        w = Window.partitionBy("uri", "section_no").orderBy("para", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        j = left.unionByName(right).withColumn("m", F.last("m", ignorenulls=True).over(w)).where("side = 1 and m is not null")
        nearest_ = F.array_min(F.transform("m.ds", lambda x: F.struct(F.abs(F.col("start") - x["d_pos"]).alias("far"), x["d_pos"], x["m_start"], x["section_href"], x["section_canonical"])))
        ranked = j.withColumn("n", nearest_).select("*", F.col("m.d_para").alias("d_para"), "n.d_pos", "n.section_href", "n.section_canonical")
    return ranked.select("uri", "para", "start", "end", "section", "section_no", "d_para", "d_pos", S.sub_section_href(F.col("section_href"), F.col("section")).alias("section_href"), "section_canonical")


def resolved(paragraphs: DataFrame, threshold: int = THRESHOLD, strict: bool = False) -> DataFrame:
    """Sections of paragraphs (uri, para_no, markup) with their statutes. The sections are stored with the refs beside them, since they are read for the definitions and for the uses; the paragraphs are read once."""
    found = stored(beside(paragraphs, threshold), "sections")
    return nearest(found.drop("near"), definitions(pairs(found).where("href is not null")), strict)


def meant(found: DataFrame, statutes: DataFrame, threshold: int = THRESHOLD, strict: bool = False) -> DataFrame:
    """Sections with their statutes, of refs that have an address."""
    return nearest(found, definitions(close_pairs(found, statutes.where("href is not null"), threshold)), strict)
