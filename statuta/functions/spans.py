"""Where patterns occur: spans as array<struct<start,end,text>>, computed without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import LEGISLATION_REF, NUMBERED, OBLIQUE, SECTION

YEAR = r"(?<![\w.])\d{4}(?!\w|\.\w|\.\.)"


#: Stands for a match while a text is cut: a code point that is no character.
_MARK = "\uffff"


#: A list of spans.
_SPANS = "array<struct<start:int,end:int,text:string>>"


def spans(text: Column, pattern: str, first: str = "") -> Column:
    """All matches of a pattern without empty ones, in order, with their code-point offsets.

    The pattern's classes (\\W, \\s) are Unicode's. first: a class that every
    match's first character is of, by which other places are passed over.
    Matches are set between marks and the text is cut at the marks, so that it
    is searched once; texts that hold the mark are cut at the pattern instead.
    The pieces, matches at every second place, are laid end to end: running
    lengths are the offsets. No match and a single one, which most texts have,
    need no fold.
    """
    pattern = f"(?U)(?={first})(?:{pattern})" if first else f"(?U)(?:{pattern})"
    cut = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.filter(F.flatten(F.zip_with(gaps, hits, lambda gap, hit: F.array(gap, hit))), lambda x: x.isNotNull())
    pieces = F.when(text.contains(_MARK), held).otherwise(cut)
    none = F.array().cast(_SPANS)
    span = lambda start, piece: F.struct(start.alias("start"), (start + F.length(piece)).alias("end"), piece.alias("text"))

    def step(acc: Column, piece: Column) -> Column:
        out = F.when(acc["hit"], F.concat(acc["out"], F.array(span(acc["at"], piece)))).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(piece)).alias("at"), (~acc["hit"]).alias("hit"), out.alias("out"))

    def laid(p: Column) -> Column:
        many = F.aggregate(p, F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), none.alias("out")), step, lambda acc: acc["out"])
        return F.when(p.isNull() | (F.size(p) == 1), none).when(F.size(p) == 3, F.array(span(F.length(p[0]), p[1]))).otherwise(many)

    return F.transform(F.array(pieces), laid)[0]


def has_ref(markup: Column) -> Column:
    """False for texts without a ref to legislation."""
    return markup.contains('type="legislation"')


def refs(markup: Column) -> Column:
    """Spans of refs to legislation; null without any."""
    return F.when(has_ref(markup), spans(markup, LEGISLATION_REF, "<"))


#: Whether a text holds an indirect mention: sought from its last word, which is rarer than its first.
_USED = r"(?U)Act(?<=(?:the|this|that|The|This|That)\s(?:[0-9]{4}\s)?Act)"


def used(markup: Column) -> Column:
    """Spans of indirect mentions, numbered ones included; null without any."""
    return F.when(markup.rlike(_USED), spans(markup, f"{NUMBERED}|{OBLIQUE}", "[tT]"))


def sections(markup: Column) -> Column:
    """Spans of section numbers."""
    return spans(markup, SECTION, "[sS]")


def years(text: Column) -> Column:
    """Distinct four-digit tokens."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({YEAR})"), F.lit(1)))
