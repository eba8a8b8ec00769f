"""Scalar functions, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Citation types by the numbers that a citation holds.
YEAR_NUMBER = ("NCitYearAbbrNum", "NCitYearAbbrNumDiv", "PubYearAbbrNum")
YEAR_TWO_NUMBERS = ("NCitYearAbbrNumUnderNumDiv", "NCitYearAbrrNumStrokeNum", "PubYearNumAbbrNum")
TWO_NUMBERS = ("PubAbbrNumAbbrNum", "PubNumAbbrNum", "EUCCase", "EUTCase")


def digits(s: Column) -> Column:
    """All runs of digits, in order."""
    return F.regexp_extract_all(s, F.lit(r"(?U)(\d+)"), F.lit(1))


def number(s: Column, k: int) -> Column:
    """The k-th run of digits, from 0; null where there are fewer."""
    return F.get(digits(s), F.lit(k))


def create_uri(template: Column, year: Column, d1: Column, d2: Column) -> Column:
    """A template that names d1 takes year and d1; else one that names d2 takes year, d1 and d2; else as it is; '#' without one."""
    with_d1 = F.replace(F.replace(template, F.lit("year"), year), F.lit("d1"), d1)
    with_d2 = F.replace(F.replace(F.replace(template, F.lit("year"), year), F.lit("d1"), d1), F.lit("d2"), d2)
    made = F.when(template.contains("d1"), with_d1).when(template.contains("d2"), with_d2).otherwise(template)
    return F.when(template.isNull(), F.lit("#")).otherwise(made)


def corrected_citation(kind: Column, match: Column, canonical: Column) -> Column:
    """The canonical form filled with the match's numbers; null for an unknown type or missing numbers."""
    c0, c1, c2 = (number(match, k) for k in range(3))
    year_first = F.replace(canonical, F.lit("dddd"), c0)
    return (
        F.when(kind.isin(*YEAR_NUMBER), F.replace(year_first, F.lit("d+"), c1))
        .when(kind.isin(*YEAR_TWO_NUMBERS), F.replace(F.replace(year_first, F.lit("d1"), c1), F.lit("d2"), c2))
        .when(kind.isin(*TWO_NUMBERS), F.replace(F.replace(canonical, F.lit("d1"), c0), F.lit("d2"), c1))
    )


def citation_parts(kind: Column, match: Column) -> tuple[Column, Column, Column]:
    """(year, d1, d2): types without a year have '' there; a missing d2 is ''."""
    has_year = kind.contains("Year")
    c0, c1, c2 = (number(match, k) for k in range(3))
    return F.when(has_year, c0).otherwise(F.lit("")), F.when(has_year, c1).otherwise(c0), F.coalesce(F.when(has_year, c2).otherwise(c1), F.lit(""))


def fixed_year(year: Column) -> Column:
    """The first run of digits, null without one."""
    return F.nullif(F.regexp_extract(year, r"(\d+)", 1), F.lit(""))


def title_year(title: Column) -> Column:
    """The first four digits, '' without any."""
    return F.regexp_extract(title, r"(\d{4})", 1)


def split_title_year(title: Column) -> tuple[Column, Column]:
    """A title less its last four characters, and these."""
    return F.substring(title, F.lit(1), F.greatest(F.length(title) - 4, F.lit(0))), F.right(title, F.lit(4))


def is_for_fuzzy(title: Column) -> Column:
    return title.rlike(r"Act\s+(\d{4})")


def section_number(section: Column) -> Column:
    """The first run of digits."""
    return F.regexp_extract(section, r"(\d+)", 1)


def section_href(href: Column, n: Column) -> Column:
    return F.concat(href, F.lit("/section/"), n)


def section_canonical(canonical: Column, n: Column) -> Column:
    """'' where the statute has no canonical form."""
    return F.when(F.coalesce(canonical, F.lit("")) == "", F.lit("")).otherwise(F.concat(canonical, F.lit(" s. "), n))


def sub_section_href(href: Column, mention: Column) -> Column:
    """With '/' and the first bracketed number, where the mention has one."""
    sub = F.regexp_extract(mention, r"\((\d+)\)", 1)
    return F.when(sub == "", href).otherwise(F.concat(href, F.lit("/"), sub))


def html_escape(s: Column) -> Column:
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(raw), F.lit(name))
    return s


def ref_tag(content: Column, attributes: list[tuple[str, Column]], tag: str = "ref") -> Column:
    """<ref a="..">content</ref>; null attributes are left out, values escaped; content is put in as markup."""
    parts = [F.coalesce(F.concat(F.lit(f' {name}="'), html_escape(value), F.lit('"')), F.lit("")) for name, value in attributes]
    return F.concat(F.lit(f"<{tag}"), *parts, F.lit(">"), content, F.lit(f"</{tag}>"))


def header_split(xml: Column) -> tuple[Column, Column, Column]:
    """(before, tag, after) at the first </header>, else the first <header/>; else everything is after."""
    closing, single = F.instr(xml, "</header>"), F.instr(xml, "<header/>")
    at = F.when(closing > 0, closing).otherwise(single)
    size = F.when(closing > 0, F.lit(9)).when(single > 0, F.lit(9)).otherwise(F.lit(0))
    before = F.when(at > 0, F.substring(xml, F.lit(1), at - 1)).otherwise(F.lit(""))
    tag = F.when(at > 0, F.substring(xml, at, size)).otherwise(F.lit(""))
    after = F.when(at > 0, F.substring(xml, at + size, F.length(xml))).otherwise(xml)
    return before, tag, after


def xml_declaration(xml: Column) -> tuple[Column, Column]:
    """(declaration or '', the rest)."""
    head = F.regexp_extract(xml, r"^(<\?xml[^>]*\?>)", 1)
    return head, F.substring(xml, F.length(head) + 1, F.length(xml))


def document_key(object_key: Column) -> Column:
    """An object's key, URL-decoded, without .xml at the end."""
    return F.regexp_replace(F.url_decode(object_key), r"\.xml$", "")


def stamp_time() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
