"""XML handled as strings: body text, paragraphs, clean-up and splicing. Standard library only."""

from __future__ import annotations

import functools
import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass

_PIECES = re.compile(r"(<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<[^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*>|<[^>]+>)", re.S)
_NAME = re.compile(r"</?([^\s/>]+)")
#: What may hide a paragraph's tags, and these.
_PARAGRAPH = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<\?.*?(?:\?>|\Z)|<(?P<end>/?)p(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.S)
_REF_BEGINS = re.compile(r"<ref[\s/>]")
_BODY = re.compile("content|intro|wrapUp")


@dataclass(frozen=True)
class Profile:
    """Names by which a deployment marks its own annotations."""

    origin: str = "OWN"
    prefix: str = "uk"
    namespace: str = "urn:statuta:akn"
    engine_tag: str = "enrichment-engine"
    date_name: str = "enriched"
    version: str = "1.0.0"


@functools.cache
def _attribute(name: str) -> re.Pattern:
    return re.compile(rf"[\s:]{re.escape(name)}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def attribute(tag: str, name: str) -> str | None:
    """An attribute's value in an opening tag, with or without a prefix."""
    m = _attribute(name).search(tag)
    return None if m is None else html.unescape(m[1] if m[1] is not None else m[2])


def body_text(xml: str | None) -> str:
    """Text of elements whose name holds content, intro or wrapUp, each stripped, joined by a space; nested ones count again."""
    if not xml:
        return ""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return ""
    found = []
    for element in root.iter():
        name = element.tag.rpartition("}")[2] if isinstance(element.tag, str) else ""
        if _BODY.search(name):
            found.append("".join(element.itertext()).strip())
    return " ".join(found)


def paragraphs(xml: str | None) -> list[tuple[int, int, str]]:
    """(start, end, markup) of every <p>, in the order in which they begin; one inside another is one of its own.

    Tags in comments, CDATA sections and processing instructions aren't tags.
    Where some paragraph isn't closed, as in web pages, none is taken to be
    inside another: each ends at the next closing tag.
    """
    tags = [m for m in _PARAGRAPH.finditer(xml or "") if m["end"] is not None]
    found: list[list] = []
    open_: list[int] = []
    for m in tags:
        if m["end"]:
            if open_:
                found[open_.pop()][1] = m.end()
        else:
            if not m[0].endswith("/>"):
                open_.append(len(found))
            found.append([m.start(), m.end()])
    if open_:
        found, start = [], None
        for m in tags:
            if not m["end"] and start is None:
                start = m.start()
            if start is not None and (m["end"] or m[0].endswith("/>") and start == m.start()):
                found.append([start, m.end()])
                start = None
    return [(start, end, xml[start:end]) for start, end in found]


def sanitise(xml: str | None, profile: Profile = Profile()) -> str | None:
    """Without earlier annotations: own refs (own origin or none) give way to their content; the stamps go; foreign refs stay."""
    if xml is None:
        return None
    date, engine = _stamps(profile)
    if "<FRBRdate" in xml:
        xml = date.sub("", xml)
    if f"<{profile.prefix}:{profile.engine_tag}" in xml:
        xml = engine.sub("", xml)
    if "<ref" not in xml and "</ref" not in xml:
        return xml
    places = [m.span() for m in _PIECES.finditer(xml)]
    places.append((places[-1][1] if places else 0, len(xml)))  # the rest, which a tag cut off may begin
    out, kept, at = [], [], 0
    for start, end in places:
        if xml.startswith("</ref", start):
            own = bool(kept) and not kept.pop()
        elif _REF_BEGINS.match(xml, start):
            own = attribute(xml[start:end], "origin") in (None, profile.origin)
            if not xml.endswith("/>", start, end):
                kept.append(not own)
        else:
            continue
        if own:
            out.append(xml[at:start])
            at = end
    return "".join([*out, xml[at:]])


@functools.cache
def _stamps(profile: Profile) -> tuple[re.Pattern, re.Pattern]:
    """Patterns of a profile's date and engine elements."""
    engine = rf"{re.escape(profile.prefix)}:{re.escape(profile.engine_tag)}"
    return (
        re.compile(rf"<FRBRdate\b[^>]*\bname=[\"']{re.escape(profile.date_name)}[\"'][^>]*?(?:/>|>\s*</FRBRdate>)"),
        re.compile(rf"<{engine}\b[^>]*?(?:/>|>.*?</{engine}>)", re.S),
    )


def splice_all(body: str | None, replacements: list[tuple[str, str]], first_only: bool = False) -> str | None:
    """Every mention in a text node becomes its tag, in one pass: longest mention first, none inside a ref or abbr, none in a tag.

    replacements: (mention as plain text, markup). first_only: the first
    occurrence of each mention in each text node.
    """
    if body is None:
        return None
    of: dict[str, str] = {}
    for mention, tag in replacements:
        of.setdefault(html.escape(mention, quote=False), tag)
    of.pop("", None)
    if not of:
        return body
    mentions = sorted(m for m in of if m in body)
    if not mentions:
        return body
    out, inside = [], 0
    for piece in _PIECES.split(body):
        if piece.startswith("<") and piece.endswith(">"):
            name = _NAME.match(piece)
            if name and name[1] in ("ref", "abbr") and not piece.endswith("/>"):
                inside += -1 if piece.startswith("</") else 1
            out.append(piece)
        elif inside > 0 or not piece:
            out.append(piece)
        else:
            # where each mention stands next; the leftmost goes first, of these the longest
            places, at, done = {m: k for m in mentions if (k := piece.find(m)) >= 0}, 0, set()
            while places:
                m = min(places, key=lambda m: (places[m], -len(m), m))
                out += [piece[at : places[m]], m if first_only and m in done else of[m]]
                at = places[m] + len(m)
                done.add(m)
                for other in [o for o, k in places.items() if k < at]:
                    if (k := piece.find(other, at)) >= 0:
                        places[other] = k
                    else:
                        del places[other]
            out.append(piece[at:])
    return "".join(out)


def splice_at(markup: str | None, replacements: list[tuple[int, int, str]]) -> str | None:
    """Markup with the pieces [start, end) exchanged; a piece that overlaps an earlier one is left alone."""
    if markup is None:
        return None
    out, at = [], 0
    for start, end, tag in sorted(replacements):
        if start < at:
            continue
        out += [markup[at:start], tag]
        at = end
    return "".join([*out, markup[at:]])


def free_of_markup(markup: str, start: int, end: int) -> bool:
    """Whether [start, end) lies in text, outside tags and refs."""
    at = inside = 0
    for piece in _PIECES.split(markup):
        stop = at + len(piece)
        if start < stop:
            return not inside and not piece.startswith("<") and end <= stop
        name = _NAME.match(piece) if piece.startswith("<") else None
        if name and name[1] == "ref" and not piece.endswith("/>"):
            inside += -1 if piece.startswith("</") else 1
        at = stop
    return False


def without_tags(xml: str | None) -> str:
    return re.sub(r"<[^>]+>", "", xml or "")


def well_formed(xml: str | None) -> bool:
    if not xml or '="<' in xml:
        return False
    try:
        ET.fromstring(xml)
    except ET.ParseError:
        return False
    return True


def canonical(xml: str | None) -> str | None:
    """C14N 2.0."""
    return None if xml is None else ET.canonicalize(xml)


def equal_xml(a: str, b: str) -> bool:
    """Equal after canonicalisation, spaces and line breaks aside."""
    return re.sub("[ \n]", "", canonical(a)) == re.sub("[ \n]", "", canonical(b))


def stamp(xml: str | None, when: str, profile: Profile = Profile()) -> tuple[str | None, str | None]:
    """(xml with the engine's version and date, error): the version ends <proprietary>, the date follows the manifestation's."""
    if xml is None:
        return None, "no document"
    if not (m := re.search(r"</proprietary\s*>", xml)):
        return None, "no proprietary element"
    engine = f'<{profile.prefix}:{profile.engine_tag} xmlns:{profile.prefix}="{profile.namespace}">{profile.version}</{profile.prefix}:{profile.engine_tag}>'
    out = xml[: m.start()] + engine + xml[m.start() :]
    d = re.search(r"<FRBRManifestation\b.*?<FRBRdate\b[^>]*?(?:/>|>\s*</FRBRdate>)", out, re.S)
    if not d or "</FRBRManifestation" in d[0]:
        return None, "no manifestation date"
    return f'{out[: d.end()]}<FRBRdate date="{when}" name="{profile.date_name}"/>{out[d.end() :]}', None


#: What a ref to legislation holds, and what it may not run across.
_LEGISLATION, _LINE_END = 'type="legislation"', re.compile("[\n\r\x85\u2028\u2029]")
_REF_TAG = re.compile(r"<ref[^>]*>")
_REF_VALUES = {name: re.compile(rf'[\s:]{name}="([^"]*)"') for name in ("href", "canonical")}
#: The same spans as NUMBERED or OBLIQUE, and as SECTION, sought by the one letter that each begins with.
_USE = re.compile(r"[tT](?:he|his|hat)\s(?:[0-9]{4}\s)?Act")
_SECTION = re.compile(r"[sS](?:ections?\W*[0-9]+|(?<!\w[sS])[sS]*\W*[0-9]+)(?:\W*\([0-9]+\))?")
_TAG, _YEAR, _DIGITS = re.compile("<[^>]+>"), re.compile("[0-9]{4}"), re.compile("[0-9]+")


def _refs(markup: str) -> Iterator[tuple[int, int]]:
    """Spans of LEGISLATION_REF: from <ref to the first ref>, with the type and without a line's end between."""
    start = markup.find("<ref") if _LEGISLATION in markup else -1
    while start >= 0:
        end = markup.find("ref>", start + 4)
        if end < 0:
            return
        found = markup.find(_LEGISLATION, start + 4, end) >= 0 and not _LINE_END.search(markup, start + 4, end)
        if found:
            yield start, end + 4
        start = markup.find("<ref", end + 4 if found else start + 1)


def mentions(xml: str | None, found: list[tuple[int, int, str]] | None = None) -> list[dict]:
    """(para, start, end, detected_leg, href, canonical, year) of refs to legislation, by paragraph. found: the document's paragraphs, where they are known."""
    out = []
    for k, (_, _, markup) in enumerate(paragraphs(xml) if found is None else found):
        for start, end in _refs(markup):
            ref = markup[start:end]
            tag = _REF_TAG.match(ref)
            values = {name: (v[1] or None) if tag and (v := p.search(tag[0])) else None for name, p in _REF_VALUES.items()}
            text = _TAG.sub("", ref)
            year = _YEAR.search(text)
            out.append({"para": k, "start": start, "end": end, "detected_leg": text, **values, "year": year[0] if year else ""})
    return out


def uses(xml: str | None, found: list[tuple[int, int, str]] | None = None) -> list[dict]:
    """(para, start, end, detected_ref, kind, year) of indirect mentions, by paragraph; found as for ``mentions``."""
    out = []
    for k, (_, _, markup) in enumerate(paragraphs(xml) if found is None else found):
        for m in _USE.finditer(markup) if "Act" in markup else ():
            year = _YEAR.search(m[0])
            out.append({"para": k, "start": m.start(), "end": m.end(), "detected_ref": m[0], "kind": "numbered_act" if year else "act", "year": year[0] if year else ""})
    return out


def sections(xml: str | None, found: list[tuple[int, int, str]] | None = None) -> list[dict]:
    """(para, start, end, section, section_no), by paragraph; found as for ``mentions``."""
    return [{"para": k, "start": m.start(), "end": m.end(), "section": m[0], "section_no": _DIGITS.search(m[0])[0]} for k, (_, _, markup) in enumerate(paragraphs(xml) if found is None else found) for m in _SECTION.finditer(markup)]
