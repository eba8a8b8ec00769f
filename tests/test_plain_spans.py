"""Spans sought by their first letters are those of the shared patterns."""

import random
import re

from statuta.functions import markup
from statuta.functions import patterns as P


def test_spans_are_the_patterns():
    r = random.Random(9)
    pieces = ["<ref", "ref>", "</ref>", ' type="legislation"', ' href="a"', ">", "\n", " ", "section", "Sections", "s", "S", "ss", " ", ".", "12", "(3)", "the", "This", "that", "Act", " 1994 ", " Act", "x", "é"]
    ref = re.compile(P.LEGISLATION_REF.replace(".", r"[^\n\r\x85\u2028\u2029]"))
    held = [0, 0, 0]
    for _ in range(20_000):
        t = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        got = [list(markup._refs(t)), [m.span() for m in markup._USE.finditer(t)], [m.span() for m in markup._SECTION.finditer(t)]]
        want = [[m.span() for m in p.finditer(t)] for p in (ref, re.compile(f"{P.NUMBERED}|{P.OBLIQUE}"), re.compile(P.SECTION))]
        assert got == want, t
        held = [n + len(w) for n, w in zip(held, want, strict=True)]
    assert min(held) > 50


def test_refs_are_found_without_a_step_for_each_character():
    """The tempered pattern walked every character of every <ref that has no type."""
    t = "<ref " * 4000 + 'type="legislation"'
    assert list(markup._refs(t)) == []
