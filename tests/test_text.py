"""Golden cases of the Python text and markup functions."""

import json
import random
import re
import time
import timeit

import numpy as np
import pytest

from statuta.functions import intervals as I
from statuta.functions import markup as M
from statuta.functions import text as T
from statuta.functions import titles as N
from statuta.operators import replacing
from statuta.operators import rules as R


def test_similarity_golden():
    assert T.token_sort_ratio("Adoption Children Act 2002", "Adoption and Children Act 2002") == 93
    assert T.token_sort_ratio("Adoption Children Act", "Adoption and Children Act") == 91
    assert T.lcs("abcde", "ace") == 3 and T.lcs("", "a") == 0


def test_best_window_is_anchored_at_the_end():
    title = T.Likeness("Adoption and Children Act 2002", 90, 5)
    text = "under the Adoption  Children Act 2002"
    assert title.best(T.Window(text, len(text))) == (93, 10)
    assert title.best(T.Window("Adoption Act 2002", 17)) is None and title.best(T.Window("", 0)) is None
    assert title.best(T.Window("of Adoption and Children Act 2002 x", 33)) == (100, 3)


def test_bounds_lose_no_window():
    r = random.Random(4)
    words = "the of Finance Act Companies and Order Duties Customs 2002 1999".split()
    for _ in range(500):
        title, text = (" ".join(r.choice(words) for _ in range(r.randint(1, 9))) for _ in range(2))
        want = None
        for n in range(1, len(title.split()) + 6):
            run = text.split()[-n:]
            score = T.token_sort_ratio(" ".join(run), title)
            if score >= 70 and (want is None or score > want):
                want = score
            if n >= len(text.split()):
                break
        got = T.Likeness(title, 70, 5).best(T.Window(text, len(text)))
        assert (got and got[0]) == want


def test_window_of_any_length():
    title = " ".join(f"Regulation{k} of" for k in range(150)) + " Act 2002"  # some 2000 characters
    near = title.replace("Regulation7 ", "Regulations7 ")
    got = T.Likeness(title, 90, 5).best(T.Window("under the " + near, 10 + len(near)))
    assert got[0] >= 99 and got[1] < 100


def test_words_before_a_place():
    assert [T.last_words("a  bc d ", 8, n) for n in range(5)] == [8, 6, 3, 0, 0]


def test_titles_are_whole_words():
    trie = N.Trie(["CA 2002", "CA", " Act", "CA  2003"], [["2003", "2002"], None, None, None])
    find = lambda text, years: [(trie.phrases[p], s, y) for _, p, s, y in zip(*trie.find([text], [years]), strict=True)]
    assert find("XCA 2002 CA 2002x, CA 2002 Act", ["2002"]) == [("CA", 9, None), ("CA", 19, None), ("CA 2002", 19, "2002"), (" Act", 26, None)]
    assert find("CA 2002", []) == find("CA 2002", None) == [("CA", 0, None)] and find(None, None) == find("", []) == []
    assert find("CA  2003 CA 2003", []) == [("CA", 0, None), ("CA  2003", 0, None), ("CA", 9, None)]
    assert N.Trie([]).find(["a"], [None]) == ([], [], [], []) and N.Trie(["", " "]).find(["a "], [None])[0] == []
    assert T.act_years("Pact 2002, Act 2003, Act 20045") == [(19, "2003")]


def test_trie_equals_plain_search():
    r = random.Random(6)
    some = ["The", "the", "Order", "No", ".", "1", "12", "(", ")", "of", "Act", "é"]
    for _ in range(200):
        say = lambda n: "".join(r.choice(some) + r.choice((" ", " ", " ", "", "  ")) for _ in range(r.randint(1, n)))
        phrases, texts = sorted({say(4) for _ in range(12)}), [say(40) for _ in range(5)]
        text, phrase, start, _ = N.Trie(phrases).find(texts, [None] * 5)
        want = [(k, p, i) for k, t in enumerate(texts) for p in phrases for i in range(len(t)) if T.stands_at(t, p, i)]
        assert sorted(zip(text, (phrases[p] for p in phrase), start, strict=True)) == sorted(want)


def test_time_does_not_follow_the_number_of_titles():
    r = random.Random(2)
    some = ["The"] + [f"w{k}" for k in range(300)]
    text, took = " ".join(r.choice(["The", "of", *some[:40]]) for _ in range(6000)), []
    for n in (1_000, 50_000):
        trie = N.Trie(sorted({"The " + " ".join(r.choice(some) for _ in range(r.randint(1, 7))) for _ in range(n)}))
        took.append(min(timeit.repeat(lambda t=trie: t.find([text], [None]), number=3, repeat=5)))
    assert took[1] < 2 * took[0]


LAW = "Finance Companies Housing Adoption Children and of the Criminal Justice Local Government Planning Energy Health Social Care Transport Education Police Road Traffic Wales Scotland Water Industry Insolvency Pensions Electricity Agriculture Merchant Shipping Income Tax Rent Land".split()


def edited(r, title, most):
    t = list(title)
    for _ in range(r.randint(0, most)):
        k = r.randrange(max(1, len(t) - 9))
        kind = r.random()
        if kind < 0.4:
            del t[k]
        elif kind < 0.8:
            t.insert(k, r.choice("abc e"))
        else:
            t[k] = "x"
    return "".join(t)


@pytest.mark.parametrize("cutoff", [70, 90, 97])
def test_index_loses_no_pair(cutoff):
    assert N.FEW < 200
    r = random.Random(cutoff)
    titles = sorted({" ".join(r.choice(LAW) for _ in range(r.randint(1, 6))) + r.choice((" Act 1998", " Act 1998", " Act 1998 (short)")) for _ in range(300)})
    index, every = N.NearTitles(titles, cutoff, 5), [T.Likeness(t, cutoff, 5) for t in titles]
    for _ in range(200):
        text = "it was said of " + edited(r, r.choice(titles), 7)
        window = T.Window(text, len(text))
        assert {(titles[k], s, at) for k, s, at in index.find(window)} == {(x.title, *b) for x in every if (b := x.best(window))}
    if cutoff == 90:
        assert index.compared < 0.02 * index.pairs


def test_containment_sweeps_equal_pairs():
    r = np.random.default_rng(1)
    for _ in range(150):
        n = int(r.integers(1, 50))
        g, idx, s, c = r.integers(0, 4, n), r.permutation(n), r.integers(0, 30, n), r.integers(0, 4, n)
        e = s + r.integers(0, 15, n)
        for strict in (False, True):
            want = np.zeros(n, bool)
            for a in range(n):
                for b in range(n):
                    inside = s[a] >= s[b] and e[a] <= e[b] or not strict and s[b] >= s[a] and e[b] <= e[a]
                    if g[a] == g[b] and idx[a] < idx[b] and inside:
                        want[a if c[a] <= c[b] else b] = True
            assert (I.losers(g, idx, s, e, c, strict) == want).all()


def test_a_hundred_thousand_nested_hits():
    n = 100_000
    for strict in (False, True):
        began = time.time()
        lost = I.losers(np.zeros(n, int), np.random.default_rng(2).permutation(n), np.arange(n), 2 * n - np.arange(n), np.random.default_rng(3).integers(90, 101, n), strict)
        assert time.time() - began < 5 and lost.sum() > n // 2


def test_abbreviations():
    assert T.abbreviations('the Value Added Tax ("VAT")') == [("VAT", "Value Added Tax", 20)]
    assert [x[:2] for x in T.abbreviations('found in the Companies Act 2006 ("CA 2006")')] == [("CA 2006", "Companies Act 2006")]
    assert T.abbreviations("Value Added Tax (VAT)") == []
    assert T.abbreviations('Value Added Tax ("vat")') == []
    assert len(T.abbreviations('Value Added Tax ("VAT") and Very Angry Toad ("VAT")')) == 1
    assert T.abbreviations(None) == T.abbreviations("") == []


def test_alignment():
    long_form = "of the Upper Tribunal"
    assert long_form[T.align(long_form, '"UT"') :] == "Upper Tribunal"
    assert T.align("nothing here", "XYZ") is None


def test_tokens_keep_inner_stops():
    assert [t for _, _, t in T.tokens("[2022] 1 W.L.R. 123, Case C-123/12")] == ["[", "2022", "]", "1", "W.L.R.", "123", ",", "Case", "C-123/12"]


def test_rule_patterns():
    p = [{"ORTH": "["}, {"SHAPE": "dddd"}, {"ORTH": "]"}, {"LIKE_NUM": "true"}, {"ORTH": "WLR"}, {"LIKE_NUM": "true"}]
    rule = R.Rules([("wlr", json.dumps(p))])
    assert R.hits("see [2022] 1 WLR 123.", rule) == [(4, 20, "[2022] 1 WLR 123", "wlr")]
    assert R.hits("see [2022] 1 W.L.R. 123", rule) == []
    assert R.hits(None, rule) == []
    assert R.hits("Twenty PD ten", R.Rules([("pd", json.dumps([{"LIKE_NUM": "true"}, {"ORTH": "PD"}, {"LIKE_NUM": "true"}]))])) == [(0, 13, "Twenty PD ten", "pd")]
    many = R.Rules([("any", json.dumps([{"ORTH": "No"}, {"ORTH": ".", "OP": "*"}, {"LIKE_NUM": "true"}]))])
    assert [m for *_, m, _ in R.hits("No 5, No . 5 and No . . 5", many)] == ["No 5", "No . 5", "No . . 5"]


def test_longest_hit_wins():
    parts = ("[", "2022", "]", "UKSC", "12")
    rule = R.Rules([("short", json.dumps([{"ORTH": "UKSC"}, {"ORTH": "12"}])), ("long", json.dumps([{"ORTH": t} for t in parts]))])
    assert R.hits("[2022] UKSC 12", rule) == [(0, 14, "[2022] UKSC 12", "long")]


def test_sanitise():
    own, foreign = '<ref uk:origin="OWN">a <ref>b</ref></ref>', '<ref uk:origin="other">c</ref>'
    assert M.sanitise(f"<p>{own}{foreign}</p>") == f"<p>a b{foreign}</p>"
    assert M.sanitise('<x><FRBRdate date="d" name="enriched"/><FRBRdate date="e" name="made"/></x>') == '<x><FRBRdate date="e" name="made"/></x>'
    assert M.sanitise(None) is None


def test_splice_all_leaves_tags_and_refs_alone():
    body = '<p title="the Act">the Act <ref>the Act</ref> and the Act\'s "b" &amp; c</p>'
    out = M.splice_all(body, [("the Act", "<ref>T</ref>"), ('"b" & c', "<ref>Q</ref>")])
    assert out == '<p title="the Act"><ref>T</ref> <ref>the Act</ref> and <ref>T</ref>\'s <ref>Q</ref></p>'
    assert M.splice_all("<p>a a</p>", [("a", "<ref>a</ref>")], first_only=True) == "<p><ref>a</ref> a</p>"
    assert M.splice_all("<p>x</p>", []) == "<p>x</p>" and M.splice_all(None, [("a", "b")]) is None


def test_splice_keeps_the_text():
    body = "<p>Finance Act 2002 and Finance Act</p>"
    out = M.splice_all(body, [("Finance Act", "<ref>Finance Act</ref>"), ("Finance Act 2002", "<ref>Finance Act 2002</ref>")])
    assert M.without_tags(out) == M.without_tags(body) and out.count("<ref>") == 2
    again = M.splice_all(M.sanitise(out), [("Finance Act", "<ref>Finance Act</ref>"), ("Finance Act 2002", "<ref>Finance Act 2002</ref>")])
    assert again == out


def test_splice_at_skips_overlaps():
    assert M.splice_at("abcdef", [(4, 6, "X"), (0, 2, "Y"), (1, 3, "Z")]) == "YcdX"


def test_stamp_and_errors():
    xml = '<a><FRBRManifestation><FRBRdate date="1" name="x"/></FRBRManifestation><proprietary></proprietary></a>'
    out, error = M.stamp(xml, "2024-01-01T00:00:00")
    assert error is None and M.well_formed(out) and '<FRBRdate date="2024-01-01T00:00:00" name="enriched"/>' in out
    assert M.stamp("<a/>", "t") == (None, "no proprietary element")
    assert M.stamp("<a><proprietary></proprietary></a>", "t") == (None, "no manifestation date")


def test_body_text_and_paragraphs():
    assert M.body_text("<j><content> a <p>b</p></content><intro>c</intro><x>d</x></j>") == "a b c"
    assert M.body_text("<broken") == "" and M.body_text(None) == ""
    assert [m for _, _, m in M.paragraphs('<p>a</p><pre>x</pre><p class="b">c</p>')] == ["<p>a</p>", '<p class="b">c</p>']


def test_canonical_equality():
    assert M.equal_xml('<a b="1"  c="2"/>', '<a c="2" b="1"></a>')


def test_paragraphs_are_those_of_the_markup():
    xml = '<d><!-- <p>no</p> --><p a="1 > 0">one<p>two <b>x</b></p><![CDATA[</p>]]></p><?x <p> ?><p/><pre>no</pre><p>new <!-- </p> --> tail</p ></d>'
    found = M.paragraphs(xml)
    assert [m for *_, m in found] == ['<p a="1 > 0">one<p>two <b>x</b></p><![CDATA[</p>]]></p>', "<p>two <b>x</b></p>", "<p/>", "<p>new <!-- </p> --> tail</p >"]
    assert all(xml[a:b] == m for a, b, m in found) and M.paragraphs(None) == []
    assert [m for *_, m in M.paragraphs("<p/><p>a<br><p>b</p> <p>c</p><p>d")] == ["<p/>", "<p>a<br><p>b</p>", "<p>c</p>"]


def test_splices_keep_the_rest_byte_for_byte():
    xml = '<d>é<!-- the Act --><p a="the Act > x">one the Act <p>two the Act</p><![CDATA[the Act]]></p><p>new <!-- the Act </p> --> the Act</p></d>'
    edits = [{"para": u["para"], "start": u["start"], "end": u["end"], "tag": "[T]"} for u in M.uses(xml)]
    assert len(edits) == 7
    want = xml.replace("one the Act", "one [T]").replace("two the Act", "two [T]").replace("--> the Act</p></d>", "--> [T]</p></d>")
    assert replacing.resplice(xml, edits) == want and replacing.resplice(xml, None) == xml


def test_mentions_are_spliced_leftmost_and_longest_first():
    r = random.Random(8)
    for _ in range(300):
        mentions = {"".join(r.choice("ab ") for _ in range(r.randint(1, 4))): f"[{k}]" for k in range(5)}
        text = "".join(r.choice("ab ") for _ in range(60))
        pattern = re.compile("|".join(re.escape(m) for m in sorted(mentions, key=lambda m: (-len(m), m))))
        assert M.splice_all(f"<p>{text}</p>", list(mentions.items())) == f"<p>{pattern.sub(lambda m, of=mentions: of[m[0]], text)}</p>"
