"""Paragraphs are read once, patterns aren't compiled for each, and nothing is shuffled to bring together what stands in one."""

from pyspark.sql import functions as F

from statuta.functions import markup
from statuta.functions import spans as P
from statuta.operators import oblique, provisions, replacing

REF = '<ref href="h/{0}" uk:canonical="{0} c. 1" uk:type="legislation">Finance Act {0}</ref>'
MARKUP = [
    f"<p>section 3(1) of the {REF.format(1994)} and {REF.format(1995)}, Sections 4, s. 5 (2) of it.</p>",
    "<p>the Act\U0001d4d0 and the 1994 Act; This Act, this 1995\nAct, an Act, the  Act; Acts 7</p>",
    f"<p>￿s 9 {REF.format(1996)}￿ the Act ￿</p>",
    f'<p>{REF.format(1997).replace(" uk:canonical", " x")} {"far off " * 8} section 12 that Act</p>',
    "<p>no place</p>",
    "",
    None,
]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def paragraphs(spark):
    return spark.createDataFrame([("a", k, m) for k, m in enumerate(MARKUP)] + [("b", k, m) for k, m in enumerate(reversed(MARKUP))], "uri string, para_no int, markup string")


def rows(df):
    return sorted(map(str, df.collect()))


def test_spans_are_where_the_pattern_is(spark):
    """Also in texts that hold the mark, or characters of two code units; other first characters are passed over."""
    df = paragraphs(spark)
    for made, plain in ((P.sections, P.SECTION), (P.used, f"{P.NUMBERED}|{P.OBLIQUE}"), (P.refs, P.LEGISLATION_REF)):
        got = df.select("markup", made(F.col("markup")).alias("s"), P.spans(F.col("markup"), plain).alias("t")).collect()
        assert all((r.s or []) == (r.t or []) for r in got) and any(r.s for r in got)
        assert all(r.markup[x.start : x.end] == x.text for r in got for x in r.s or [])
    marked = df.where("para_no = 2").select("uri", P.used(F.col("markup")).alias("s")).where("uri = 'a'").first().s
    assert [x.text for x in marked] == ["the Act"]


def test_paragraphs_are_searched_once(spark, monkeypatch):
    """Uses and mentions come from one pass whose spans are stored."""
    names, store = [], oblique.stored
    monkeypatch.setattr(oblique, "stored", lambda df, name: names.append((name, df.columns)) or store(df, name))
    df = paragraphs(spark)
    used, found = oblique.both(df)
    assert names == [("spans", ["uri", "para", "side", "s"])]
    assert rows(used) == rows(oblique.uses(df)) != [] and rows(found) == rows(oblique.mentions(df)) != []
    oblique.resolved(df)
    assert [n for n, _ in names] == ["spans", "spans"]


def test_statutes_beside_sections_need_no_shuffle(spark):
    df = paragraphs(spark)
    for threshold in (1, 30, 1000):
        joined = provisions.close_pairs(provisions.sections(df), oblique.mentions(df), threshold)
        made = provisions.paired(df, threshold)
        assert "Exchange" not in plan(made) and "Join" not in plan(made)
        assert rows(made.select(*joined.columns)) == rows(joined)
        whole = provisions.meant(provisions.sections(df), oblique.mentions(df), threshold)
        assert rows(provisions.resolved(df, threshold)) == rows(whole)
    assert made.count() > 4


def test_second_splice_only_splices(spark):
    """What the splice doesn't give isn't searched for."""
    docs = spark.createDataFrame([("a", "<d><p>the Act</p></d>"), ("b", "<d><p>x</p></d>")], "uri string, xml string")
    edits = spark.createDataFrame([("a", 0, 3, 10, "<ref>the Act</ref>")], "uri string, para int, start int, end int, tag string")
    made = replacing.splice_second_stage(docs, edits)
    assert "mentions" not in plan(made)
    assert rows(made) == rows(replacing.spliced_at(docs, edits).select("uri", "xml")) != []


def test_texts_without_refs_are_not_cut(monkeypatch):
    """Clean-up walks the tags of texts with refs only, and keeps to what it does with tags cut off or hidden."""
    texts = {"<p>a</p><ref a": "<p>a</p>", "x<ref a": "x<ref a", "</ref>": "</ref>", "<!-- <ref> --><ref>b</ref>": "<!-- <ref> -->b", "<ref><ref origin='x'>c</ref></ref><ref/>": "<ref origin='x'>c</ref>", '<a t="<ref>"><reference>': '<a t="<ref>"><reference>'}
    assert {t: markup.sanitise(t) for t in texts} == texts
    monkeypatch.setattr(markup, "_PIECES", None)
    assert markup.sanitise('<p>x</p><FRBRdate name="enriched"/><uk:enrichment-engine>0</uk:enrichment-engine>') == "<p>x</p>"
