"""Operators against goldens and against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from statuta import catalog
from statuta.functions import scalars as S
from statuta.functions import spans as P
from statuta.operators import legislation, lookup, oblique, provisions, replacing

SF = "/root/testdata/sf0.001"
SLOW = {"enrich_judgments", "fuzzy_titles"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.sql(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLE_SQL) - SLOW))
def test_against_duckdb(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).values.tolist()))
    assert plain(got) == plain(want)


def test_corrections(spark):
    rows = [
        ("PubNumAbbrNum", "1 ExD 123", "d1 ExD d2", "1 ExD 123", ""),
        ("PubYearAbbrNum", "[2022] P.N.L.R 123", "[dddd] PNLR d+", "[2022] PNLR 123", "2022"),
        ("PubYearNumAbbrNum", "(1995) 99 Cr. App. R. 123", "(dddd) d1 Cr App R d2", "(1995) 99 Cr App R 123", "1995"),
        ("NCitYearAbbrNumDiv", "(2026) EWHC 789 (Fam)", "[dddd] EWHC d+ (Fam)", "[2026] EWHC 789 (Fam)", "2026"),
        ("Nonsense", "1", "x", None, ""),
    ]
    df = spark.createDataFrame(rows, "kind string, m string, form string, want string, year string")
    got = df.select("want", "year", S.corrected_citation(df.kind, df.m, df.form).alias("got"), S.citation_parts(df.kind, df.m)[0].alias("y")).collect()
    assert all(r.got == r.want for r in got) and all(r.y == r.year for r in got)


def test_scalars(spark):
    df = spark.createDataFrame([("Section 140.2(1)(A)", "No Year", "a</header>b"), ("Section 67(1)", "x 2001", "a<header/>b"), (None, None, None)], "s string, y string, x string")
    b, t, a = S.header_split(df.x)
    got = df.select(S.section_number(df.s).alias("n"), S.fixed_year(df.y).alias("y"), b.alias("b"), t.alias("t"), a.alias("a")).collect()
    assert [(r.n, r.y, r.b, r.t, r.a) for r in got[:2]] == [("140", None, "a", "</header>", "b"), ("67", "2001", "a", "<header/>", "b")]


def test_spans_and_years(spark):
    df = spark.createDataFrame([("This Act, the Act and that Act",), ("none",), (None,)], "t string")
    got = [r[0] for r in df.select(P.spans(df.t, P.OBLIQUE)).collect()]
    assert [[x.text for x in g] for g in got] == [["This Act", "the Act", "that Act"], [], []] and [x.start for x in got[0]] == [0, 10, 22]
    y = spark.createDataFrame([("what [2022] 2017 and 2013 and 1974",), ("..2002..",)], "t string")
    assert [sorted(r[0]) for r in y.select(P.years(y.t)).collect()] == [["1974", "2013", "2017", "2022"], []]


def hits(spark, rows):
    return spark.createDataFrame(rows, "uri string, idx int, start int, end int, confidence int")


def test_overlaps(spark):
    tie = legislation.resolve_overlaps(hits(spark, [("u", 0, 1, 5, 90), ("u", 1, 1, 5, 90), ("u", 2, 1, 5, 90)]))
    assert [r.idx for r in tie.collect()] == [2]
    best = legislation.resolve_overlaps(hits(spark, [("u", 0, 1, 5, 95), ("u", 1, 1, 5, 90), ("u", 2, 9, 12, 50), ("v", 3, 2, 3, 1)]))
    assert sorted(r.idx for r in best.collect()) == [0, 2, 3]
    later_inside = [("u", 0, 0, 9, 90), ("u", 1, 2, 3, 80)]
    assert legislation.resolve_overlaps(hits(spark, later_inside), strict=True).count() == 2
    assert legislation.resolve_overlaps(hits(spark, later_inside)).count() == 1


def test_fuzzy_match(spark):
    docs = spark.createDataFrame([("u", "relies on the Adoption Children Act 2002 here"), ("v", "Adoption and Children Act 2003"), ("w", None)], "uri string, text string")
    table = spark.createDataFrame([("r", "2002 c. 38", 2002, "Adoption and Children Act 2002", True)], "ref string, citation string, year long, candidate_titles string, for_fuzzy boolean")
    got = legislation.fuzzy_hits(docs, table).collect()
    assert [(r.uri, r.confidence, r.detected_ref) for r in got] == [("u", 93, "Adoption Children Act 2002")]
    assert docs.where("uri = 'u'").first().text[got[0].start : got[0].end] == "Adoption Children Act 2002"


def paragraphs(spark, *texts):
    return spark.createDataFrame([("u", k, t) for k, t in enumerate(texts)], "uri string, para_no int, markup string")


REF = '<ref href="h/{0}" uk:canonical="{0} c. 1" uk:type="legislation">Finance Act {0}</ref>'


def test_as_of_and_numbered(spark):
    p = paragraphs(spark, f"the Act; {REF.format(2000)} then the Act", f"{REF.format(2001)} the 2000 Act and this Act")
    found, used = oblique.mentions(p), oblique.uses(p)
    got = sorted((r.para, r.start, r.detected_leg) for r in oblique.latest_before(used.where("kind = 'act'"), found).collect())
    assert [(x[0], x[2]) for x in got] == [(0, "Finance Act 2000"), (1, "Finance Act 2001")]
    assert [r.detected_leg for r in oblique.first_of_year(used.where("kind = 'numbered_act'"), found).collect()] == ["Finance Act 2000"]


def test_provision_distance(spark):
    near = spark.createDataFrame([("u", 0, 129, 142, "section 5", "5"), ("u", 0, 7052, 7066, "section 6", "6")], "uri string, para int, start int, end int, section string, section_no string")
    leg = spark.createDataFrame([("u", 0, 150, 273, "A", "h", "c")], "uri string, para int, start int, end int, detected_leg string, href string, canonical string")
    pairs = provisions.close_pairs(near, leg)
    assert [r.section for r in pairs.collect()] == ["section 5"]
    d = provisions.definitions(pairs).first()
    assert (d.section_href, d.section_canonical) == ("h/section/5", "c s. 5")


def test_nearest_definition(spark):
    p = paragraphs(spark, f"section 5 of the {REF.format(2000)}", "x", f"section 5 of the {REF.format(2001)}", "section 5(2) again", "section 9")
    got = {r.para: r.section_href for r in provisions.resolved(p).collect()}
    assert got == {0: "h/2000/section/5", 2: "h/2001/section/5", 3: "h/2001/section/5/2"}
    assert provisions.resolved(p, strict=True).count() == 3


def test_lookup(spark):
    acts = spark.createDataFrame([("r1", "Act 2023", "X Act 2023", None), ("r2", "Act 2023", None, "XA")], "ref string, title string, shorttitle string, acronymcitation string")
    got = {r.candidate_titles: (r.ref, r.for_fuzzy) for r in lookup.enhance(acts).collect()}
    assert got == {"Act 2023": ("r1", True), "X Act 2023": ("r1", True), "XA": ("r2", False)}
    people = spark.createDataFrame([("John", 30), ("Sarah", 25)], "n string, a int")
    assert lookup.merged(people, people.where("n = 'John'")).count() == 2


def test_wire_round_trip(spark):
    c = spark.createDataFrame([("u", "m", "c", "2001", "h", True)], "uri string, citation_match string, corrected_citation string, year string, case_uri string, is_neutral boolean")
    leg = spark.createDataFrame([("u", 'a "b"', "h", None)], "uri string, detected_ref string, href string, canonical string")
    abb = spark.createDataFrame([("u", "AB", "Alpha Beta")], "uri string, abb_match string, longform string")
    rows = replacing.wire(c, leg, abb)
    lines = replacing.encoded(rows)
    assert {r.value for r in lines.collect()} >= {'{"case":["m","c","2001","h","true"]}'}
    assert sorted(map(str, replacing.decoded(lines).collect())) == sorted(map(str, rows.collect()))
    other = spark.createDataFrame([("u", '{"Abbreviation":["a","b"]}')], "uri string, value string")
    assert replacing.decoded(other).count() == 0


def test_enrichment_plan(spark):
    from statuta.functions.markup import sanitise, well_formed, without_tags
    from statuta.plans import enrich

    body = '<p>As in [2022] UKSC 12, the Finance Act 2002 ("FA 2002").</p><p>Section 5 of the Finance Act 2002 and the Act.</p>'
    xml = f'<j xmlns:uk="urn:statuta:akn"><FRBRManifestation><FRBRdate date="1" name="x"/></FRBRManifestation><proprietary></proprietary><header/><content>{body}</content></j>'
    docs = spark.createDataFrame([("u", xml), ("no-stamp", "<j><content><p>x</p></content></j>")], "uri string, xml string")
    table = spark.createDataFrame([("h", "2002 c. 23", 2002, "Finance Act 2002", True)], "ref string, citation string, year long, candidate_titles string, for_fuzzy boolean")
    out = {r.uri: r for r in enrich.enrich(docs, catalog.manifest(spark), table).collect()}
    got = out["u"].xml
    assert well_formed(got) and without_tags(sanitise(got)) == without_tags(xml)
    assert 'href="http://cases.example/uksc/2022/12"' in got and '<abbr title="Finance Act 2002" uk:origin="OWN">FA 2002</abbr>' in got
    assert 'href="h/section/5"' in got and ">the Act</ref>" in got
    assert out["no-stamp"].error == "no proprietary element"


def test_batch_functions_find_what_the_column_expressions_find(spark):
    from statuta.functions import markup

    texts = [f"the Act; {REF.format(2000)} then the 2004 Act, Section 5(2) s. 7", '<ref uk:type="legislation">x <b>y</b> 1999</ref> sections 12, this Act', "none", "", "that  Act ss 4 <ref href='q' type=\"legislation\" canonical=\"\">\nz</ref>"]
    p = paragraphs(spark, *[f"<p>{t}</p>" for t in texts])
    xml = "".join(f"<p>{t}</p>" for t in texts)
    for found, own in ((oblique.mentions(p), markup.mentions(xml)), (oblique.uses(p), markup.uses(xml)), (provisions.sections(p), markup.sections(xml))):
        names = [c for c in found.columns if c != "uri"]
        assert sorted(tuple(r[c] for c in names) for r in found.collect()) == sorted(tuple(x[c] for c in names) for x in own)
