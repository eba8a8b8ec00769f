"""The closure of hierarchies deeper than a recursive query goes, and of cycles."""

from pyspark.sql import functions as F

from statuta import catalog
from statuta.operators import graph


def _closure(spark, links):
    rows = graph.closure(spark.createDataFrame([(a, p, b) for a, p, b in links], "s string, p string, o string"), "has").collect()
    assert len(rows) == len({(r.top, r.node) for r in rows})
    return {(r.top, r.node): r.depth for r in rows}


def test_a_chain_of_seventy_links(spark):
    got = _closure(spark, [(f"n{i}", "has", f"n{i + 1}") for i in range(70)] + [("n70", "other", "n71")])
    assert got == {(f"n{i}", f"n{j}"): j - i for i in range(71) for j in range(i + 1, 71)}


def test_cycles_and_short_cuts(spark):
    links = [(f"n{i}", "has", f"n{(i + 1) % 60}") for i in range(60)] + [("n0", "has", "n30"), ("n0", "has", "n1"), ("x", "has", "x")]
    got = _closure(spark, links)
    for top in range(60):
        for node in range(60):
            plain = (node - top) % 60 or 60
            cut = (-top) % 60 + 1 + (node - 30) % 60
            assert got[(f"n{top}", f"n{node}")] == min(plain, cut)
    assert len(got) == 3601 and got[("x", "x")] == 1


def test_no_links(spark):
    assert _closure(spark, [("a", "other", "b")]) == {}


def test_rules_see_the_citations_of_all_paragraphs(spark):
    """Every address that some paragraph cites is in the closure, whatever the paragraph's kind."""
    sf = "/root/testdata/sf0.001"
    cited = catalog.caselaw_citations(spark, sf).where("case_uri <> '#'").select(F.split("uri", "#")[0].alias("s"), F.col("case_uri").alias("o"))
    held = catalog.rule_closure(spark, sf).where("p = 'cites' and o not like '%/section/%'").select("s", "o")
    want = set(map(tuple, cited.collect()))
    assert {o.split("/")[3] for _, o in want} == {"uksc", "ewhc"}
    assert set(map(tuple, held.collect())) == want
