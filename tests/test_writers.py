"""Sinks, sources and title matching beyond what is broadcast."""

import random

import pytest

from statuta.operators import legislation, rules
from statuta.sources import readers, writers


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "lines")
    with pytest.raises(FileNotFoundError):
        writers.published(spark, path)
    first = None
    for k in range(3):
        writers.publish(spark.createDataFrame([(f"version {k}",)], "value string"), path)
        first = first if first is not None else writers.published(spark, path)
        assert [r.value for r in writers.published(spark, path).collect()] == [f"version {k}"]
    # who began with a version ends with it
    assert [r.value for r in first.collect()] == ["version 0"]


def test_rules_that_fail_are_not_published(spark, tmp_path):
    from statuta import catalog

    m = catalog.manifest(spark)
    path = str(tmp_path / "rules")
    assert writers.rules(m.limit(2), path)
    assert not writers.rules(m.withColumn("match_example", m.description), path)
    assert writers.published(spark, path).count() == 2


def test_external_copy(spark, tmp_path):
    docs = spark.createDataFrame([("u", '<a b="c">\n</a>'), ("v", None)], "uri string, xml string")
    writers.external_copy(docs, str(tmp_path / "copy"))
    assert sorted(map(tuple, spark.read.schema("uri string, xml string").json(str(tmp_path / "copy")).collect())) == sorted(map(tuple, docs.collect()))


def test_replacement_lines(spark, tmp_path):
    (tmp_path / "court_replacements.txt").write_text('{"case": ["a", "b"]}\n{"abb": ["c", "d"]}\n')
    assert sorted(map(tuple, readers.replacements(spark, str(tmp_path)).collect())) == [("court", '{"abb": ["c", "d"]}'), ("court", '{"case": ["a", "b"]}')]


# -- titles: broadcast and joined alike --------------------------------------------------------------


@pytest.fixture(scope="module")
def titles(spark):
    r = random.Random(5)
    words = ["Finance", "Companies", "Customs", "Order", "and", "Duties"]
    rows = [(f"h/{k}", f"{y} c. {k}", y, " ".join(r.choice(words) for _ in range(r.randint(1, 5))) + (f" Act {y}" if k % 2 else f" No {k}"), bool(k % 2)) for k, y in ((k, 1990 + k % 5) for k in range(40))]
    rows.append(("h/long", "1990 c. 99", 1990, " ".join(f"Regulation{k}" for k in range(120)) + " Act 1990", True))
    return spark.createDataFrame(rows, "ref string, citation string, year long, candidate_titles string, for_fuzzy boolean")


@pytest.fixture(scope="module")
def texts(spark, titles):
    r = random.Random(9)
    known = [t.candidate_titles for t in titles.collect()]
    rows = [("none", None), ("empty", "")]
    for k in range(40):
        some = [r.choice(known) for _ in range(4)]
        rows.append((f"u{k}", " ".join(f"see X{t} or {t.replace('Duties', 'Dutys')}x, {t} of {r.randint(1990, 1994)};" for t in some)))
    rows.append(("long", "under the " + known[-1].replace("Regulation7 ", "Regulations7 ") + " it is"))
    return spark.createDataFrame(rows, "uri string, text string")


def test_exact_titles_against_plain_search(titles, texts):
    import re

    want = set()
    for u, text in [tuple(r) for r in texts.collect()]:
        for t in titles.collect():
            for m in re.finditer(rf"(?<!\w)(?={re.escape(t.candidate_titles)}(?!\w))", text or ""):
                if re.search(rf"(?<![\w.]){t.year}(?!\w|\.\w|\.\.)", text):
                    want.add((u, t.candidate_titles, m.start()))
    for most in (legislation.TABLE_BYTES, 0):
        got = [tuple(r) for r in legislation.exact_hits(texts, titles, most).select("uri", "title", "start").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_fuzzy_titles_joined_and_broadcast(titles, texts):
    columns = ("uri", "title", "start", "end", "confidence", "detected_ref", "href", "canonical")
    one, two = (sorted(map(tuple, legislation.fuzzy_hits(texts, titles, most=most).select(*columns).collect())) for most in (legislation.TABLE_BYTES, 0))
    assert one == two and one
    long = [x for x in one if x[0] == "long" and x[6] == "h/long"]
    assert long and long[0][4] >= 99  # a title of 1500 characters


def test_overlaps_in_runs(spark):
    r = random.Random(3)
    rows = [(f"u{k % 7}", k, s := r.randint(0, 300), s + r.randint(0, 25), r.randint(80, 83)) for k in range(400)]
    df = spark.createDataFrame(rows, "uri string, idx int, start int, end int, confidence int")
    inside = lambda a, b: a[2] >= b[2] and a[3] <= b[3]
    lost = {h[1] for h in rows for o in rows if o[0] == h[0] and o[1] != h[1] and (inside(h, o) or inside(o, h)) and (h[4], -h[1]) < (o[4], -o[1]) and (h[4] < o[4] or h[1] < o[1])}
    lost |= {h[1] for h in rows for o in rows if o[0] == h[0] and o[1] != h[1] and (inside(h, o) or inside(o, h)) and h[4] == o[4] and h[1] < o[1]}
    assert {x.idx for x in legislation.resolve_overlaps(df).collect()} == {h[1] for h in rows} - lost


def test_rules_with_and_without_literals():
    known = rules.Rules([("a", '[{"LIKE_NUM": "true"}, {"SHAPE": "dddd"}]'), ("b", '[{"ORTH": "AC"}, {"LIKE_NUM": "true"}]')])
    assert rules.hits("AC 12 2001 and AC 7", known) == [(3, 10, "12 2001", "a"), (15, 19, "AC 7", "b")]
