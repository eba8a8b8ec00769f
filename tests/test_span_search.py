"""Spans: a text is searched once, and offsets hold for any number of matches anywhere."""

import random
import re

from pyspark.sql import functions as F

from statuta.functions import spans as P


def test_spans_of_any_number(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(["a", "b", "ab", " ", "\U0001d4d0", "$0", "\\", "￿" if k % 3 == 0 else "x"]) for _ in range(r.randint(0, 12))) for k in range(600)] + ["", "b", "ab", "bab", "abb ab", "￿", "￿b￿", "b" * 50, "ab " * 200, None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for first in ("", "[ab]"):
        got = df.select("k", P.spans(F.col("t"), "ab|(b)+", first).alias("s")).collect()
        assert {x.k: [tuple(s) for s in x.s] for x in got} == {k: [(m.start(), m.end(), m[0]) for m in re.finditer("ab|b+", t or "")] for k, t in enumerate(texts)}
    some = [len(x.s) for x in got]
    assert {0, 1, 2, 3} < set(some) and max(some) == 200


def test_texts_are_searched_once(spark):
    """Matches are cut out with the gaps; only texts that hold the mark are searched for them again."""
    df = spark.createDataFrame([("section 3",)], "markup string")
    steps = df.select(P.sections(F.col("markup")).alias("s"))._jdf.queryExecution().analyzed().toString().lower()
    assert steps.count("regexp_replace(") == 1 and steps.rindex("regexp_extract_all(") < steps.rindex("regexp_replace(")
