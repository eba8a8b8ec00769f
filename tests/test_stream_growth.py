"""What the stream does once must not come again with every message or micro-batch."""

import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from statuta import catalog, corpus
from statuta.plans import enrich
from statuta.streaming import attempts


class State:
    """Value and map states in memory; counts the calls, each of which would cross to the JVM."""

    calls = 0

    def __init__(self):
        self.value, self.map = None, {}

    def __getattribute__(self, name):
        if name in ("get", "exists", "update", "clear", "containsKey", "updateValue", "iterator", "removeKey"):
            State.calls += 1
        return object.__getattribute__(self, name)

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def containsKey(self, k):  # noqa: N802
        return k in self.map

    def updateValue(self, k, v):  # noqa: N802
        self.map[k] = v

    def iterator(self):
        return iter(list(self.map.items()))

    def removeKey(self, k):  # noqa: N802
        del self.map[k]


class Handle:
    def getValueState(self, *_):  # noqa: N802
        return State()

    getMapState = getValueState  # noqa: N815


def processor(seconds=3600.0):
    p = attempts.Attempts(4, seconds)
    p.init(Handle())
    return p


def asked(i, at):
    return Row(uri="u", attempt=None, kind="asked", reason=None, message_id=i, at=None if at is None else at * 1_000_000)


def run(p, *rows):
    return [(r.attempt, r.dead) for r in p.handleInputRows(("u",), iter(rows), None)]


def test_state_is_not_called_for_each_message():
    counts = []
    for n in (10, 1000):
        p = processor()
        State.calls = 0
        assert run(p, *[asked(str(k), k) for k in range(n)]) == [(1, False)]
        counts.append(State.calls)
    assert counts[0] == counts[1] < 10


def test_messages_are_remembered_for_a_while():
    """As the rule says it, message by message: the latest time counts, an id keeps its first one."""
    r = random.Random(5)
    for _ in range(200):
        p, seen = processor(100), {}
        for _ in range(6):
            rows = [asked(r.choice([None, *"abcdefgh"]), r.choice([None, *range(0, 400, 20)])) for _ in range(r.randint(1, 5))]
            new = False
            for x in sorted(rows, key=lambda x: (x.at is None, x.at or 0)):
                if (x.message_id or "") not in seen:
                    new, seen[x.message_id or ""] = True, x.at or 0
            latest = max(seen.values())
            seen = {i: at for i, at in seen.items() if at >= latest - 100 * 1_000_000}
            r.shuffle(rows)
            assert run(p, *rows) == ([(1, False)] if new else [])


def test_endings_are_of_the_current_attempt():
    end = lambda kind, attempt: Row(uri="u", attempt=attempt, kind=kind, reason="r", message_id=None, at=None)
    p = processor()
    assert run(p, end("failed", 1)) == []
    assert run(p, asked("a", 1)) == [(1, False)]
    assert run(p, end("failed", 3), end("failed", 1)) == [(2, False)]
    assert run(p, asked("a", 2), end("failed", 2)) == [(3, False)]
    assert run(p, end("failed", 3)) == [(4, False)] and run(p, end("failed", 4)) == [(4, True)]
    assert run(p, end("failed", 4)) == [] and run(p, asked("b", 2)) == [(1, False)] and run(p, end("done", 1), end("failed", 1)) == []


def test_titles_are_matched_by_what_is_there(spark, monkeypatch):
    """A matcher of all documents serves some of them, and the lookup table isn't laid out again."""
    docs = catalog._judgments(spark, "/root/testdata/sf0.001").where("cast(uri as int) % 97 = 0")
    known = catalog._lookup(spark, "/root/testdata/sf0.001")
    some = docs.where("cast(uri as int) % 2 = 0")
    want = sorted(map(str, enrich.first_stage(some, catalog.manifest(spark), known).collect()))
    for most in (enrich.legislation.TABLE_BYTES, 6000):
        titles = enrich.matcher(docs, known, most=most)
        assert titles is not None
        with monkeypatch.context() as m:
            m.setattr(enrich.legislation, "matcher", None)
            assert sorted(map(str, enrich.first_stage(some, catalog.manifest(spark), known, titles=titles).collect())) == want != []


def test_other_documents_lines_are_not_numbered(spark):
    some = spark.createDataFrame([(str(k),) for k in (1, 3, 32, 33, 10**9)], "uri string")
    made = corpus.paragraphs(spark, "/root/testdata/sf0.001", some)
    steps = made._jdf.queryExecution().optimizedPlan().toString()
    assert steps.index("Window [") < steps.index("LeftSemi")
    whole = corpus.paragraphs(spark, "/root/testdata/sf0.001").where(F.col("uri").isin("1", "3", "32", "33"))
    assert sorted(map(str, made.collect())) == sorted(map(str, whole.collect())) != []
    assert "LeftSemi" not in corpus.paragraphs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
