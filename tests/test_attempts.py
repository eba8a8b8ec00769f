"""The stream's attempts, dead letters and restarts."""

import json

import pytest
from pyspark.sql import functions as F

from statuta.sources import documents
from statuta.streaming import attempts


def body(uri):
    return json.dumps({"Message": json.dumps({"status": "published", "uri_reference": uri})})


@pytest.fixture
def place(spark, tmp_path):
    schema = "message_id string, ts timestamp, body string"

    def send(*rows):
        df = spark.createDataFrame([(i, t, b) for i, t, b in rows], "message_id string, ts string, body string")
        df.selectExpr("message_id", "cast(ts as timestamp) ts", "body").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def start(judgments, enrich, **more):
        return attempts.enrich_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), judgments, enrich, str(tmp_path / "out"), str(tmp_path / "checkpoint"), **more)

    def state():
        return (
            sorted(map(tuple, documents.read(spark, str(tmp_path / "out" / "documents")).collect())),
            sorted(map(tuple, attempts.dead_letters(spark, str(tmp_path / "out")).collect())),
        )

    return send, start, state


def plan(docs):
    bad = F.col("xml").contains("broken")
    return docs.select("uri", F.when(~bad, F.concat("xml", F.lit("!"))).alias("xml"), F.when(bad, F.lit("broken")).alias("error"))


def test_attempts_and_dead_letters(spark, place):
    send, start, state = place
    send(("1", "2024-01-01 00:00:00", body("a")), ("1", "2024-01-01 00:00:01", body("a")), ("2", "2024-01-01 00:00:02", json.dumps({"Event": "s3:TestEvent"})), ("3", "2024-01-01 00:00:03", body("none")), ("4", "2024-01-01 00:00:03", body("thrice")), ("5", "2024-01-01 00:00:03", body("never")), ("6", "2024-01-01 00:00:03", "no json"))
    tries = []

    def judgments():
        """thrice is broken the first three times that documents are read."""
        tries.append(len(tries))
        rows = [("a", "A"), ("never", "broken"), ("thrice", "broken" if len(tries) <= 3 else "T"), ("unasked", "U")]
        return spark.createDataFrame(rows, "uri string, xml string")

    attempts.drain(lambda: start(judgments, plan))
    want = [("a", "A!"), ("thrice", "T!")], [("never", "broken", 4), ("none", "no document", 4)]
    assert state() == want and len(tries) == 4
    # nothing new: nothing happens
    attempts.drain(lambda: start(judgments, plan))
    assert state() == want and len(tries) == 4
    # a message that was seen counts for nothing, a new one starts over
    send(("4", "2024-01-01 00:00:09", body("thrice")), ("7", "2024-01-01 00:10:00", body("a")))
    attempts.drain(lambda: start(lambda: spark.createDataFrame([("a", "B"), ("thrice", "X")], "uri string, xml string"), plan))
    assert state() == ([("a", "B!"), ("thrice", "T!")], want[1])


def test_a_micro_batch_that_runs_again_changes_nothing(spark, place):
    send, start, state = place
    send(("1", "2024-01-01 00:00:00", body("a")), ("2", "2024-01-01 00:00:00", body("never")))
    docs = spark.createDataFrame([("a", "A"), ("never", "broken")], "uri string, xml string")
    died, real = [], attempts.discard

    def dies(*tables):
        if len(died) < 3:  # after all is written, before the stream knows
            died.append(1)
            raise RuntimeError("the driver is lost")
        real(*tables)

    attempts.discard = dies
    try:
        for _ in range(3):
            with pytest.raises(Exception, match="the driver is lost"):
                start(docs, plan).awaitTermination()
        attempts.drain(lambda: start(docs, plan))
    finally:
        attempts.discard = real
    assert state() == ([("a", "A!")], [("never", "broken", 4)])


def test_a_delay_needs_a_trigger_that_goes_on(place):
    send, start, _ = place
    send(("1", "2024-01-01 00:00:00", body("a")))
    with pytest.raises(ValueError):
        start(None, plan, delay=1)


def test_delayed_attempts(spark, place):
    import time

    send, start, state = place
    send(("1", "2024-01-01 00:00:00", body("never")), ("2", "2024-01-01 00:00:00", body("a")))
    docs = spark.createDataFrame([("a", "A"), ("never", "broken")], "uri string, xml string")
    query = start(docs, plan, most=2, delay=1, trigger={"processingTime": "1 second"})
    try:
        end = time.time() + 120
        while time.time() < end and not state()[1]:
            time.sleep(1)
    finally:
        query.stop()
    assert state() == ([("a", "A!")], [("never", "broken", 2)])
