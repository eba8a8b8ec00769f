"""The stream around the enrichment: documents that are asked for, attempts at them, and dead letters.

What is to be done about a document is state, kept by its uri: the messages
seen lately, and how often it has been tried. A micro-batch runs the enrichment
for the documents that the state hands out, adds the results to the table of
documents and writes how each attempt ended to a folder that the same stream
reads: a failed document is handed out again, at once or after a delay, until
the last attempt makes it a dead letter. Everything a micro-batch writes
carries its number, so one that runs again after a crash changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..session import discard, stored
from ..sources import documents, log
from .messages import decoded, without_tests

ATTEMPTS = 4
#: How attempts ended, as the stream reads it.
ENDED = "uri string, attempt int, kind string, reason string, message_id string, at long"
DEAD = "uri string, error string, attempts int"


class Attempts(StatefulProcessor):
    """(uri, attempt, dead, reason) to hand out, from messages and from how attempts ended.

    A new message starts over. A failure that isn't the current attempt's is an
    echo of a micro-batch that ran twice, and counts for nothing. Message ids
    are remembered for ``seconds`` of the messages' own time.
    """

    def __init__(self, most: int, seconds: float, delay: float = 0):
        self.most, self.seconds, self.delay = most, seconds, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tried = handle.getValueState("tried", "n int, reason string")
        self.seen = handle.getValueState("seen", "ids array<string>, at array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        # the state is read once and written once: each call to it crosses to the JVM
        seen = self.seen.get()
        seen, new, ended = dict(zip(*seen, strict=True)) if seen else {}, {}, []
        for r in rows:
            _, _, kind, _, message_id, at = r
            if kind != "asked":
                ended.append(r)
            elif (i := message_id or "") not in seen and (i not in new or at is not None and (new[i] is None or at < new[i])):
                new[i] = at
        known = seen | {i: at or 0 for i, at in new.items()}
        oldest = max(known.values(), default=0) - self.seconds * 1_000_000
        kept = {i: at for i, at in known.items() if at >= oldest}
        if kept != seen:
            self.seen.update((list(kept), list(kept.values())))
        if new:
            yield from self._hand_out(key[0], 1, None)
            return
        now = self.tried.get() if ended else None
        for r in ended:
            if now is None or r.attempt != now[0]:
                continue
            if r.kind == "done":
                self.tried.clear()
            elif now[0] >= self.most:
                self.tried.clear()
                yield Row(uri=key[0], attempt=now[0], dead=True, reason=r.reason)
            elif self.delay:
                self.tried.update((now[0], r.reason))
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.delay * 1000))
            else:
                yield from self._hand_out(key[0], now[0] + 1, r.reason)
            break

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        if self.tried.exists():
            yield from self._hand_out(key[0], self.tried.get()[0] + 1, self.tried.get()[1])

    def _hand_out(self, uri: str, attempt: int, reason: str | None) -> Iterator[Row]:
        self.tried.update((attempt, reason))
        yield Row(uri=uri, attempt=attempt, dead=False, reason=reason)

    def close(self) -> None:
        pass


def enrich_stream(messages: DataFrame, judgments: DataFrame | Callable[[], DataFrame], enrich: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, most: int = ATTEMPTS, remembered: float = 3600, delay: float = 0, trigger: dict | None = None) -> StreamingQuery:
    """Starts the stream: messages (message_id, ts, body) -> the documents they name, enriched, in the table ``out/documents``.

    enrich: documents (uri, xml) to (uri, xml, error). judgments: the documents,
    or what gives them anew for every micro-batch. A message repeated within
    ``remembered`` seconds, by ts, runs once. A document that can't be enriched,
    for its own error or because there is none, is tried ``most`` times, then it
    is a dead letter (``dead_letters``). A new message starts over. trigger: as
    for a stream; all that is there, once, by default: ``drain`` runs that until
    nothing is left to be tried. With a delay before the next attempt the
    trigger must be one that goes on.
    """
    spark = messages.sparkSession
    trigger = trigger or {"availableNow": True}
    if delay and "processingTime" not in trigger:
        raise ValueError("a delay needs a trigger by processing time")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    ended = f"{out}/attempts"
    store, folder = log.files(spark, ended)
    store.mkdirs(folder)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    asked = decoded(without_tests(messages)).where("uri_reference is not null")
    nothing = lambda kind: F.lit(None).cast(kind)
    asked = asked.select(F.col("uri_reference").alias("uri"), nothing("int").alias("attempt"), F.lit("asked").alias("kind"), nothing("string").alias("reason"), F.col("message_id").cast("string").alias("message_id"), F.unix_micros("ts").alias("at"))
    both = asked.unionByName(spark.readStream.schema(f"{ENDED}, batch long").parquet(ended).drop("batch"))
    handed = both.groupBy("uri").transformWithState(Attempts(most, remembered, delay), "uri string, attempt int, dead boolean, reason string", "Update", "ProcessingTime" if delay else "None")

    def batch(rows: DataFrame, number: int) -> None:
        todo = stored(rows, "attempts")
        live = todo.where("not dead").select("uri", "attempt")
        if not live.isEmpty():
            docs = judgments() if callable(judgments) else judgments
            made = enrich(docs.join(live.select("uri"), "uri", "left_semi"))
            done = stored(made.select("uri", "xml", "error"), "ended")
            if hasattr(made, "stored_at"):
                discard(made)
            right = done.where("error is null and xml is not null").select("uri", "xml")
            documents.append(right, f"{out}/documents", f"{run}/{number}")
            how = live.join(right.select("uri").distinct().withColumn("ok", F.lit(True)), "uri", "left").join(done.groupBy("uri").agg(F.min("error").alias("error")), "uri", "left")
            kind = F.when(F.col("ok"), "done").otherwise("failed")
            how = how.select("uri", "attempt", kind.alias("kind"), F.when(F.col("ok").isNull(), F.coalesce("error", F.lit("no document"))).alias("reason"), nothing("string").alias("message_id"), nothing("long").alias("at"))
            how.write.mode("overwrite").parquet(f"{ended}/batch={number}")
            discard(done)
        dead = todo.where("dead").select("uri", F.col("reason").alias("error"), F.col("attempt").alias("attempts"))
        if not dead.isEmpty():
            dead.write.mode("overwrite").parquet(f"{out}/dead/batch={number}")
        discard(todo)

    return handed.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(**trigger).start()


def drain(start: Callable[[], StreamingQuery], most: int = 1000) -> None:
    """Runs a stream of all that is there, again and again, until a run finds nothing."""
    for _ in range(most):
        query = start()
        query.awaitTermination()
        if not sum(p.numInputRows for p in query.recentProgress):
            return


def dead_letters(spark: SparkSession, out: str) -> DataFrame:
    """(uri, error, attempts): what was given up, with the last attempt's error."""
    try:
        return spark.read.schema(DEAD).parquet(f"{out}/dead").select("uri", "error", "attempts")
    except AnalysisException:  # none yet
        return spark.createDataFrame([], DEAD)
