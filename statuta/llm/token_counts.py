"""Token counts by a map-side two-tier lookup; no pre-token of a text is shuffled.

Texts are cut at white space: no pre-token of the tokenizer crosses it, so a
text's count is the sum of its words' counts. Tier one is a compact table of
the corpus's most frequent words and their counts, broadcast
(``table_entries`` rows at most): every task counts the words of all its rows
and hands on its ``TASK_ENTRIES`` most frequent, whatever it has read; the
sums of these summaries, the only words that are shuffled, are ranked. Tier two
is a cache in each Python worker that encodes a batch's misses with the library
itself; words beyond ``LONGEST`` are counted and not kept, and the cache is
emptied when its words reach ``cache_bytes``. Both tiers only save time; they hold what the
library gives, so results don't depend on what is in them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, ship

TABLE_ENTRIES = 20_000
#: Bytes of a worker's cache, by the words' lengths and what an entry takes besides.
CACHE_BYTES = 150_000_000
ENTRY_BYTES = 150
#: Words of a task's summary; and words a task counts at once: beyond, the rarer half goes.
TASK_ENTRIES, TASK_WORDS = 4_000, 400_000
#: Code points read until words too long to be kept go.
TASK_TEXT = 20_000_000
#: Code points of a word that is kept in the table or a cache, at most.
LONGEST = 64
#: White space for Python's split, yet not for the tokenizer; texts with these are encoded whole.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_worker: dict = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _counter(path: str):
    """The worker's (encode a list of strings to counts); one library object per process and file."""
    if path not in _worker:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _worker[path] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            _worker[path] = lambda texts: [len(x) for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    return _worker[path]


class Cache(dict):
    """Words' counts, and how many bytes they take about."""

    size = 0


def count_texts(texts: list[str], path: str, table: dict[str, int], cache: Cache, cache_bytes: int = CACHE_BYTES) -> list[int]:
    """Token counts of texts; words missing from table and cache are encoded in one batch."""
    encode = _counter(path)
    plain = [not _ODD_SPACE.search(t) for t in texts] if path.endswith(".json") else [False] * len(texts)
    words = [t.split() if ok else () for t, ok in zip(texts, plain, strict=True)]
    if cache.size > cache_bytes:
        cache.clear()
        cache.size = 0
    unseen = {w for w in set(chain.from_iterable(words)) if w not in table and w not in cache}
    long_ = [w for w in unseen if len(w) > LONGEST]
    if unseen:
        unseen = list(unseen)
        for k in range(0, len(unseen), 20_000):
            cache.update(zip(unseen[k : k + 20_000], encode(unseen[k : k + 20_000]), strict=True))
        cache.size += ENTRY_BYTES * (len(unseen) - len(long_)) + sum(map(len, unseen)) - sum(map(len, long_))

    def of(w: str) -> int:
        n = table.get(w)
        return cache[w] if n is None else n

    counts = [sum(map(of, ws)) if ok else encode([t])[0] for t, ws, ok in zip(texts, words, plain, strict=True)]
    for w in long_:
        del cache[w]
    return counts


def _frequent(docs: DataFrame, path: str, entries: int) -> dict[str, int]:
    """The corpus's most frequent words and their counts; at most ``entries``."""
    if not path.endswith(".json"):
        return {}

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import token_counts as own

        seen: Counter = Counter()

        def shorter(most: int) -> Counter:
            return Counter(dict(Counter({w: n for w, n in seen.items() if len(w) <= own.LONGEST}).most_common(most)))

        new = 0  # code points that may have become words
        for batch in pieces(batches):
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(t.split())
                    new += len(t)
                if len(seen) > own.TASK_WORDS or new > own.TASK_TEXT:
                    seen, new = shorter(own.TASK_WORDS // 2), 0
        top = shorter(own.TASK_ENTRIES).items()
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["w", "n"])

    words = docs.select("text").mapInArrow(summaries, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(entries)
    words = [r["w"] for r in words.collect() if not _ODD_SPACE.search(r["w"])]
    return dict(zip(words, _counter(path)(words), strict=True)) if words else {}


def token_counts(docs: DataFrame, path: str, limit: int = 2048, table_entries: int = TABLE_ENTRIES, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of docs (doc_id, text, ...).

    path: a ``.json`` file (library tokenizers) or ``.model`` (sentencepiece).
    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null
    doc_ids are kept; other columns are ignored. Counts are of whole texts. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    table = spark.sparkContext.broadcast(_frequent(docs, path, table_entries))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import token_counts as own

        cache = own._worker.setdefault(("cache", path), own.Cache())
        for batch in pieces(batches):
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            n = own.count_texts(texts, path, table.value, cache, cache_bytes)
            yield pa.RecordBatch.from_arrays([ids, batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return slim.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("word_bpe_49k.json"))
