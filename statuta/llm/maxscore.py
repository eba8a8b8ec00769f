"""Ranked lexical search: MaxScore over shards of postings.

Texts are read once. Every task cuts its documents into shards and writes, for
each, the postings of the terms that some item asks for (all terms where the
items don't fit a block), the documents' lengths, and for each term the
staircase of its postings: the pairs (tf, length) that no other posting beats in
both. A term's score grows with tf and falls with length whatever the corpus's
averages are, so the staircase gives its exact greatest score once these are
known. Sums over the shards give N, L and each term's df.

Every shard then answers every item. Terms are put in order of their upper
bounds; those whose bounds together stay below the k-th best score so far are
non-essential: only documents of the other, essential lists are candidates,
and non-essential postings are probed, greatest bound first, only for candidates
that their score so far and the bounds left still let qualify. Documents go by
in growing windows, after each of which the lists are split anew. The shards'
bests are ranked together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, pieces, ship, stored

#: Documents and terms, repeats counted, of a shard: what is reached first ends it.
SHARD_DOCS, SHARD_TERMS = 32_768, 3_000_000
#: Bytes of items that are broadcast and searched together, at most (one item at least).
BLOCK_BYTES = 8_000_000
#: Code points of a text that are cut into terms together.
SLICE = 1_000_000
#: Documents of the first window; later ones are twice as large as the one before.
WINDOW = 512
#: Fixed values of the score.
LENGTH_PERCENT, SATURATION = 75, 1000
#: Terms: digits, letters and all beyond ASCII, in UTF-8.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The text's terms, A-Z lower-cased, slice by slice; slices end between terms."""
    at, text = 0, text or ""
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        # bytes.lower() changes A-Z alone
        yield _TERM.findall(text[at:end].encode().lower())
        at = end


class Shard:
    """Postings of some documents, in the making."""

    def __init__(self, vocabulary: dict[bytes, int] | None):
        self.fixed, self.number = vocabulary is not None, vocabulary if vocabulary is not None else {}
        self.ids, self.lengths, self.found, self.doc, self.size = [], [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        """A document; one without terms leaves nothing."""
        n, numbers = 0, []
        for some in terms(text):
            if not self.fixed:
                for t in some:
                    self.number.setdefault(t, len(self.number))
            n += len(some)
            got = np.fromiter(map(self.number.get, some, [-1] * len(some)), np.int32, len(some))
            numbers.append(got[got >= 0])
        if n:
            self.found += numbers
            self.doc.append(np.full(sum(map(len, numbers)), len(self.ids), np.int32))
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.size += n

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.size >= SHARD_TERMS

    def row(self) -> pa.RecordBatch:
        """The shard's row: terms in order, where their postings begin, the postings, and the staircases."""
        lengths = np.array(self.lengths, np.int64)
        t, d = np.concatenate([np.zeros(0, np.int32), *self.found]).astype(np.int64), np.concatenate([np.zeros(0, np.int32), *self.doc]).astype(np.int64)
        key, tf = np.unique(t * max(1, len(lengths)) + d, return_counts=True)
        t, d = np.divmod(key, max(1, len(lengths)))
        used, starts = np.unique(t, return_index=True)
        name = {v: k for k, v in self.number.items()}
        rank = np.repeat(np.arange(len(used)), np.diff([*starts, len(t)]))
        # shortest first, of these the most frequent: a posting is a stair where its tf passes all before
        order = np.lexsort((-tf, lengths[d], rank))
        high = tf[order] + rank[order] * (int(tf.max(initial=0)) + 1)
        stair = order[np.diff(np.maximum.accumulate(high), prepend=-1) > 0] if len(order) else order
        columns = {
            "n_docs": pa.array([len(lengths)], pa.int64()),
            "n_terms": pa.array([int(lengths.sum())], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(pa.int64())),
            "lengths": pa.array([lengths.tobytes()], pa.binary()),
            "terms": pa.array([[name[x] for x in used.tolist()]], pa.list_(pa.binary())),
            "starts": pa.array([np.array([*starts, len(t)], np.int64).tobytes()], pa.binary()),
            "docs": pa.array([d.astype(np.int32).tobytes()], pa.binary()),
            "tfs": pa.array([tf.astype(np.int32).tobytes()], pa.binary()),
            "stair_starts": pa.array([np.searchsorted(rank[stair], np.arange(len(used) + 1)).astype(np.int64).tobytes()], pa.binary()),
            "stair_tfs": pa.array([tf[stair].astype(np.int64).tobytes()], pa.binary()),
            "stair_lengths": pa.array([lengths[d[stair]].tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)


SHARDS = "n_docs long, n_terms long, ids array<long>, lengths binary, terms array<binary>, starts binary, docs binary, tfs binary, stair_starts binary, stair_tfs binary, stair_lengths binary"


def index(docs: DataFrame, vocabulary: Iterable[bytes] | None = None) -> DataFrame:
    """Stored shards of docs (doc_id, text, ...), with the postings of the vocabulary's terms, or of all terms."""
    ship(docs.sparkSession)
    known = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import maxscore as own

        new = lambda: own.Shard(None if known is None else known.value)
        shard = new()
        for batch in pieces(batches, 100):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard.add(doc_id, text)
                if shard.full():
                    yield shard.row()
                    shard = new()
        if shard.ids:
            yield shard.row()

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, SHARDS), "postings")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (SATURATION * tf + 8 * m)


class Opened:
    """A stored shard, with the corpus's N and L, ready for search."""

    def __init__(self, row: dict, n: int, total: int):
        read = lambda c, kind=np.int64: np.frombuffer(row[c], kind)
        m = lambda lengths: 100 - LENGTH_PERCENT + LENGTH_PERCENT * lengths * n // max(1, total)
        self.place = {bytes(t): k for k, t in enumerate(row["terms"])}
        self.known = np.array([i is not None for i in row["ids"]], bool)
        self.ids = np.array([i or 0 for i in row["ids"]], np.int64)
        self.m, self.starts, self.docs, self.tfs = m(read("lengths")), read("starts"), read("docs", np.int32), read("tfs", np.int32)
        stairs, first = impact(read("stair_tfs"), m(read("stair_lengths"))), read("stair_starts")
        self.most = np.maximum.reduceat(stairs, first[:-1]) if len(stairs) else stairs

    def best(self, wanted: dict[bytes, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents' places, scores) of the k best for terms with weights, repeats counted; the best first."""
        lists = sorted((weight * int(self.most[p]), weight, p) for t, weight in wanted.items() if weight and (p := self.place.get(t)) is not None)
        bounds = np.cumsum([x[0] for x in lists], dtype=np.int64)
        postings = [(weight, self.docs[a:b], self.tfs[a:b]) for _, weight, p in lists for a, b in [self.starts[p : p + 2]]]
        top, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, size, least = 0, WINDOW, 1
        while at < len(self.m) and lists:
            end = min(len(self.m), at + size)
            essential = int(np.searchsorted(bounds, least))
            if essential == len(lists):
                break  # all bounds together don't reach the k-th best
            sums = np.zeros(end - at, np.int64)
            for weight, docs, tfs in postings[essential:]:
                a, b = np.searchsorted(docs, (at, end))
                sums[docs[a:b] - at] += weight * impact(tfs[a:b].astype(np.int64), self.m[docs[a:b]])
            left = np.flatnonzero(sums)
            for i in range(essential - 1, -1, -1):
                left = left[sums[left] + bounds[i] >= least]
                if not len(left):
                    break
                weight, docs, tfs = postings[i]
                spot = np.minimum(np.searchsorted(docs, left + at), len(docs) - 1)
                there = docs[spot] == left + at
                hit, spot = left[there], spot[there]
                sums[hit] += weight * impact(tfs[spot].astype(np.int64), self.m[hit + at])
            left = left[sums[left] >= least]
            top, scores = np.concatenate([top, left + at]), np.concatenate([scores, sums[left]])
            order = np.lexsort((self.ids[top], ~self.known[top], -scores))[:k]
            top, scores = top[order], scores[order]
            if len(top) == k:
                least = max(1, int(scores[-1]))
            at, size = end, size * 2
        return top, scores


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    docs (doc_id, text, ...), items (item_id, text, ...); other columns are
    ignored. Null and empty texts have no terms: such documents aren't counted
    and never found, such items find nothing. Repeated rows are documents, or
    items, of their own. Null doc_ids come last among equal scores. Empty
    tables give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = stored(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")
    size = asked.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 100)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    of_block = lambda b: asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
    shards = index(docs) if blocks > 1 else None
    found = []
    for b in range(blocks):
        rows = [(r["item"], r["item_id"], Counter(t for some in terms(r["text"]) for t in some)) for r in of_block(b).collect()]
        vocabulary = sorted({t for _, _, c in rows for t in c})
        own_shards = shards if shards is not None else index(docs, vocabulary)
        found.append(stored(_searched(own_shards, rows, vocabulary, items.schema["item_id"].dataType, k), "lexical-hits"))
        if shards is None:
            discard(own_shards)
    if shards is not None:
        discard(shards)
    discard(asked)
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionAll(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _searched(shards: DataFrame, rows: list[tuple], vocabulary: list[bytes], kind, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): every shard's k best for the items (item, item_id, terms)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import LongType, StructField, StructType

    context = shards.sparkSession.sparkContext
    total = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, length = total["n"] or 0, total["l"] or 0
    asked = context.broadcast(frozenset(vocabulary))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for batch in batches:
            for names, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                each = np.diff(np.frombuffer(starts, np.int64)).tolist()
                df.update({t: c for t, c in zip(names, each, strict=True) if t in asked.value})
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], ["term", "df"])

    # no more rows than the block has terms
    df = dict(shards.select("terms", "starts").mapInArrow(counted, "term binary, df long").groupBy("term").agg(F.sum("df")).collect())
    weight = {bytes(t): math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
    weighted = context.broadcast([(item, item_id, {t: q * weight[t] for t, q in c.items() if t in weight}) for item, item_id, c in rows])
    arrow = to_arrow_type(kind)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import maxscore as own

        for batch in batches:
            for j in range(batch.num_rows):
                shard = own.Opened(batch.slice(j, 1).to_pylist()[0], n, length)
                out: tuple = [], [], [], []
                for item, item_id, wanted in weighted.value:
                    top, scores = shard.best(wanted, k)
                    out[0].extend([item] * len(top))
                    out[1].extend([item_id] * len(top))
                    out[2].extend(i if ok else None for i, ok in zip(shard.ids[top].tolist(), shard.known[top].tolist(), strict=True))
                    out[3].extend(scores.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], arrow), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], ["item", "item_id", "doc_id", "score"])

    schema = StructType([StructField("item", LongType()), StructField("item_id", kind), StructField("doc_id", LongType()), StructField("score", LongType())])
    return shards.select("ids", "lengths", "terms", "starts", "docs", "tfs", "stair_starts", "stair_tfs", "stair_lengths").mapInArrow(answered, schema)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents),
 p as (select r, any_value(doc_id) as doc_id, term, count(*) as tf, any_value(n) as n from (select r, doc_id, len(terms) as n, unnest(terms) as term from d) group by r, term),
 c as (select count(*) filter (len(terms) > 0) as docs, sum(len(terms))::bigint as total from d),
 w as (select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from p, c group by term),
 q as (select item_id, term, count(*) as times from (select item_id, unnest({_TERMS}) as term from benchmark) group by item_id, term),
 s as (select item_id, doc_id, r, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) as bigint) as score
  from q join w using (term) join p using (term), c group by item_id, doc_id, r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id, r) as int) as rank, doc_id, score from s where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id, r) <= 10"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
