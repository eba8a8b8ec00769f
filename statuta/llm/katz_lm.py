"""Language-model scores: a trigram model with Katz backoff, counted and looked up in partitioned tables.

Documents are cut into chunks of about ``chunk_tokens`` tokens, stored as one
row each (sorted word hashes, and the texts as positions in them). Chunks ask
and tables answer, order by order:

* word buckets (ranges of word hashes) merge the chunks' words and their
  training counts and answer with each word's total and a short id;
* context buckets (ranges of the context's hash) merge the chunks' distinct
  bigrams, then trigrams, and answer with each one's total and, for contexts
  with unseen successors, with what their backoff weight needs. A context of
  more than 1 / (8 * buckets) of all tokens is dealt by the last word instead,
  and its sums over buckets, one row for each such context, are broadcast: no
  context, however frequent, lands in one task.

A chunk asks for a word, bigram or trigram once however often it holds it, and
the tables grow with the corpus. Answers also say what no other chunk holds:
successors of such a context needn't be asked for, the chunk knows them all.
Chunks are bucketed by number, so they don't move when the answers come back.

Model: counts r of 1 to K are discounted by Good-Turing (Katz 1987), larger
ones are reliable and stay. Where no count is discounted (every word, or every
successor of a context, is seen more than K times) nothing would be left for
what wasn't seen: there, all counts lose TAIL. P(w) = r* / N, the rest for any
unknown word. P(w | v) = r*(v, w) / c(v) if (v, w) was seen, else a(v) P(w) with
a(v) = (1 - sum of P(w | v) over seen w) / (1 - sum of P(w) over seen w): exactly
normalised. P(w | u, v) likewise from P(w | v). A context that wasn't seen has
a = 1. A text is scored from a begin context to its end token: its first token
by the begin's bigrams, each other one by the trigram it ends.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, pieces, ship, shuffle_partitions, stored
from .ngram_join import mixed, word_hashes

CHUNK_TOKENS = 2_200_000
K = 5
TAIL = 0.1
#: The end token, which no word equals: words hold no white space.
END = np.uint64(0x0E0D0E0D0E0D0E0D)
DOC = np.dtype([("id", "<i8"), ("known", "?"), ("held", "?"), ("n", "<i4")])
#: Statistics of a context: seen bigrams of count 1 .. K, of more, and the sum of P(w) over them.
CONTEXT = np.dtype([("v", "<i8"), ("n", "<i8", (K + 1,)), ("p", "<f8")])


def pack(a: np.ndarray) -> bytes:
    """Compressed by byte planes."""
    import zstandard

    a = np.ascontiguousarray(a)
    return a.dtype.str.encode().ljust(4) + zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unpack(b: bytes) -> np.ndarray:
    import zstandard

    kind = np.dtype(b[:4].decode().strip())
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[4:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def discounts(counts: np.ndarray) -> np.ndarray:
    """d[r] for r = 1 .. K (d[0] unused) from the numbers counts[r - 1] of types seen r times, r = 1 .. K + 1.

    Good-Turing; where it gives nothing between 0 and 1, half a count is taken off.
    """
    d = 1 - 0.5 / np.arange(1, K + 1)
    n = counts[: K + 1].astype(float)
    if n[0] > 0:
        a = (K + 1) * n[K] / n[0]
        for r in range(1, K + 1):
            if n[r - 1] > 0 and a < 1:
                x = ((r + 1) * n[r] / n[r - 1] / r - a) / (1 - a)
                if 0 < x < 1:
                    d[r - 1] = x
    return np.concatenate([[0.0], d])


def discounted(c: np.ndarray, d: np.ndarray, tail: float | np.ndarray) -> np.ndarray:
    """r* of counts c; tail: what counts above K lose."""
    return np.where(c > K, c - tail, d[np.minimum(c, K)] * c)


def word_probability(c: np.ndarray, total: int, d: np.ndarray, tail: float, unknown: float) -> np.ndarray:
    return np.where(c > 0, discounted(c, d, tail) / max(total, 1), unknown)


def spent(n: np.ndarray) -> np.ndarray:
    """Whether types counted 1 .. K times and (last) more often leave nothing by Good-Turing."""
    return n[..., :K].sum(-1) == 0


def unknown_mass(total: int, counts: np.ndarray, d: np.ndarray) -> float:
    """What the discounts of words leave; 1 where nothing was seen."""
    if not total:
        return 1.0
    r = np.arange(1, K + 1)
    return float(((1 - d[1:]) * r * counts[:K]).sum() + (TAIL * counts[K + 1] if spent(counts) else 0)) / total


def range_of(h: np.ndarray, n: int) -> np.ndarray:
    """The hash range, of n, that holds each h; rises with h."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def bigrams(stream: np.ndarray, docs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, place of each token's bigram, training count) of the distinct bigrams by first, second; first = size: begin."""
    ends = np.cumsum(docs["n"])
    before = np.empty(len(stream), np.int64)
    before[1:] = stream[:-1]
    before[ends - docs["n"]] = size
    keys, place = np.unique(before * (size + 1) + stream, return_inverse=True)
    train = np.repeat(~docs["held"], docs["n"])
    return keys // (size + 1), keys % (size + 1), place, np.bincount(place[train], minlength=len(keys))


def trigrams(place: np.ndarray, docs: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, last, at, place, training count) of the distinct trigrams, each two bigrams; at: the tokens that end one.

    Contexts come by their second word, so that what depends on it repeats and packs well.
    """
    size = len(first)
    by_second = np.argsort(second * (int(first.max()) + 1) + first) if size else np.zeros(0, np.int64)
    rank = np.empty(size, np.int64)
    rank[by_second] = np.arange(size)
    inner = np.ones(len(place), bool)
    inner[np.cumsum(docs["n"]) - docs["n"]] = False
    at = np.flatnonzero(inner)
    keys, which = np.unique(rank[place[at - 1]] * size + place[at], return_inverse=True)
    train = np.repeat(~docs["held"], docs["n"])[at]
    return by_second[keys // size], keys % size, at, which, np.bincount(which[train], minlength=len(keys))


def request_order(c: np.ndarray, always: np.ndarray, alone: np.ndarray, near: np.ndarray, far: np.ndarray, total: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bucket, spread) in which n-grams are asked for: those of contexts seen c > 0 times that other chunks hold too,
    by the context's hash near; of frequent contexts, and always, by the last word's hash far."""
    spread = always | (c * 8 * buckets > total)
    ask = np.flatnonzero(always | ((c > 0) & ~alone))
    bucket = range_of(np.where(spread[ask], far[ask], near[ask]), buckets)
    order = np.lexsort((ask, spread[ask], bucket))
    return ask[order], bucket[order], spread[ask][order]


def key_of(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A pair of word ids as one number."""
    with np.errstate(over="ignore"):
        return mixed(mixed(u.view(np.uint64)) + v.view(np.uint64)).view(np.int64)


#: The chunk of a request that only brings the numbers of n-grams by count of contexts that weren't asked for.
KNOWN = -5
REQUEST = "bucket long, chunk long, spread int, u binary, v binary, runs binary, base binary, w binary, lower binary, counts binary"
ANSWER = "chunk long, kind int, bucket long, x binary, y binary"


def requests(chunk: int, bucket: np.ndarray, spread: np.ndarray, u: np.ndarray, v: np.ndarray, base: np.ndarray, w: np.ndarray, lower: np.ndarray, counts: np.ndarray, known: np.ndarray) -> pa.Table:
    """Rows of one bucket each, of n-grams in the order they are asked for: contexts (u, v) with their counts (base) as runs.

    known: the counts of those that weren't asked for; a row of its own brings their numbers.
    """
    rows: dict = {k.split()[0]: [] for k in REQUEST.split(", ")}
    cuts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (spread[1:] != spread[:-1])]) if len(bucket) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)]):
        starts = np.flatnonzero(np.r_[True, (u[a + 1 : b] != u[a : b - 1]) | (v[a + 1 : b] != v[a : b - 1])])
        of_run = {"u": u[a:b][starts], "v": v[a:b][starts], "runs": np.diff(np.r_[starts, b - a]), "base": base[a:b][starts]}
        for name, x in (("bucket", int(bucket[a])), ("chunk", chunk), ("spread", int(spread[a])), *((k, pack(x)) for k, x in of_run.items()), ("w", pack(w[a:b])), ("lower", pack(lower[a:b])), ("counts", pack(counts[a:b]))):
            rows[name].append(x)
    for name, x in (("bucket", 0), ("chunk", KNOWN), ("spread", 0), *((k, b"") for k in ("u", "v", "runs", "base", "w", "lower")), ("counts", pack(by_count(known)))):
        rows[name].append(x)
    kinds = {"bucket": pa.int64(), "chunk": pa.int64(), "spread": pa.int32()}
    return pa.table({k: pa.array(x, kinds.get(k, pa.binary())) for k, x in rows.items()})


def by_count(counts: np.ndarray) -> np.ndarray:
    """Numbers of n-grams counted 1 .. K + 1 times."""
    return np.bincount(np.minimum(counts[counts > 0], K + 2), minlength=K + 3)[1 : K + 2].astype(np.int64)


def answers(bucket: int, t: pa.Table, kind: int, lower_p) -> pa.Table:
    """What a bucket answers to its requests: rows (chunk, kind + spread, bucket, counts, context statistics); one (-1, kind)
    of the numbers of n-grams by count; one (-2, kind) for what it holds of each spread context.

    lower_p: the probability of the last word by the order below, from lower and base.
    """
    rows = t.to_pylist()
    known = [unpack(r["counts"]) for r in rows if r["chunk"] == KNOWN]
    out = {"chunk": [-1], "kind": [kind], "bucket": [bucket], "x": [pack(np.sum(known, 0))], "y": [b""]} if known else {k: [] for k in ("chunk", "kind", "bucket", "x", "y")}
    kinds = {"chunk": pa.int64(), "kind": pa.int32(), "bucket": pa.int64()}
    rows = [r for r in rows if r["chunk"] != KNOWN]
    if not rows:
        return pa.table({k: pa.array(x, kinds.get(k, pa.binary())) for k, x in out.items()})
    each = [unpack(r["runs"]) for r in rows]
    context = np.concatenate([np.repeat(key_of(unpack(r["u"]), unpack(r["v"])), n) for r, n in zip(rows, each, strict=True)])
    size = [int(n.sum()) for n in each]
    with np.errstate(over="ignore"):
        names = mixed(mixed(context.view(np.uint64)) + np.concatenate([unpack(r["w"]) for r in rows]).view(np.uint64))
    _, one, place = np.unique(names, return_index=True, return_inverse=True)
    del names
    count = np.bincount(place, np.concatenate([unpack(r["counts"]) for r in rows]), len(one)).astype(np.int64)
    base = np.concatenate([np.repeat(unpack(r["base"]), n) for r, n in zip(rows, each, strict=True)])[one]
    p = lower_p(np.concatenate([unpack(r["lower"]) for r in rows])[one], base)
    del base
    seen = count > 0
    contexts, at = np.unique(context[one], return_inverse=True)
    stat = np.zeros(len(contexts), CONTEXT)
    stat["v"] = contexts
    stat["n"] = np.bincount(at[seen] * (K + 1) + np.minimum(count[seen], K + 1) - 1, minlength=len(stat) * (K + 1)).reshape(-1, K + 1)
    stat["p"] = np.bincount(at, np.where(seen, p, 0), len(contexts))
    for name, x in (("chunk", -1), ("kind", kind), ("bucket", bucket), ("x", pack(by_count(count))), ("y", b"")):
        out[name].append(x)
    # counts are given twice over, and one more where no other chunk asks; as negative where the context is spent: they lose TAIL
    once = np.bincount(place, minlength=len(one)) == 1
    coded = 2 * count + once
    counted = np.where(spent(stat["n"])[at], -coded, coded)
    wide = np.repeat([r["spread"] > 0 for r in rows], size)
    for c in np.unique(at[place[wide]]):
        for name, x in (("chunk", -2), ("kind", kind), ("bucket", int(contexts[c])), ("x", stat[c : c + 1].tobytes()), ("y", b"")):
            out[name].append(x)
    a = 0
    for r, n in zip(rows, size, strict=True):
        here = place[a : a + n]
        if r["spread"]:  # of a spread context this is a part only
            got, need = coded[here], stat[:0]
        else:
            got = counted[here]
            need = stat[np.unique(at[here[count[here] == 0]])]
        for name, x in (("chunk", r["chunk"]), ("kind", kind + r["spread"]), ("bucket", bucket), ("x", pack(got)), ("y", pack_stats(need))):
            out[name].append(x)
        a += n
    return pa.table({k: pa.array(x, kinds.get(k, pa.binary())) for k, x in out.items()})


def signed_counts(rows: list[dict], order: np.ndarray, spread: np.ndarray, context: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts a chunk's n-grams were answered with, whether no other chunk holds them), in its own order; counts are
    negative where the context is spent. wide: spread contexts as a whole."""
    coded = np.zeros(len(context), np.int64)
    if rows:
        coded[order] = np.concatenate([unpack(r["x"]) for r in sorted(rows, key=lambda r: (r["bucket"], r["kind"]))])
    c = np.sign(coded) * (np.abs(coded) >> 1)
    if len(wide) and spread.any():
        of_spent = order[spread][np.isin(context[order[spread]], wide["v"][spent(wide["n"])])]
        c[of_spent] = -np.abs(c[of_spent])
    return c, (coded & 1).astype(bool)


def known_contexts(context: np.ndarray, alone: np.ndarray, train: np.ndarray, lower: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Puts the counts of contexts that no other chunk holds into c; their statistics. lower: the probabilities by the order below."""
    mine = np.flatnonzero(alone)
    contexts, at = np.unique(context[mine], return_inverse=True)
    stat = np.zeros(len(contexts), CONTEXT)
    stat["v"] = contexts
    count, seen = train[mine], train[mine] > 0
    stat["n"] = np.bincount(at[seen] * (K + 1) + np.minimum(count[seen], K + 1) - 1, minlength=len(stat) * (K + 1)).reshape(-1, K + 1)
    stat["p"] = np.bincount(at, np.where(seen, lower[mine], 0), len(contexts))
    c[mine] = np.where(spent(stat["n"])[at], -count, count)
    return stat


def log_probabilities(c: np.ndarray, of: np.ndarray, lower: np.ndarray, context: np.ndarray, rows: list[dict], more: list[np.ndarray], d: np.ndarray) -> np.ndarray:
    """log10 P of n-grams counted c (signed) after contexts counted ``of``; lower: log10 P by the order below; more: context statistics beside those answered."""
    out = lower.copy()
    seen = c != 0
    out[seen] = np.log10(discounted(np.abs(c[seen]), d, np.where(c[seen] < 0, TAIL, 0)) / of[seen])
    back = np.flatnonzero(~seen & (of > 0))
    if len(back):
        stat = np.concatenate([*more, *[unpack_stats(r["y"]) for r in rows]])
        stat = stat[np.argsort(stat["v"], kind="stable")]
        s = stat[np.searchsorted(stat["v"], context[back])]
        left = ((1 - d[1:]) * np.arange(1, K + 1) * s["n"][:, :K]).sum(1) + np.where(spent(s["n"]), TAIL * s["n"][:, K], 0)
        out[back] += np.log10(left / of[back]) - np.log10(1 - s["p"])
    return out


def score(docs: DataFrame, modulus: int = 7, held_out: int = 2, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of docs (doc_id, text, ...).

    Trained on the rows whose crc32(doc_id as text) mod modulus isn't held_out
    (null doc_ids train). base_score: add-one unigram log10 probability;
    score: the Katz model's. Null and empty texts are one end token. Repeated
    rows stay and count again. Other columns are ignored; an empty table gives
    no rows, and without training rows every word is unknown.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets0 = shuffle_partitions(spark)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import katz_lm as own

        number, meta, hashes, held = TaskContext.get().partitionId() << 24, [], [], 0

        def row() -> pa.RecordBatch:
            words, stream = np.unique(np.concatenate(hashes), return_inverse=True)
            d = np.array(meta, own.DOC)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([d.tobytes()]), pa.array([words.tobytes()]), pa.array([own.pack(stream.astype(np.int32))])], ["chunk", "docs", "words", "stream"])

        for batch in pieces(batches):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.append(own.word_hashes(t), own.END)
                out = k is not None and zlib.crc32(str(k).encode()) % modulus == held_out
                meta.append((k or 0, k is not None, out, len(h)))
                hashes.append(h)
                held += len(h)
                if held >= chunk_tokens:
                    yield row()
                    number, meta, hashes, held = number + 1, [], [], 0
        if meta:
            yield row()

    table = f"katz_chunks_{uuid.uuid4().hex}"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    source.mapInArrow(chunked, "chunk long, docs binary, words binary, stream binary").write.bucketBy(buckets0, "chunk").format("parquet").option("compression", "none").saveAsTable(table)
    chunks = spark.table(table)

    # -- words -----------------------------------------------------------------
    asked = chunks.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    b1 = int(max(8, buckets0, asked // 8 // 1_000_000))

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import katz_lm as own

        for batch in batches:
            for k in range(batch.num_rows):
                d, words, stream = own.chunk_of(batch.slice(k, 1))
                counts = np.bincount(stream[np.repeat(~d["held"], d["n"])], minlength=len(words))
                cuts = np.searchsorted(own.range_of(words, b1), np.arange(b1 + 1))
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(np.full(len(some), batch.column(0)[k].as_py()), pa.int64()), pa.array([words[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()), pa.array([own.pack(counts[cuts[b] : cuts[b + 1]]) for b in some], pa.binary())], ["bucket", "chunk", "words", "counts"])

    def answer_words(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        asked_ = [np.frombuffer(x, np.uint64) for x in t.column("words").to_pylist()]
        counts = np.concatenate([own.unpack(x) for x in t.column("counts").to_pylist()])
        words, place = np.unique(np.concatenate(asked_), return_inverse=True)
        total = np.bincount(place, counts, len(words)).astype(np.int64)
        coded = 2 * total + (np.bincount(place, minlength=len(words)) == 1)  # one more where one chunk asks
        ids = np.empty(len(words), np.int64)
        ids[np.argsort(-total, kind="stable")] = np.arange(len(words)) * b1 + key[0].as_py()
        cuts = np.cumsum([0] + [len(x) for x in asked_])
        seen = total[total > 0]
        stats = np.concatenate([[seen.sum(), len(seen)], np.bincount(np.minimum(seen, own.K + 2), minlength=own.K + 3)[1 : own.K + 2], [(seen > own.K).sum()]]).astype(np.int64)
        return pa.table({"chunk": pa.array([-1] + t.column("chunk").to_pylist(), pa.int64()), "kind": pa.array([0] * (len(asked_) + 1), pa.int32()), "bucket": pa.array([key[0].as_py()] * (len(asked_) + 1), pa.int64()), "x": pa.array([own.pack(stats)] + [own.pack(coded[place[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()), "y": pa.array([b""] + [own.pack(ids[place[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary())})

    words_table = stored(chunks.mapInArrow(ask_words, "bucket long, chunk long, words binary, counts binary").groupBy("bucket").applyInArrow(answer_words, ANSWER), "katz-words", "none")
    stats = summed_up(words_table.where("chunk = -1"), K + 4)
    total, types, word_counts = int(stats[0]), int(stats[1]), stats[2:]
    d1 = discounts(word_counts)
    tail1 = TAIL if spent(word_counts) else 0.0
    unknown = unknown_mass(total, word_counts, d1)

    def asked_by(part: pa.Table, right: pa.Table) -> tuple:
        """A chunk's documents, words, their counts and ids, its bigrams with the order they are asked for in, and which of their contexts it alone holds."""
        from statuta.llm import katz_lm as own

        d, words, stream = own.chunk_of(part)
        counts, ids = own.answers_of([r for r in right.to_pylist() if r["kind"] == 0])
        counts, alone = counts >> 1, np.append(counts & 1, 0).astype(bool)
        first, second, place, train = own.bigrams(stream, d, len(words))
        begin, alone = first == len(words), alone[first]
        order = own.request_order(np.append(counts, 0)[first], begin, alone, words[np.minimum(first, len(words) - 1)], words[second], total, b2)
        return d, words, counts, ids, first, second, place, train, alone, order

    def seen_bigrams(right: pa.Table, counts: np.ndarray, ids: np.ndarray, first: np.ndarray, second: np.ndarray, train: np.ndarray, alone: np.ndarray, order: tuple, wide: np.ndarray) -> tuple:
        """(rows of answers, contexts, counts, statistics of contexts it alone holds, which bigrams it alone holds) of a chunk's bigrams."""
        from statuta.llm import katz_lm as own

        rows = [r for r in right.to_pylist() if r["kind"] in (1, 2)]
        context = own.key_of(np.full(len(first), -2, np.int64), np.append(ids, -1)[first])
        c, once = own.signed_counts(rows, order[0], order[2], context, wide)
        stat = own.known_contexts(context, alone, train, own.word_probability(counts, total, d1, tail1, unknown)[second], c)
        return rows, context, c, stat, once | alone

    # -- bigrams ----------------------------------------------------------------
    b2 = int(max(8, buckets0, total // 2_000_000, asked // 8 // 2_000_000))

    def ask_bigrams(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        if not left.num_rows:
            return own.empty(own.REQUEST)
        _, _, counts, ids, first, second, _, train, alone, (order, bucket, spread) = asked_by(left, right)
        v = np.append(ids, -1)[first][order]
        nothing = np.zeros(len(order), np.int64)
        return own.requests(key[0].as_py(), bucket, spread, nothing - 2, v, nothing, ids[second[order]], counts[second[order]], train[order], train[alone])

    def answer_bigrams(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        return own.answers(key[0].as_py(), t, 1, lambda lower, _: own.word_probability(lower, total, d1, tail1, unknown))

    def told(*tables: DataFrame) -> DataFrame:
        return functools.reduce(DataFrame.unionAll, tables).where("chunk >= 0").groupBy("chunk")

    bigram_table = stored(chunks.groupBy("chunk").cogroup(told(words_table)).applyInArrow(ask_bigrams, REQUEST).groupBy("bucket").applyInArrow(answer_bigrams, ANSWER), "katz-bigrams", "none")
    d2 = discounts(summed_up(bigram_table.where("chunk = -1"), K + 1))
    wide2 = _wide(bigram_table)

    # -- trigrams ---------------------------------------------------------------
    b3 = int(max(8, buckets0, total // 1_000_000))

    def of_trigrams(words: np.ndarray, first: np.ndarray, second: np.ndarray, c2: np.ndarray, alone2: np.ndarray, context: np.ndarray, last: np.ndarray) -> tuple:
        from statuta.llm import katz_lm as own

        h = np.append(words, own.END + np.uint64(1))  # of the begin
        near = own.key_of(h[first].view(np.int64), h[second].view(np.int64)).view(np.uint64)[context]
        c = np.abs(c2)[context]
        return own.request_order(c, np.zeros(len(c), bool), alone2[context], near, words[second[last]], total, b3)

    def ask_trigrams(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        if not left.num_rows:
            return own.empty(own.REQUEST)
        d, words, counts, ids, first, second, place, train, alone, order2 = asked_by(left, right)
        _, _, c2, _, alone2 = seen_bigrams(right, counts, ids, first, second, train, alone, order2, wide2.value)
        context, last, _, _, train = own.trigrams(place, d, first, second)
        order, bucket, spread = of_trigrams(words, first, second, c2, alone2, context, last)
        known = train[alone2[context]]
        context, last = context[order], last[order]
        # the context's count, and for the order below the count of what the last word follows
        follows = own.after(counts, words)[first[last]]
        u, v = np.append(ids, -1)[first[context]], ids[second[context]]
        return own.requests(key[0].as_py(), bucket, spread, u, v, follows, ids[second[last]], c2[last], train[order], known)

    def answer_trigrams(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        return own.answers(key[0].as_py(), t, 3, lambda lower, base: own.discounted(np.abs(lower), d2, np.where(lower < 0, own.TAIL, 0)) / np.maximum(base, 1))

    trigram_table = stored(chunks.groupBy("chunk").cogroup(told(words_table, bigram_table)).applyInArrow(ask_trigrams, REQUEST).groupBy("bucket").applyInArrow(answer_trigrams, ANSWER), "katz-trigrams", "none")
    d3 = discounts(summed_up(trigram_table.where("chunk = -1"), K + 1))
    wide3 = _wide(trigram_table)

    # -- scores -----------------------------------------------------------------
    def scored(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        if not left.num_rows:
            return own.empty(own.SCORES)
        d, words, counts, ids, first, second, place, train, alone, order2 = asked_by(left, right)
        rows, context2, c2, stat2, alone2 = seen_bigrams(right, counts, ids, first, second, train, alone, order2, wide2.value)
        p1 = np.log10(own.word_probability(counts, total, d1, tail1, unknown))
        p2 = own.log_probabilities(c2, own.after(counts, words)[first], p1[second], context2, rows, [wide2.value, stat2], d2)
        context, last, at, which, train = own.trigrams(place, d, first, second)
        order, _, spread = of_trigrams(words, first, second, c2, alone2, context, last)
        rows = [r for r in right.to_pylist() if r["kind"] > 2]
        context3 = own.key_of(np.append(ids, -1)[first], ids[second])[context]
        c3, _ = own.signed_counts(rows, order, spread, context3, wide3.value)
        stat3 = own.known_contexts(context3, alone2[context], train, 10 ** p2[last], c3)
        p3 = own.log_probabilities(c3, np.abs(c2)[context], p2[last], context3, rows, [wide3.value, stat3], d3)
        tokens = p2[place]
        tokens[at] = p3[which]
        starts = np.cumsum(d["n"]) - d["n"]
        stream = second[place]
        known = (counts > 0)[stream]
        base = np.log10((counts + 1) / (total + types + 1))[stream]
        doc = pa.array(d["id"].copy(), mask=~d["known"])
        return pa.table({"doc_id": doc, "held_out": pa.array(d["held"].copy()), "n_tokens": pa.array(d["n"].astype(np.int64)), "n_known": pa.array(np.add.reduceat(known.astype(np.int64), starts)), "base_score": pa.array(np.add.reduceat(base, starts)), "score": pa.array(np.add.reduceat(tokens, starts))})

    out = chunks.groupBy("chunk").cogroup(told(words_table, bigram_table, trigram_table)).applyInArrow(scored, SCORES)
    out = stored(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"), "katz-scores")
    discard(words_table, bigram_table, trigram_table)
    spark.sql(f"drop table {table}")
    return out


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def after(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How often something follows each word in training, and (last) a begin: texts begin as often as they end."""
    return np.append(counts, counts[np.searchsorted(words, END)])


def _wide(answered: DataFrame):
    """Broadcast: the statistics of spread contexts, at most 8 for each bucket and the begin, summed over buckets."""

    def summed(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import katz_lm as own

        s = np.frombuffer(b"".join(t.column("x").to_pylist()), own.CONTEXT)
        one = s[:1].copy()
        one["n"], one["p"] = s["n"].sum(0), s["p"].sum()
        return pa.table({"x": pa.array([one.tobytes()], pa.binary())})

    rows = answered.where("chunk = -2").groupBy("bucket").applyInArrow(summed, "x binary").collect()
    return answered.sparkSession.sparkContext.broadcast(np.frombuffer(b"".join(bytes(r["x"]) for r in rows), CONTEXT))


def pack_stats(a: np.ndarray) -> bytes:
    """Context statistics, compressed by byte planes."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) if len(a) else b""


def unpack_stats(b: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8) if b else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(CONTEXT.itemsize, -1).T).reshape(-1).view(CONTEXT)


def summed_up(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the packed numbers in column x, added on the executors: one short row a task comes back."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import katz_lm as own

        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += own.unpack(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["k", "n"])

    out = np.zeros(size, np.int64)
    for r in rows.select("x").mapInArrow(added, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def chunk_of(t: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = t.to_pylist()[0]
    return np.frombuffer(r["docs"], DOC), np.frombuffer(r["words"], np.uint64), unpack(r["stream"]).astype(np.int64)


def answers_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and ids of a chunk's words, in the words' order: buckets are hash ranges."""
    rows = sorted(rows, key=lambda r: r["bucket"])
    return np.concatenate([unpack(r["x"]) for r in rows]), np.concatenate([unpack(r["y"]) for r in rows])


def empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.table({n: pa.array([], kinds[k]) for n, k in (f.split() for f in schema.split(", "))})


def op6_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
