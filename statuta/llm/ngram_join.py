"""N-gram Jaccard join: near-duplicate classes of documents, exactly.

A document's set is its distinct word n-grams, as 64-bit hashes. Two documents
link when Jaccard similarity reaches num/den. The join works on the sparse
document by n-gram incidence matrix, block by block:

1. Documents with equal sets (by a 128-bit digest) are one class, named by the
   row number of its first member.
2. Each class keeps the columns of its prefix only: with n-grams ordered rare
   first, a set of size s shares an n-gram of its first
   s - ceil(s * num/den) + 1 with every set it links with. The order is by
   frequency summaries of all documents, then by hash; any order is exact.
3. The incidence is cut into column blocks by n-gram hash; in each block the
   columns with two or more classes are found by sorting. Columns of equal
   membership count once.
4. Overlap counts of candidate pairs are accumulated, first on folded rows:
   a class's incidence row, folded to as many buckets as it has n-grams, as
   bit planes of the buckets' counts. Bucket by bucket the smaller counts add
   up to at least the overlap, so pairs whose sum, or whose sizes, rule the
   similarity out are discarded. The rest are counted on whole sets. Each
   column first checks its members against one of them, its centre; what these
   links leave in different components is then multiplied block by block.
   Pairs already connected needn't be looked at; of the others each member
   hands on its ``PARTNERS`` likeliest first, and the rest in further rounds,
   when what these linked is connected. So a large group of near copies costs
   its size, not the square.

No candidate is dropped, capped or sampled: the rounds end when none is left.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import components, discard, give_back, only, pieces, ship, shuffle_partitions, stored

#: Entries of the table of frequent n-grams, at most; and the documents of a task in which an n-gram counts as frequent.
FREQUENT_ENTRIES = 200_000
FREQUENT_LOCAL = 4
#: Documents of an n-gram from which its postings aren't gathered in a task, but go as rows.
HOT = 1_000_000
#: Words whose hashes a worker keeps.
CACHE_ENTRIES = 200_000
#: Pairs that may be broadcast (16 bytes each).
FEW_PAIRS = 500_000
#: Members of a centre that are multiplied together, and bytes of their folded rows; groups of few go to tasks of so many bytes.
BLOCK, BLOCK_BYTES = 8192, 64_000_000
TASK_BYTES = 8_000_000
#: Partners of a member whose whole sets are compared in the first round; eight times as many in each further one.
PARTNERS = 8
#: Buckets of a folded row, at least (as a power of two): 64, a word.
LEAST_BITS = 6
#: Bytes of prefixes that are packed together.
PACK_BYTES = 8_000_000
#: Counts of a bucket that have a plane of bits; what is above is only summed.
PLANES = 3
_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """Word to 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def word_hashes(text: str | bytes | None) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased."""
    words = (text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")).lower().split()  # on bytes: ASCII letters, ASCII white space
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> np.uint64(32))) * _P1
    h = (h ^ (h >> np.uint64(29))) * _P2
    return h ^ (h >> np.uint64(32))


def shingles(text: str | bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; fewer words than n: the whole sequence as one; none: empty."""
    w = word_hashes(text)
    if len(w) == 0:
        return w
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        h = mixed(h + w[j : len(w) - k + 1 + j])
    return np.unique(h)


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-size * num // den) + 1 if size else 0


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of n-grams that are frequent in some task, ordered later by value: (hash, count) rows, most counted first."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import ngram_join as own

        waiting, held, counts = [], 0, {}

        def settle() -> None:
            h, c = np.unique(np.concatenate(waiting), return_counts=True)
            keep = c >= own.FREQUENT_LOCAL
            for k, v in zip(h[keep].tolist(), c[keep].tolist(), strict=True):
                counts[k] = counts.get(k, 0) + v
            waiting.clear()

        for batch in pieces(batches):
            for t in batch.column(0).to_pylist():
                waiting.append(own.shingles(t, n))
                held += len(waiting[-1])
                if held > 2_000_000:
                    settle()
                    held = 0
        if waiting:
            settle()
        top = sorted(counts.items(), key=lambda x: -x[1])[: own.FREQUENT_ENTRIES]
        yield pa.RecordBatch.from_arrays([pa.array(np.array([k for k, _ in top], np.uint64).view(np.int64)), pa.array([v for _, v in top], pa.int64())], ["h", "c"])

    rows = docs.select("text").mapInArrow(local, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(FREQUENT_ENTRIES).toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    c = rows.column("c").to_numpy()
    order = np.argsort(h)
    return np.stack([h[order], c[order].astype(np.uint64)]) if len(h) else np.zeros((2, 0), np.uint64)


def prefix(s: np.ndarray, table: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first prefix_length n-grams of sorted set s, rare ones first."""
    k = prefix_length(len(s), num, den)
    if k >= len(s):
        return s
    count = np.zeros(len(s), np.uint64)
    if table.shape[1]:
        at = np.minimum(np.searchsorted(table[0], s), table.shape[1] - 1)
        count = np.where(table[0][at] == s, table[1][at], np.uint64(0))
    return s[np.lexsort((s, count))[:k]]


def folded(s: np.ndarray) -> bytes:
    """The incidence row of set s, folded: the sum of counts above PLANES, then a plane of bits for each count up to it."""
    if not len(s):
        return b""
    bits = fold_bits(len(s))
    c = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    planes = np.packbits(c >= np.arange(1, PLANES + 1)[:, None], axis=1)
    return np.int64(np.maximum(c - PLANES, 0).sum()).tobytes() + planes.tobytes()


def fold_bits(size: int) -> int:
    """Of the bucket numbers of a set of this size: at least as many buckets as n-grams."""
    return max(LEAST_BITS, int(size - 1).bit_length())


def halved(over: np.ndarray, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded rows (over (n), planes (n, words)) folded once more, to half the buckets."""
    n = len(planes)
    c = np.unpackbits(planes.view(np.uint8).reshape(n, PLANES, -1), axis=2).sum(1, dtype=np.uint8)
    c = c[:, 0::2] + c[:, 1::2]
    out = np.packbits(c[:, None, :] >= np.arange(1, PLANES + 1)[None, :, None], axis=2)
    return over + np.maximum(c.astype(np.int64) - PLANES, 0).sum(1), np.ascontiguousarray(out).reshape(n, -1).view(np.uint64)


def _folded_to(over: np.ndarray, planes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Folded rows, folded until they have 2 ** bits buckets."""
    while planes.shape[1] * 64 > PLANES << bits:
        over, planes = halved(over, planes)
    return over, planes


def rows_of(folds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(over, planes) of folded rows of equal length."""
    r = np.frombuffer(b"".join(folds), np.uint64).reshape(len(folds), -1)
    return r[:, 0].astype(np.int64), np.ascontiguousarray(r[:, 1:])


def may_link(x: bytes, y: bytes, size_x: int, size_y: int, num: int, den: int) -> bool:
    """Whether sets of these folded rows and sizes can reach num/den."""
    if den * min(size_x, size_y) < num * max(size_x, size_y):
        return False
    a, b = rows_of([x]), rows_of([y])
    while a[1].shape[1] > b[1].shape[1]:
        a = halved(*a)
    while b[1].shape[1] > a[1].shape[1]:
        b = halved(*b)
    most = int(np.bitwise_count(a[1] & b[1]).sum()) + int(min(a[0][0], b[0][0]))
    return (num + den) * most >= num * (size_x + size_y)


def ngram_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, set_1, set_2), one for each row of docs (doc_id, text, ...).

    Documents link when den * intersection >= num * union of their sets of
    word n-grams; component_id is the smallest doc_id reachable by links, the
    own one where there is none. Texts that are null, empty or white space
    have an empty set (set_1 null) and link with nothing. Equal sets always
    link. Repeated rows stay; a null doc_id takes part, and is never a
    component_id unless all ids of its component are null. Other columns are
    ignored; an empty table gives no rows. The result is a stored table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, joined, used = _classes(rows, n, num, den)
    least = joined.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    least = least.withColumnRenamed("class", "k")
    out = joined.join(least, F.col("class") == F.col("k"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "set_1", "set_2")
    out = stored(out, "ngram-result")
    discard(found, *used)
    return out


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs, with all its columns, less all but one document of each component.

    The one with the smallest doc_id stays (null ids last, then by a hash of
    the whole row; of rows that are equal in every column any one). Documents
    with an empty set are in no component and stay, repeated or not. An empty
    table gives an empty one; columns of any name are carried.
    """
    # a row is known by its content: what is kept or dropped is said by key, and no text is stored twice
    key = F.unhex(F.md5(F.to_json(F.struct("*"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("_key"))
    found, joined, used = _classes(rows, n, num, den)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("_key").alias("key")))
    groups = joined.where("class is not null").groupBy("class").agg(first.alias("m"), F.count("*").alias("n")).where("n > 1").select(F.col("class").alias("k"), F.col("m.key").alias("kept"))
    keys = joined.join(groups, F.col("class") == F.col("k")).groupBy("_key").agg(F.max(F.col("_key") == F.col("kept")).alias("kept"), F.count("*").alias("n"))
    gone = stored(keys.where("not kept or n > 1").select("_key", "kept"), "ngram-gone")
    discard(found, *used)
    most = F.broadcast if gone.count() <= FEW_PAIRS else (lambda x: x)
    whole = docs.select(F.struct("*").alias("_all"), key.alias("_key"))
    rest = whole.join(most(gone.select("_key")), "_key", "left_anti").select("_all.*")
    again = gone.where("kept").select("_key")
    if again.isEmpty():
        return rest
    twice = whole.join(most(again), "_key", "left_semi").groupBy("_key").agg(F.first("_all").alias("_all"))
    return rest.unionAll(twice.select("_all.*"))


def _classes(rows: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """rows (doc_id, text, ...) -> their other columns stored with n_shingles, set_1, set_2; the same with the component's
    node as class; and the stored tables that the second reads."""
    spark = rows.sparkSession
    ship(spark)
    table = spark.sparkContext.broadcast(_frequent(rows, n))
    given = rows.select("text", F.monotonically_increasing_id().alias("_row"), *[c for c in rows.columns if c != "text"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        from statuta.llm import ngram_join as own

        for batch in pieces(batches):
            size, one, two, heads, folds = [], [], [], [], []
            for t in batch.column(0).to_pylist():
                s = own.shingles(t, n)
                size.append(len(s))
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                one.append(None if len(s) == 0 else (d & (2**64 - 1)) - 2**63)
                two.append(None if len(s) == 0 else (d >> 64) - 2**63)
                heads.append(own.prefix(s, table.value, num, den).tobytes())
                folds.append(own.folded(s))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(heads, pa.binary()), pa.array(folds, pa.binary())], [*batch.schema.names[1:], "n_shingles", "set_1", "set_2", "head", "fold"])

    own_fields = [StructField("n_shingles", LongType()), StructField("set_1", LongType()), StructField("set_2", LongType()), StructField("head", BinaryType()), StructField("fold", BinaryType())]
    found = stored(given.mapInArrow(sets, StructType([*given.schema.fields[1:], *own_fields])), "ngram-sets")
    some = found.where("set_1 is not null")
    first = F.min(F.struct("_row", _key(F.col("doc_id")).alias("key")))
    classes = some.groupBy("set_1", "set_2").agg(first.alias("m"), F.first("n_shingles").alias("size"), F.count("*").alias("n"))
    classes = stored(classes.select("set_1", "set_2", F.col("m._row").alias("node"), F.col("m.key").alias("key"), "size", "n"), "ngram-classes")
    hot = np.sort(table.value[0][table.value[1] > HOT])
    columns = stored(_columns(some.select("set_1", "n_shingles", "head"), hot), "ngram-columns")
    links = _links(rows, found, classes, columns, n, num, den)
    reach = components(links)
    discard(columns, links)
    # the class of a row: its component's node, or its own class's; those alone in theirs need none
    named = classes.join(reach.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").where("n > 1 or component is not null")
    named = named.select(F.col("set_1").alias("s1"), F.col("set_2").alias("s2"), F.coalesce("component", "node").alias("class"))
    slim = found.drop("head", "fold", "_row")
    joined = slim.join(named, (F.col("set_1") == F.col("s1")) & (F.col("set_2") == F.col("s2")), "left").drop("s1", "s2")
    return found, joined, [classes, reach]


def _columns(held: DataFrame, hot: np.ndarray) -> DataFrame:
    """held (name, size, head), names repeated for equal sets -> distinct rows (col, name): columns with two or more names.

    col is a hash of the column's members, so columns of equal membership
    coincide. Block b holds the n-grams of hash range b; a batch of rows sends
    each block one row of packed postings, with every name once. Names are halves
    of digests: should two sets share one, they are candidates of each other's
    partners, no more. Columns of the n-grams in hot (sorted) take no part in
    that: their postings are rows from the start, so no task gathers them.
    """
    postings = held.agg(F.sum(F.octet_length("head"))).first()[0] or 0
    blocks = int(max(8, postings // 8 // 1_000_000))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import ngram_join as own

        def settle() -> pa.RecordBatch:
            names, first = np.unique(np.concatenate([n for n, _ in waiting]), return_index=True)
            heads = list(chain.from_iterable(x for _, x in waiting))
            heads = [np.frombuffer(heads[i], np.uint64) for i in first]
            h = np.concatenate(heads)
            name = np.repeat(names, [len(x) for x in heads])
            if len(hot):
                common = np.isin(h, hot)
                h, name = h[~common], name[~common]
            block = (own.mixed(h) % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            parts = [(b, order[cuts[b] : cuts[b + 1]]) for b in range(blocks) if cuts[b] < cuts[b + 1]]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int32()), pa.array([h[i].tobytes() for _, i in parts], pa.binary()), pa.array([name[i].tobytes() for _, i in parts], pa.binary())], ["block", "h", "node"])

        waiting, held = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append((batch.column(0).to_numpy(), batch.column(2).to_pylist()))
                held += sum(map(len, waiting[-1][1]))
            if held > own.PACK_BYTES:
                yield settle()
                waiting, held = [], 0
        if waiting:
            yield settle()
        give_back()

    def shared(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import ngram_join as own

        h = np.frombuffer(b"".join(t.column("h").to_pylist()), np.uint64)
        node = np.frombuffer(b"".join(t.column("node").to_pylist()), np.int64)
        order = np.lexsort((node, h))
        h, node = h[order], node[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (node[1:] != node[:-1])]
        h, node = h[new], node[new]
        start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        length = np.diff(np.r_[start, len(h)])
        node = node[np.repeat(length > 1, length)]
        length = length[length > 1]
        col = node
        if len(node):
            start = np.cumsum(length) - length
            members = own.mixed(np.add.reduceat(own.mixed(node.view(np.uint64)), start) + length.astype(np.uint64)).view(np.int64)
            chosen = np.zeros(len(length), bool)
            chosen[np.unique(members, return_index=True)[1]] = True
            keep = np.repeat(chosen, length)
            col, node = np.repeat(members, length)[keep], node[keep]
        return pa.table({"col": pa.array(col, pa.int64()), "name": pa.array(node, pa.int64())})

    def rows_of_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            if heads:
                h = np.concatenate(heads)
                common = np.isin(h, hot)
                name = np.repeat(batch.column(0).to_numpy(), [len(x) for x in heads])[common]
                yield pa.RecordBatch.from_arrays([pa.array(h[common].view(np.int64)), pa.array(name, pa.int64())], ["col", "name"])

    sent = held.mapInArrow(packed, "block int, h binary, node binary")
    out = sent.groupBy("block").applyInArrow(shared, "col long, name long")
    return (out.unionAll(held.mapInArrow(rows_of_hot, "col long, name long")) if len(hot) else out).distinct()


def _links(rows: DataFrame, found: DataFrame, classes: DataFrame, columns: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Verified links (a, b) between nodes that connect every component; a stored table."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        from statuta.llm import ngram_join as own

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in pieces(batches):
            texts = batch.column(0).to_pylist()
            digests = [xxhash.xxh3_128_intdigest(own.shingles(t, n).tobytes()) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([(d & (2**64 - 1)) - 2**63 for d in digests], pa.int64()), pa.array([(d >> 64) - 2**63 for d in digests], pa.int64()), pa.array([squeeze((t or "").encode("utf-8", "replace")) for t in texts], pa.binary())], ["set_1", "set_2", "packed"])

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import ngram_join as own

        for batch in batches:
            ok = [own.may_link(x, y, s, t, num, den) for x, y, s, t in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def equal_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from statuta.llm import ngram_join as own

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ok, last = [], (None, None)
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if last[0] != x:
                    last = (x, own.shingles(unpack(x), n))
                u, v = last[1], own.shingles(unpack(y), n)
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(den * both >= num * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def with_both(pairs: DataFrame, of: DataFrame, values: list[str]) -> DataFrame:
        """pairs with both sides' values: one side on the map side if the pairs are few, the other by one shuffle."""
        few = F.broadcast if pairs.count() <= FEW_PAIRS else (lambda x: x)
        right = of.select(F.col("node").alias("b"), *[F.col(v).alias(f"{v}_b") for v in values]).join(few(pairs), "b")
        left = of.select(F.col("node").alias("a"), *[F.col(v).alias(f"{v}_a") for v in values]).join(few(pairs.select("a").distinct()), "a")
        return right.join(left, "a").select("a", "b", *[f"{v}_{side}" for v in values for side in ("a", "b")])

    def nodes_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()

    def folds_of(nodes: DataFrame) -> DataFrame:
        """A class's folded row is its first member's."""
        return only(found, "_row", nodes).select(F.col("_row").alias("node"), "fold", F.col("n_shingles").alias("size"))

    def fitting(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}")), side)
        return pairs.where(F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link, by their whole sets, taken anew from the documents."""
        needed = stored(classes.select("node", "set_1", "set_2", "key").join(nodes_of(pairs), "node", "left_semi"), "ngram-needed")
        texts = only(rows.select(_key(F.col("doc_id")).alias("key"), "text"), "key", needed.select("key").distinct()).select("text")
        # of several documents with one id, or without any, those of the sets asked for
        items = texts.mapInArrow(digested, "set_1 long, set_2 long, packed binary").join(needed.drop("key"), ["set_1", "set_2"])
        items = stored(items.groupBy("node").agg(F.first("packed").alias("packed")), "ngram-items")
        out = stored(with_both(pairs, items, ["packed"]).mapInArrow(equal_enough, "a long, b long").distinct(), "ngram-links")
        discard(needed, items)
        return out

    ordered = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    named = columns.join(classes.select(F.col("set_1").alias("name"), "node", "size"), "name").select("col", "node", "size")
    per_column = named.groupBy("col").agg(F.count("*").alias("n"))
    degree = named.join(per_column, "col").groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = stored(named.join(degree, "node"), "ngram-ranked")

    # first: every member against the one of its column that meets the most others
    centre = ranked.groupBy("col").agg(F.max(F.struct("degree", "node", "size")).alias("c"))
    stars = ranked.join(centre, "col").where(F.least("size", "c.size") * den >= F.greatest("size", "c.size") * num)
    tested = stored(ordered(stars.select(F.col("c.node").alias("a"), F.col("node").alias("b"))), "ngram-stars")
    likely = stored(with_both(tested, folds_of(nodes_of(tested)), ["fold", "size"]).mapInArrow(possible, "a long, b long"), "ngram-likely")
    every = [verified(likely)]
    reach = components(every[0])

    # then: what shares a column shares its centre, so the rest is found among each centre's
    # members in different components, by products of blocks of their folded rows
    of_columns = ranked.join(centre, "col").select("col", F.col("c.node").alias("c"), "node", "size").where("c <> node")
    # in size order, who has any partner of fitting size in a column has a neighbour of fitting size, so a
    # column's sizes are put in order, not its members
    by_size = Window.partitionBy("col").orderBy("size")
    near = (F.col("n") > 1, F.lag("size").over(by_size) * den >= F.col("size") * num, F.col("size") * den >= F.lead("size").over(by_size) * num)
    sizes = of_columns.groupBy("col", "size").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("near", functools.reduce(Column.__or__, [F.coalesce(x, F.lit(False)) for x in near])).where("near").select("col", "size")
    members = stored(of_columns.join(sizes, ["col", "size"], "left_semi").select("c", "node", "size").distinct(), "ngram-members")
    discard(ranked, likely)
    folds = stored(folds_of(members.select("node").distinct()).drop("size"), "ngram-folds")
    open_, partners = members, PARTNERS
    while True:
        parts = open_.join(reach.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").withColumn("part", F.coalesce("component", "node")).drop("k", "component")
        groups = parts.groupBy("c").agg(F.count("*").alias("n"), F.sum("size").alias("ngrams"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
        cut = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("ngrams") * (PLANES / 4) / BLOCK_BYTES)).cast("int")
        parts = stored(parts.join(groups.select("c", cut.alias("blocks")), "c"), "ngram-parts")
        own_block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        dealt = parts.withColumn("own", own_block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("node", "c", "part", "size", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("right"))
        weight = dealt.agg(F.sum("size")).first()[0] or 0
        tasks = int(max(shuffle_partitions(rows.sparkSession), weight * PLANES // 4 // TASK_BYTES))
        dealt = dealt.withColumn("task", F.pmod(F.xxhash64("c", "lo", "hi"), F.lit(tasks))).join(folds, "node")
        found_pairs = stored(dealt.groupBy("task").applyInArrow(_products(num, den, partners), "a long, b long, c long"), "ngram-pairs")
        pairs = stored(found_pairs.where("b is not null").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "ngram-tested")
        more = verified(pairs)
        before, tested = tested, stored(tested.unionAll(pairs), "ngram-tested")
        every.append(more)
        # groups that held pairs back go round again, with what is linked by now
        held_back = found_pairs.where("b is null").select("c").distinct()
        last = held_back.isEmpty()
        discard(before, pairs, parts, reach)
        if last:
            discard(found_pairs)
            break
        before, open_ = open_, stored(open_.join(held_back, "c", "left_semi"), "ngram-members")
        discard(before, found_pairs)
        reach = components(functools.reduce(DataFrame.unionAll, every))
        partners *= 8
    out = stored(functools.reduce(DataFrame.unionAll, every), "ngram-links")
    discard(folds, tested, open_, *every)
    return out


def _products(num: int, den: int, partners: int):
    """The function of one task's groups: pairs (a < b) in different components that may link, by sums over folded
    rows; (c, null, c) for a group where a member has more than ``partners`` such pairs with larger ones."""

    def products(key: tuple, t: pa.Table) -> pa.Table:
        from statuta.llm import ngram_join as own

        c, lo, hi, node, part, size = (t.column(k).to_numpy() for k in ("c", "lo", "hi", "node", "part", "size"))
        right, fold = t.column("right").to_numpy(), t.column("fold")
        order = np.lexsort((node, size, hi, lo, c))
        new = (np.diff(c[order]) != 0) | (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)
        a, b, where = [], [], []
        for g in np.split(order, np.flatnonzero(new) + 1):
            if (part[g] == part[g[0]]).all():
                continue
            i, j, more = own.product(part[g], size[g], right[g] if lo[g[0]] != hi[g[0]] else None, fold.take(pa.array(g)).to_pylist(), num, den, partners)
            x, y = node[g[i]], node[g[j]]
            a += [np.minimum(x, y), c[g[:1]]] if more else [np.minimum(x, y)]
            b += [np.maximum(x, y), np.array([-1])] if more else [np.maximum(x, y)]
            where += [np.broadcast_to(c[g[0]], len(x)), c[g[:1]]] if more else [np.broadcast_to(c[g[0]], len(x))]
        a, b, where = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, where))
        return pa.table({"a": pa.array(a), "b": pa.array(b, mask=b < 0), "c": pa.array(where)})

    return products


def product(part: np.ndarray, size: np.ndarray, right: np.ndarray | None, folds: list[bytes], num: int, den: int, partners: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(i, j, whether some are held back): pairs of members, given in order of size, that may link. right: of two blocks the second."""
    bits = np.array([fold_bits(s) for s in size])
    end = np.searchsorted(size * num, size * den, "right")  # of the sizes that fit
    first = {k: int(np.searchsorted(bits, k)) for k in np.unique(bits).tolist()}
    rows = {k: rows_of(folds[at : int(np.searchsorted(bits, k, "right"))]) for k, at in first.items()}
    smaller: dict = {}
    out_i, out_j, more = [], [], False
    for i in range(len(size)):
        j = np.arange(i + 1, end[i])
        j = j[part[j] != part[i]]
        if right is not None:
            j = j[right[j] != right[i]]
        if not len(j):
            continue
        k = int(bits[i])
        over, planes = rows[k][0][i - first[k]], rows[k][1][i - first[k]]
        most = np.empty(len(j), np.int64)
        for m in np.unique(bits[j]).tolist():  # down to 1/2 the same number of buckets or twice as many, below more
            at = np.flatnonzero(bits[j] == m)
            if m > k and (m, k) not in smaller:
                finer = smaller.get((m, k + 1), rows[m])
                chunks = [_folded_to(finer[0][x : x + 256], finer[1][x : x + 256], k) for x in range(0, len(finer[0]), 256)]
                smaller[m, k] = tuple(np.concatenate(x) for x in zip(*chunks, strict=True))
            there = rows[m] if m == k else smaller[m, k]
            o = j[at] - first[m]
            for x in range(0, len(o), 4096):
                most[at[x : x + 4096]] = np.bitwise_count(there[1][o[x : x + 4096]] & planes).sum(1, dtype=np.int64)
            most[at] += np.minimum(there[0][o], over)
        fits = (num + den) * most >= num * (size[j] + size[i])
        j, most = j[fits], most[fits]
        if len(j) > partners:
            # the likeliest by the bound of the similarity; the others wait
            j, more = j[np.argsort(-(most / (size[j] + size[i])), kind="stable")[:partners]], True
        out_i.append(np.full(len(j), i))
        out_j.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j]), more


def _key(doc_id: Column) -> Column:
    """The id by which a class's document is read again; documents without one share a key."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")
