"""Training-order materialisation: token sequences at keyed random places in fixed-stride shards.

Every document's token ids and one end token are cut into sequences of
``seq_len``. Sequences are numbered in input order, and a keyed Feistel
network over the next power of four, walked until it falls below the number
of sequences, gives each a global slot: a permutation that any worker
computes without seeing another sequence. Slots are dealt in ranges of
``per_shard``; a range's task writes one file in which record r of shard s
stands at r * seq_len * 2 bytes, so a reader resumes at any slot by seeking.

Two passes read the texts: one counts sequences in every input partition, one
writes. The second checks that its partitions hold what the first counted.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, shared_folder, ship, stored
from .token_counts import tokenizer_path

SEQ_LEN = 512
#: Records of a shard: 32 MB of 512 tokens.
PER_SHARD = 1 << 15
KEY = 0x5EED
END = 50256
ROUNDS = 6
#: Tokens of an input partition that are sent together.
TOGETHER = 8_000_000
_worker: dict = {}


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. n-1, applied to the values x."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(x).astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> shift, out[todo] & mask
            for k in range(ROUNDS):
                h = (right + np.uint64((key + k * 0x9E3779B97F4A7C15) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
            out[todo] = (left << shift) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def encoding(path: str):
    """One tiktoken object per process and file."""
    if path not in _worker:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _worker[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _worker[path]


#: Runs of white space that the pattern's engine may not get through.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_TWO_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}")


def ids_of(path: str):
    """Text to its list of ids, the library's own for any text.

    By the pattern, a run of white space is one piece less its last character,
    which begins what follows; at the text's end the whole run is one. Long runs
    are taken out so and encoded without the pattern.
    """
    whole, piece = encoding(path).encode_ordinary, encoding(path)._encode_single_piece

    def ids(text: str) -> list[int]:
        # a long run covers two neighbours of every 5,000th character
        if len(text) < 10_000 or not _TWO_SPACES.search(text[::5_000]):
            return whole(text)
        out, at = [], 0
        for m in _LONG_SPACE.finditer(text):
            end = m.end() - (m.end() < len(text))
            out += whole(text[at : m.start()]) + piece(text[m.start() : end])
            at = end
        return out + whole(text[at:])

    return ids


def encoder(path: str):
    """Text to a uint16 array."""
    encode = ids_of(path)
    return lambda text: np.array(encode(text), np.uint16)


def materialise(docs: DataFrame, folder: str, path: str, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD, key: int = KEY, end: int = END) -> DataFrame:
    """Writes shards shard-NNNNNNNN.bin to folder; rows (slot, shard, byte_offset, doc_id, seq, n_tokens, crc).

    One row for each sequence: its global slot (0 .. number of sequences - 1),
    file and place, document, number within the document, tokens that aren't
    padding, and the CRC-32 of its record. Records are little-endian uint16,
    padded with the end token. A null or empty text gives one sequence, the
    end token. Repeated rows and null doc_ids are documents of their own; other
    columns are ignored. An empty table writes nothing. Texts of any length,
    and runs of white space in them, are encoded whole. Slots depend on the
    input files, their order and the key.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import training_order as own

        encode, n, check = own.ids_of(path), 0, 0
        for batch in pieces(batches):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = -(-(len(encode(t or "")) + 1) // seq_len)
                n, check = n + s, own.chained(check, k, s)
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([n], pa.int64()), "check": pa.array([check], pa.int64())})

    # one row for each input partition
    parts = sorted(rows.mapInArrow(counted, "part int, n long, check long").collect())
    firsts = np.cumsum([0] + [r["n"] for r in parts])
    total = int(firsts[-1])
    plan = spark.sparkContext.broadcast({r["part"]: (int(s), r["check"]) for r, s in zip(parts, firsts[:-1], strict=True)})

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        from statuta.llm import training_order as own

        encode, pack = own.encoder(path), zstandard.ZstdCompressor(level=1)
        number, expected = plan.value[TaskContext.get().partitionId()]
        check = 0

        def sent(ids: list, made: list, first: int) -> pa.RecordBatch:
            each = np.array([len(x) // seq_len for x in made])
            tokens = np.concatenate(made).reshape(-1, seq_len)
            meta = np.zeros(len(tokens), own.META)
            start = np.cumsum(each) - each
            meta["doc"] = np.repeat(np.array([i or 0 for i in ids], np.int64), each)
            meta["known"] = np.repeat(np.array([i is not None for i in ids]), each)
            meta["seq"] = np.arange(len(tokens)) - np.repeat(start, each)
            meta["n"] = seq_len
            meta["slot"] = own.feistel(first + np.arange(len(tokens)), total, key)
            last = start + each - 1
            meta["n"][last] = lengths[: len(ids)] - (each - 1) * seq_len
            order = np.argsort(meta["slot"])
            shard = meta["slot"][order] // per_shard
            cuts = np.split(order, np.flatnonzero(np.diff(shard)) + 1)
            return pa.RecordBatch.from_arrays([pa.array([int(meta["slot"][c[0]]) // per_shard for c in cuts], pa.int64()), pa.array([meta[c].tobytes() for c in cuts], pa.binary()), pa.array([pack.compress(tokens[c].tobytes()) for c in cuts], pa.binary())], ["shard", "meta", "tokens"])

        ids, made, lengths, held, first = [], [], [], 0, number
        for batch in pieces(batches):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = encode(t or "")
                s = -(-(len(x) + 1) // seq_len)
                padded = np.full(s * seq_len, end, np.uint16)
                padded[: len(x)] = x
                ids.append(k)
                made.append(padded)
                lengths.append(len(x) + 1)
                number, check, held = number + s, own.chained(check, k, s), held + len(padded)
                if held > TOGETHER:
                    lengths = np.array(lengths)
                    yield sent(ids, made, first)
                    ids, made, lengths, held, first = [], [], [], 0, number
        if ids:
            lengths = np.array(lengths)
            yield sent(ids, made, first)
        if check != expected:
            raise RuntimeError("an input partition changed between the two passes")

    def written(group: tuple, t: pa.Table) -> pa.Table:
        import zlib

        import zstandard
        from pyarrow import fs

        from statuta.llm import training_order as own

        unpack = zstandard.ZstdDecompressor()
        shard = group[0].as_py()
        meta = np.frombuffer(b"".join(t.column("meta").to_pylist()), own.META)
        size = min(per_shard, total - shard * per_shard)
        records = np.zeros((size, seq_len), np.uint16)
        at = 0
        for x in t.column("tokens"):
            got = np.frombuffer(unpack.decompress(x.as_py()), np.uint16).reshape(-1, seq_len)
            records[meta["slot"][at : at + len(got)] - shard * per_shard] = got
            at += len(got)
        if at != size:
            raise RuntimeError(f"shard {shard}: {at} of {size} records")
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{base}/shard-{shard:08d}.bin"
        half = f"{name}.{uuid.uuid4().hex}"  # renamed when whole, so a retried task is harmless
        with store.open_output_stream(half) as out:
            out.write(memoryview(records).cast("B"))
        store.move(half, name)
        meta = meta[np.argsort(meta["slot"])]
        crc = [zlib.crc32(r) for r in records]
        return pa.table({"slot": pa.array(meta["slot"].copy()), "shard": pa.array(np.full(len(meta), shard)), "byte_offset": pa.array((meta["slot"] - shard * per_shard) * seq_len * 2), "doc_id": pa.array(meta["doc"].copy(), mask=~meta["known"]), "seq": pa.array(meta["seq"].copy()), "n_tokens": pa.array(meta["n"].copy()), "crc": pa.array(crc, pa.int64())})

    sent = rows.mapInArrow(placed, "shard long, meta binary, tokens binary")
    index = sent.groupBy("shard").applyInArrow(written, "slot long, shard long, byte_offset long, doc_id long, seq int, n_tokens int, crc long")
    return stored(index, "training-order")


META = np.dtype([("slot", "<i8"), ("doc", "<i8"), ("known", "?"), ("seq", "<i4"), ("n", "<i4")])


def chained(check: int, doc_id: int | None, sequences: int) -> int:
    """A running checksum of rows in order."""
    return (check * 1_000_003 + (doc_id or 0) * 31 + sequences + 1) % (2**61 - 1)


def read(folder: str, first: int, count: int, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The records of slots first, first + 1, ...: sequential reads, resumable at any slot."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    while count > 0:
        shard, at = divmod(first, per_shard)
        with store.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
            f.seek(at * seq_len * 2)
            n = min(count, per_shard - at)
            got = np.frombuffer(f.read(n * seq_len * 2), np.uint16).reshape(-1, seq_len)
        yield from got
        first, count = first + n, count - n


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/statuta/shards-{uuid.uuid4().hex}"
    return materialise(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, tokenizer_path("byte_bpe_50k.tiktoken"))
