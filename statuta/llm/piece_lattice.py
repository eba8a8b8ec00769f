"""Sampled SentencePiece segmentation: forward filtering, backward sampling over the piece lattice.

A text is a path through the lattice of vocabulary pieces. Pieces never cross
the start of a word (a run of spaces and what follows it), so the lattice
factors into words and both passes run over all words of a batch at once:

* forward: alpha[j] = sum over pieces ending at j of alpha[start] * p(piece),
  for the distinct words of a batch, position by position;
* backward: from each word's end, a piece ending at j is drawn with weight
  alpha[start] * p(piece), for all word occurrences in lockstep. The uniform
  numbers are a hash of (seed, row key, word's place, position), so a row's
  segmentation depends on nothing but its key, text and seed.

Texts without spaces are long words; these are cut further wherever no piece
of two or more characters lies across: every path meets there, so the parts
are lattices of their own and take the same way. What has no such place for
BLOCK code points is passed in blocks, so memory is bounded by a block.

Piece probabilities: the model's scores are ranks (0, -1, -2, ...), so a
piece of rank r weighs (r + 10) ** -temperature. Characters that are no piece
are spelled by the model's 256 byte pieces, each of weight ``byte_weight``; so
is a literal word-start sign, which keeps decoding lossless.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, StructField, StructType

from .common import pieces, ship
from .token_counts import tokenizer_path

SPACE = "▁"
#: Words longer than this (code points) are cut where no piece lies across.
LONG = 48
#: Code points of a lattice that is held whole.
BLOCK = 1 << 16
#: Code points of texts taken together, and of distinct words in lockstep (some 450 bytes each).
BATCH_CHARS, TOGETHER = 1_000_000, 130_000
TEMPERATURE = 1.0
BYTE_WEIGHT = 1e-7
SEED = 11
_CHUNK = re.compile(" *[^ ]+| +")
_B = np.uint64(0x9E3779B97F4A7C15)
_worker: dict = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Index(dict):
    """Numbers words by first use."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Lattice:
    """The vocabulary of a model as a hash table of pieces (code points with spaces for word-start signs)."""

    def __init__(self, path: str, temperature: float = TEMPERATURE, byte_weight: float = BYTE_WEIGHT):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.surface: list[bytes] = [b""] * n
        self.byte_id = [-1] * 256
        self.ids: dict[str, int] = {}
        self.weight = np.zeros(n + 1)
        for i in range(n):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            else:
                text = piece.replace(SPACE, " ")
                self.ids[text] = i
                self.surface[i] = text.encode()
                self.weight[i] = (max(0.0, -sp.get_score(i)) + 10) ** -temperature if sp.get_score(i) > -1e8 else 40_000.0**-temperature
        self.byte_weight = byte_weight
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.longest = max(map(len, self.ids))
        self._build()

    def _build(self) -> None:
        pieces = list(self.ids)
        cps = np.zeros((len(pieces), self.longest), np.uint64)
        for k, p in enumerate(pieces):
            cps[k, : len(p)] = [ord(c) for c in p]
        length = np.array([len(p) for p in pieces])
        h = np.zeros(len(pieces), np.uint64)
        for j in range(self.longest):
            h = np.where(j < length, h * _B + cps[:, j] + np.uint64(1), h)
        key = _mix(h)
        self.bits = int(np.ceil(np.log2(len(pieces)))) + 5
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        for k, i in zip(key.tolist(), self.ids.values(), strict=True):
            at = k >> (64 - self.bits)
            while self.values[at] >= 0:
                assert self.keys[at] != k, "two pieces share a hash"
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = k, i
        self.single = np.zeros(0x110000, bool)
        for p in pieces:
            if len(p) == 1:
                self.single[ord(p)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of polynomial hashes, -1 where there is none."""
        shape, key = h.shape, _mix(h.reshape(-1))
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), -1, np.int32)
        held = self.keys[at]
        todo = np.flatnonzero(held)  # an empty slot holds 0: no piece
        key, at, held = key[todo], at[todo], held[todo]
        while len(todo):
            hit = held == key
            out[todo[hit]] = self.values[at[hit]]
            todo, key, at = todo[~hit], key[~hit], (at[~hit] + 1) % len(self.keys)
            held = self.keys[at]
            on = held != 0
            todo, key, at, held = todo[on], key[on], at[on], held[on]
        return out.reshape(shape)

    # -- one batch ------------------------------------------------------------

    def encode(self, texts: list[str], keys: np.ndarray, seed: int = SEED) -> list[np.ndarray]:
        """Sampled piece ids of every text; keys are the rows' 64-bit keys."""
        chunks = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        counts = np.array([len(c) for c in chunks], np.int64)
        index = _Index()
        word = np.fromiter(map(index.__getitem__, chain.from_iterable(chunks)), np.int64, int(counts.sum()))
        if not len(word):
            return [np.zeros(0, self.kind) for _ in texts]
        row = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        with np.errstate(over="ignore"):
            base = _mix(np.asarray(keys).astype(np.int64).view(np.uint64)[row] * _B + _mix(np.full(1, seed, np.uint64)) + _mix(place.astype(np.uint64) + np.uint64(1)))
            word, whole, shift = self._parts(index, word)
            # a part's positions count from its word's start
            pieces, at = self._sample(list(index), word, base[whole] + shift.astype(np.uint64) * _B)
        # at: each piece's occurrence; pieces come per occurrence in text order
        per_row = np.bincount(row[whole[at]], minlength=len(texts)) if len(at) else np.zeros(len(texts), np.int64)
        return np.split(pieces.astype(self.kind), np.cumsum(per_row)[:-1])

    def _parts(self, index: _Index, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences with long words cut: (part's number in index, occurrence, offset in its word)."""
        words = list(index)
        long_ = [k for k, w in enumerate(words) if len(w) > LONG]
        parts = [np.array([k]) for k in range(len(words))] if long_ else []
        offsets = [np.zeros(1, np.int64)] * len(parts)
        if not parts:
            return word, np.arange(len(word)), np.zeros(len(word), np.int64)
        for k, cut in zip(long_, self._cuts([words[k] for k in long_]), strict=True):
            w = words[k]
            parts[k] = np.array([index[w[a:b]] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)])
            offsets[k] = cut[:-1]
        each = np.array([len(p) for p in parts])
        n = each[word]
        whole = np.repeat(np.arange(len(word)), n)
        at = np.repeat((np.cumsum(each) - each)[word], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.concatenate(parts)[at], whole, np.concatenate(offsets)[at]

    def _cuts(self, words: list[str]) -> list[np.ndarray]:
        """For each word its ends and the places inside it that no piece lies across."""
        ends = np.cumsum([len(w) + 1 for w in words])
        c = np.zeros(ends[-1], np.uint64)
        inside = np.ones(len(c), bool)
        inside[ends - 1] = False  # after each word something that is no character
        c[inside] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        c[~inside] = 0x110000
        across = np.zeros(len(c) + 1, np.int64)
        h = c + np.uint64(1)
        for n in range(2, min(self.longest, len(c)) + 1):  # h: of the n characters from each place
            h = h[:-1] * _B + c[n - 1 :] + np.uint64(1)
            start = np.flatnonzero(self.find(h) >= 0)
            across[start + 1] += 1
            across[start + n] -= 1
        free = np.flatnonzero(np.cumsum(across)[:-1] == 0)
        first = np.r_[0, ends[:-1]]
        bounds = np.searchsorted(free, np.r_[0, ends])
        # a word's places run from its start to the one after its last character
        return [free[a:b] - s for a, b, s in zip(bounds[:-1], bounds[1:], first, strict=True)]

    def _sample(self, words: list[str], word: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # words that are only there in parts don't count
        used = np.zeros(len(words), bool)
        used[word] = True
        length = np.array([len(w) if u else 0 for w, u in zip(words, used, strict=True)])
        cps = np.frombuffer("".join(w for w, u in zip(words, used, strict=True) if u).encode("utf-32-le", "surrogatepass"), np.uint32)
        offset = np.cumsum(length) - length
        got_piece, got_word, got_step = [], [], []
        widths = [0, 3, 5, 7, 9, 12, 16, 28, 48]
        while widths[-1] < min(BLOCK, length.max()):
            widths.append(min(BLOCK, 2 * widths[-1]))
        local = np.full(len(words), -1)
        for lo, hi in zip(widths, widths[1:]):
            group = np.flatnonzero((length > lo) & (length <= hi))
            size = max(1, min(16_000, TOGETHER // hi))
            for k in range(0, len(group), size):
                part = group[k : k + size]
                local[part] = np.arange(len(part))
                occ = np.flatnonzero(local[word] >= 0)
                for p, o, s in self._lockstep(cps, offset[part], length[part], hi, local[word[occ]], base[occ]):
                    got_piece.append(p)
                    got_word.append(occ[o])
                    got_step.append(s)
                local[part] = -1
        for w in np.flatnonzero(length > BLOCK):
            c = cps[offset[w] : offset[w] + length[w]]
            for o in np.flatnonzero(word == w):
                p = self._in_blocks(c, base[o])
                got_piece.append(p)
                got_word.append(np.full(len(p), o))
                got_step.append(np.arange(len(p)))
        piece, occ, step = np.concatenate(got_piece), np.concatenate(got_word), np.concatenate(got_step)
        # steps count from a word's end
        n = np.bincount(occ, minlength=len(word))
        end = np.cumsum(n)
        out = np.empty(len(piece), np.int64)
        out[end[occ] - 1 - step] = piece
        return out, np.repeat(np.arange(len(word)), n)

    def _edges(self, cps: np.ndarray, offset: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids[j, l-1, w]: piece of length l that ends at j in word w; byte[j, w]: the character before j + 1 is no piece."""
        m = len(offset)
        at = np.minimum(offset + np.arange(width)[:, None], len(cps) - 1)
        c = np.where(np.arange(width)[:, None] < length, cps[at], 0).astype(np.uint64)
        most = min(self.longest, width)
        h = np.zeros((width + 1, m), np.uint64)
        for j in range(width):
            h[j + 1] = h[j] * _B + c[j] + np.uint64(1)
        ids = np.full((width + 1, most, m), -1, np.int32)
        power = np.uint64(1)
        for n in range(1, most + 1):
            power = np.uint64(int(power) * int(_B) % 2**64)
            ids[n:, n - 1] = self.find(h[n:] - h[:-n] * power)
        by_byte = ~self.single[np.minimum(c, 0x10FFFF).astype(np.int64)]
        return ids, by_byte, c

    def _lockstep(self, cps, offset, length, width, word, base) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ids, by_byte, c = self._edges(cps, offset, length, width)
        most, m = ids.shape[1:]
        spelled = np.where(c < 0x80, 1, np.where(c < 0x800, 2, np.where(c < 0x10000, 3, 4)))
        weight = self.weight[ids]  # of id -1: the last entry, which is 0
        # a character that is no piece: one edge of length 1, all its bytes
        weight[1:, 0] = np.where(by_byte, self.byte_weight**spelled, weight[1:, 0])
        alpha = np.zeros((width + 1, m))
        alpha[0] = 1
        for j in range(1, width + 1):
            n = min(most, j)
            weight[j, :n] *= alpha[j - n : j][::-1]
            total = weight[j, :n].sum(0)
            alpha[j] = total
            low = (total > 0) & (total < 1e-100)  # rescaled, so that long words don't vanish
            if low.any():
                alpha[max(0, j - most) : j + 1, low] /= total[low]
        weight = weight.transpose(2, 0, 1)
        ids = np.ascontiguousarray(ids.transpose(2, 0, 1))
        c, by_byte = c.T, by_byte.T
        cdf = np.cumsum(weight, 2)
        ids = ids.reshape(-1, most)
        cdf = cdf.reshape(-1, most)
        spelled_by = np.array(self.byte_id)
        pos = length[word].copy()
        live = np.arange(len(word))
        step = np.zeros(len(word), np.int64)
        while len(live):
            w, j = word[live], pos[live]
            node = w * (width + 1) + j
            u = (_mix(base[live] + j.astype(np.uint64) * _B) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            row = cdf[node]
            n = (row <= (u * row[:, -1])[:, None]).sum(1)  # edges passed
            n = np.minimum(n, most - 1)
            piece = ids[node, n]
            raw = (n == 0) & by_byte[w, j - 1]
            plain = ~raw
            yield piece[plain].astype(np.int64), live[plain], step[live[plain]]
            step[live[plain]] += 1
            if raw.any():
                ch = c[w[raw], j[raw] - 1].astype(np.int64)
                ascii_, o = ch < 0x80, live[raw]
                yield spelled_by[ch[ascii_]], o[ascii_], step[o[ascii_]]
                step[o[ascii_]] += 1
                for n_bytes, low, high, lead in ((2, 0x80, 0x800, 0xC0), (3, 0x800, 0x10000, 0xE0), (4, 0x10000, 0x110000, 0xF0)):
                    at = (ch >= low) & (ch < high)
                    o, x = live[raw][at], ch[at]
                    for k in range(n_bytes if len(o) else 0):  # from the last byte
                        yield spelled_by[0x80 | x & 0x3F if k < n_bytes - 1 else lead | x], o, step[o]
                        step[o] += 1
                        x = x >> 6
            pos[live] = j - n - 1
            live = live[pos[live] > 0]

    # -- lattices beyond a block -----------------------------------------------

    def _rows(self, c: np.ndarray, start: int, end: int, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, weights of the edges into each place, whether its character is spelled, alpha at the end) for places start + 1 .. end.

        alpha: of the ``longest`` places up to start.
        """
        most = self.longest
        low = max(0, start - most)
        ids, by_byte, x = self._edges(c[low:end], np.zeros(1, np.int64), np.array([end - low]), end - low)
        ids, by_byte, x = (np.ascontiguousarray(y[..., 0]) for y in (ids[start - low + 1 :], by_byte[start - low :], x[start - low :]))
        weight = np.zeros((end - start, most))
        weight[:, : ids.shape[1]] = self.weight[ids]
        spelled = np.where(x < 0x80, 1, np.where(x < 0x800, 2, np.where(x < 0x10000, 3, 4)))
        weight[:, 0] = np.where(by_byte, self.byte_weight**spelled, weight[:, 0])
        alpha = alpha.copy()
        for j in range(end - start):
            weight[j] *= alpha[::-1]
            total = weight[j].sum()
            alpha[:-1] = alpha[1:]
            alpha[-1] = total
            if 0 < total < 1e-100:
                alpha /= total
        return ids, weight, by_byte, alpha

    def _in_blocks(self, c: np.ndarray, base: np.uint64) -> np.ndarray:
        """Sampled pieces of one word, from its end: blocks forwards, keeping what each begins with, then blocks backwards."""
        starts, begin = range(0, len(c), BLOCK), []
        alpha = np.zeros(self.longest)
        alpha[-1] = 1
        for s in starts:
            begin.append(alpha)
            alpha = self._rows(c, s, min(len(c), s + BLOCK), alpha)[3]
        place = np.arange(len(c) + 1, dtype=np.uint64)
        u = (_mix(base + place * _B) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        j, out = len(c), []
        for s, alpha in zip(reversed(starts), reversed(begin), strict=True):
            ids, weight, by_byte, _ = self._rows(c, s, min(len(c), s + BLOCK), alpha)
            cdf = np.cumsum(weight, 1)
            while j > s:
                row = cdf[j - s - 1]
                n = min(int((row <= u[j] * row[-1]).sum()), self.longest - 1)
                if n == 0 and by_byte[j - s - 1]:
                    out += [self.byte_id[b] for b in chr(c[j - 1]).encode("utf-8", "surrogatepass")][::-1]
                else:
                    out.append(int(ids[j - s - 1, n]))
                j -= n + 1
        return np.array(out, np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's UTF-8 bytes: surfaces joined, less the space put before the first word."""
        return b"".join(map(self.surface.__getitem__, ids.tolist()))[1:]


def lattice(path: str) -> Lattice:
    """One per worker process and model file."""
    if path not in _worker:
        _worker[path] = Lattice(path)
    return _worker[path]


def encode(docs: DataFrame, path: str, seed: int = SEED) -> DataFrame:
    """docs (doc_id, text, ...) with all its columns, and _ids (binary, little-endian uint16, uint32 for more than 65,536 pieces), _n_pieces, _lossless.

    _lossless: decoding _ids gives the text's UTF-8 bytes. Null and empty texts
    have no pieces. A null doc_id counts as key 0; rows of equal key and text
    get equal segmentations. Whole texts are encoded, whatever their length.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("_ids", "_n_pieces", "_lossless")
    ship(spark)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import piece_lattice as own

        model = own.lattice(path)
        for batch in pieces(batches, 500):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            keys = np.array([k or 0 for k in batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()).to_pylist()], np.int64)
            ids, k = [], 0
            while k < len(texts):
                end, held = k, 0
                while end < len(texts) and (end == k or held + len(texts[end]) <= own.BATCH_CHARS):
                    held, end = held + len(texts[end]), end + 1
                ids += model.encode(texts[k:end], keys[k:end], seed)
                k = end
            ok = [model.decode(i) == t.encode("utf-8") for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([i.tobytes() for i in ids], pa.binary()), pa.array([len(i) for i in ids], pa.int32()), pa.array(ok, pa.bool_())], names=[*batch.schema.names, "_ids", "_n_pieces", "_lossless"])

    return docs.mapInArrow(encoded, StructType([*docs.schema.fields, StructField("_ids", BinaryType()), StructField("_n_pieces", IntegerType()), StructField("_lossless", BooleanType())]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (with _ids) with all its columns, and _text."""
    encoded = encoded.drop("_text")
    ship(encoded.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import piece_lattice as own

        model = own.lattice(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("_ids")).to_pylist()
            texts = [model.decode(np.frombuffer(i or b"", model.kind)).decode("utf-8") for i in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "_text"])

    from pyspark.sql.types import StringType

    return encoded.mapInArrow(decoded, StructType([*encoded.schema.fields, StructField("_text", StringType())]))


def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, tokenizer_path("piece_bpe_32k.model")).select("doc_id", F.col("_n_pieces").cast("long").alias("n_pieces"), F.col("_ids").alias("ids"), F.col("_lossless").alias("lossless"))
