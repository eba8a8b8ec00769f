"""BPE encoding by a streaming transducer of bounded lookahead, and decoding by a state machine from bytes to text.

Text goes by in slices. What the merge rules can still change at the end of a
piece of text is bounded: ``Rules.lookahead`` computes from the merge list how
far to the left appended symbols reach. Two runs of the rules, on a piece and on
the same piece with more behind it, first differ where a rule (u, v) joins
across the piece's end, which reaches len(u) to the left. From there on only a
later rule (u', v') whose v' begins with u can carry the difference further left,
by len(u'). The longest such chain is the lookahead; tokens that end before it
are final. ``Transducer`` emits these and keeps the rest, so a word of any
length needs the memory of a block. It relies on every rule standing after those
that make its halves, which ``Rules`` checks (a list in another order has words
encoded whole). Words short enough for that come from a worker's cache, bounded
in bytes, which the transducer fills.

The tokenizer's normaliser is asked about text beyond ASCII, and so is its
pre-tokeniser about such characters' classes; merging is done here.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, ship
from .token_counts import tokenizer_path

#: Code points read together; symbols merged together; code points of a word that is encoded at once and kept.
SLICE, BLOCK, LONGEST = 1_000_000, 4096, 256
#: Bytes of a worker's cache, at most.
CACHE_BYTES = 256_000_000
#: What the tokenizer takes for white space.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: White space for str.split, yet not for the tokenizer.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: What the tokenizer cuts words into, and the contractions among it.
_ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_CONTRACTION = re.compile(r"'(?:s|t|re|ve|m|ll|d)")
_RUNS = {"L": re.compile("L*"), "O": re.compile("O*")}
END = "</w>"
#: The last symbol of a word is another symbol than the same byte within it.
_LAST = 0x1000
_worker: dict = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable Latin-1, else one from U+0100 on, in order."""
    out, more = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out


class Rules:
    """A tokenizer file's vocabulary and merge rules."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.file = json.load(f)
        model = self.file["model"]
        self.id_of = {self.inner(t): i for t, i in model["vocab"].items()}
        self.names = {i: t for t, i in model["vocab"].items()}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.rank = {(self.inner(a), self.inner(b)): k for k, (a, b) in reversed(list(enumerate(pairs)))}
        self.special = {x["content"]: x["id"] for x in self.file.get("added_tokens", ())}
        self.names |= {i: t for t, i in self.special.items()}
        self.lookahead = self.sufficient(self.rank)
        self.of_character = {c: b for b, c in enumerate(byte_characters())}
        # the rules by pair of ids, for many pieces at once; pairs of symbols have a table of their own
        width = max(self.names, default=0) + 1
        keys = np.array([self.id_of[u] * width + self.id_of[v] for u, v in self.rank], np.int64)
        order = np.argsort(keys)
        self.width, self.keys = width, keys[order]
        self.none = max(self.rank.values(), default=-1) + 1
        self.ranks = np.fromiter(self.rank.values(), np.int32, len(keys))[order]
        self.makes = np.zeros(self.none, np.int32)
        for (u, v), k in self.rank.items():
            self.makes[k] = self.id_of[u + v]
        self.symbol_id = np.zeros(2 * _LAST, np.int32)
        for token, i in self.id_of.items():
            if len(token) == 1:
                self.symbol_id[ord(token)] = i
        symbols = sorted(ord(t) for t in self.id_of if len(t) == 1)
        self.place = np.zeros(2 * _LAST, np.int32)
        self.place[symbols] = np.arange(len(symbols))
        self.first_ranks = np.full((len(symbols), len(symbols)), self.none, np.int32)
        for (u, v), k in self.rank.items():
            if len(u) == len(v) == 1:
                self.first_ranks[self.place[ord(u)], self.place[ord(v)]] = k

    @staticmethod
    def inner(token: str) -> str:
        """One character a symbol, a word's last symbol with the mark."""
        return token[: -len(END) - 1] + chr(ord(token[-len(END) - 1]) + _LAST) if token.endswith(END) and len(token) > len(END) else token

    @staticmethod
    def sufficient(rank: dict[tuple[str, str], int]) -> int | None:
        """How far left of a piece's end more symbols can change its tokens; None where rules stand before those that make their halves."""
        made: dict[str, int] = {}
        for (u, v), k in sorted(rank.items(), key=lambda x: x[1]):
            if any(len(x) > 1 and made.get(x, k) >= k for x in (u, v)) or u + v in made:
                return None
            made[u + v] = k
        reach: dict[str, int] = {}  # the longest chain that ends with a rule of this left half
        for u, v in sorted(rank, key=rank.get):
            far = len(u) + max((reach.get(v[:n], 0) for n in range(1, len(v) + 1)), default=0)
            reach[u] = max(reach.get(u, 0), far)
        return max(reach.values(), default=0)

    def merged(self, symbols: str) -> list[str]:
        """The tokens of a whole piece: the first rule that applies, leftmost first, until none does."""
        rank, parts = self.rank, list(symbols)
        if len(parts) > 64:
            return self._merged_long(parts)
        while len(parts) > 1:
            best = min(((rank.get(p, len(rank)), k) for k, p in enumerate(zip(parts, parts[1:], strict=False))), default=(len(rank), 0))
            if best[0] == len(rank):
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _merged_long(self, parts: list[str]) -> list[str]:
        """The same with a heap of pairs over a linked list."""
        rank, n = self.rank, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, parts[k], parts[k + 1]) for k in range(n - 1) if (r := rank.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if parts[k] != a or j >= n or parts[j] != b:
                continue  # one of them has been merged meanwhile
            parts[k], parts[j] = a + b, ""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank.get((a + b, parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, a + b, parts[after[k]]))
            if before[k] >= 0 and (r := rank.get((parts[before[k]], a + b))) is not None:
                heapq.heappush(heap, (r, before[k], parts[before[k]], a + b))
        return [p for p in parts if p]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the rule that joins these ids, ``none`` where there is none (or no id: -1)."""
        if not len(self.keys):
            return np.full(left.shape, self.none, np.int32)
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], self.none)

    def together(self, many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of many pieces: one merge of each at a time, those of a like length together."""
        sizes = np.fromiter(map(len, many), np.int64, len(many))
        symbols = np.frombuffer("".join(many).encode("utf-16-le"), np.uint16).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        symbols[starts + sizes - 1] += _LAST
        counts, done, low = np.zeros(len(many), np.int64), [], 0
        for high in (4, 6, 8, 10, 12, 16, 24, 32, 64):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(rows):
                column = np.arange(high)
                inside = column < sizes[rows][:, None]
                flat = symbols[np.where(inside, starts[rows][:, None] + column, 0)]
                grid = self._merge_rows(np.where(inside, self.symbol_id[flat], -1).astype(np.int32), np.where(inside[:, 1:], self.first_ranks[self.place[flat[:, :-1]], self.place[flat[:, 1:]]], self.none))
                counts[rows] = (grid >= 0).sum(1)
                done.append((rows, grid))
        long_ = {k: self.word(many[k]) for k in np.flatnonzero(sizes > low).tolist()}
        for k, ids in long_.items():
            counts[k] = len(ids)
        out, ends = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts)
        for rows, grid in done:
            kept = grid >= 0
            out[((ends - counts)[rows][:, None] + np.arange(grid.shape[1]))[kept]] = grid[kept]
        for k, ids in long_.items():
            out[ends[k] - len(ids) : ends[k]] = ids
        return out, counts

    def _merge_rows(self, grid: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Rows of ids (-1: none) with all rules applied; ranks: those of neighbours."""
        out, high = grid, grid.shape[1]
        where = np.arange(len(grid))
        column = np.arange(high)
        while len(where):
            at = ranks.argmin(1)
            row = np.arange(len(where))
            best = ranks[row, at]
            go = best < self.none
            if not go.all():
                out[where[~go]] = grid[~go]
                where, grid, ranks, at, best = where[go], grid[go], ranks[go], at[go], best[go]
                row = np.arange(len(where))
                if not len(where):
                    break
            # what stands right of the merged pair moves one place to the left
            shift = column[None, :-1] > at[:, None]
            grid = np.concatenate([np.where(shift, grid[:, 1:], grid[:, :-1]), np.full((len(grid), 1), -1, np.int32)], 1)
            shift = column[None, :-2] >= at[:, None]
            ranks = np.concatenate([np.where(shift, ranks[:, 1:], ranks[:, :-1]), np.full((len(grid), 1), self.none, np.int32)], 1)
            made = self.makes[best]
            grid[row, at] = made
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self._rank_of(grid[some, at[some] - 1], made[some])
            ranks[row, at] = np.where(at < high - 1, self._rank_of(made, grid[row, np.minimum(at + 1, high - 1)]), self.none)
        return out

    @staticmethod
    def marked(symbols: str) -> str:
        return symbols[:-1] + chr(ord(symbols[-1]) + _LAST)

    def ids(self, tokens: Iterable[str]) -> list[int]:
        return [self.id_of[t] for t in tokens]

    def word(self, symbols: str) -> list[int]:
        """The ids of a whole piece."""
        return self.ids(self.merged(self.marked(symbols)))


class Transducer:
    """Symbols of one piece in, ids out as soon as nothing behind them can change them."""

    def __init__(self, rules: Rules, block: int = BLOCK):
        self.rules, self.block, self.held = rules, block, ""

    def push(self, symbols: str) -> Iterator[list[int]]:
        for k in range(0, len(symbols), self.block):
            self.held += symbols[k : k + self.block]
            # the last symbol may be the piece's last, which is another symbol
            known = len(self.held) - 1
            if self.rules.lookahead is None or known < self.block + self.rules.lookahead:
                continue
            at, final = 0, []
            for token in self.rules.merged(self.held[:known]):
                if at + len(token) > known - self.rules.lookahead:
                    break
                final.append(token)
                at += len(token)
            self.held = self.held[at:]
            yield self.rules.ids(final)

    def finish(self) -> list[int]:
        held, self.held = self.held, ""
        return self.rules.word(held) if held else []


class Decoder:
    """Ids in, text out at once: what is not yet a whole character waits.

    named: as a file without a decoder has it, tokens' names with a space
    between them, a character for each byte. Otherwise the text itself: bytes
    are put together to characters, and a word's end is a space.
    """

    def __init__(self, rules: Rules, named: bool = False):
        self.rules, self.named, self.begun = rules, named, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        out = []
        for i in ids:
            name = self.rules.names[i]
            if self.named:
                out.append(f" {name}" if self.begun else name)
            elif name in self.rules.special:
                out.append(self.utf8.decode(b"", True) + name)
                self.utf8.reset()
            else:
                last = name.endswith(END)
                out.append(self.utf8.decode(bytes(self.rules.of_character[c] for c in (name[: -len(END)] if last else name))) + " " * last)
            self.begun = True
        return "".join(out)

    def finish(self) -> str:
        """What still waited."""
        return "" if self.named else self.utf8.decode(b"", True)


class Kinds(dict):
    """Classes of characters, by code point: L letter, N number, O other, S white space; the tokenizer is asked once for each."""

    def __init__(self, cut):
        super().__init__()
        self.cut = cut

    def __missing__(self, code: int) -> str:
        c = chr(code)
        ends = lambda before: [b for _, (_, b) in self.cut(before + c)]
        if c.isascii():
            kind = "L" if c.isalpha() else "N" if c.isdigit() else "S" if c in "\t\n\x0b\x0c\r " else "O"
        else:
            kind = "L" if ends("a") == [2] else "O" if ends("!") == [2] else "N" if ends("a") == [1, 2] else "S"
        self[code] = kind
        return kind


class Encoder:
    """Whole texts to ids, as the tokenizer's own library gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.rules = Rules(path)
        library = Tokenizer.from_file(path)
        self.normalised, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.kinds = Kinds(self.cut)
        self.symbols_of = byte_characters()
        self.special = re.compile("|".join(map(re.escape, sorted(self.rules.special, key=len, reverse=True)))) if self.rules.special else None
        self.words = Words(self)

    def symbols(self, text: str) -> str:
        return "".join(map(self.symbols_of.__getitem__, text.encode()))

    def cut_words(self, beyond: list[str], plain: list[str]) -> tuple[list[str], np.ndarray]:
        """(pieces in symbols, how many of each) of words without white space: those beyond ASCII, then those in ASCII."""
        out, counts = [], []
        if beyond:
            text = self.normalised(" ".join(beyond))
            found = self.cut(text)
            gaps = np.array([m.start() for m in re.finditer(" ", text)], np.int64)
            counts = np.bincount(np.searchsorted(gaps, [at for _, (at, _) in found]), minlength=len(beyond)).tolist()
            out = [symbols for symbols, _ in found]
        for w in plain:
            if w.isalpha():
                out.append(w.lower())
                counts.append(1)
            else:
                found = [m if m.isalnum() else self.symbols(m) for m in _ASCII_PIECE.findall(w.lower())]
                out += found
                counts.append(len(found))
        return out, np.array(counts, np.int64)

    def _slices(self, text: str, at: int, end: int) -> Iterator[str]:
        """A long word normalised, in slices between which nothing is composed."""
        while at < end:
            stop = at + SLICE
            while stop < end and not text[stop].isascii() and (unicodedata.combining(text[stop]) or text[stop] in followers()):
                stop += 1
            some = text[at : min(stop, end)]
            yield some.lower() if some.isascii() else self.normalised(some)
            at = stop

    def long_word(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        """The ids of text[at:end], which has no white space, by and by."""
        run, kind, rest = Transducer(self.rules), "", ""
        for some, last in chain(((s, False) for s in self._slices(text, at, end)), [("", True)]):
            some, rest = rest + some, ""
            classes, k = some.translate(self.kinds), 0
            while k < len(some):
                if kind:
                    stop = _RUNS[kind].match(classes, k).end()
                    yield from run.push(self.symbols(some[k:stop]))
                    k = stop
                    if k < len(some):
                        yield run.finish()
                        kind = ""
                    continue
                if some[k] == "'" and len(some) - k < 3 and not last:
                    rest = some[k:]  # a contraction may follow
                    break
                found = _CONTRACTION.match(some, k)
                if found or classes[k] == "N":
                    stop = found.end() if found else k + 1
                    yield self.rules.word(self.symbols(some[k:stop]))
                    k = stop
                elif classes[k] == "S":
                    k += 1
                else:
                    kind = classes[k]
        yield run.finish()

    def parts(self, text: str) -> Iterator[list[str] | int | tuple[int, int]]:
        """The text's words, slice by slice; a special token's id; the place of a long word."""
        at = 0
        for m in self.special.finditer(text) if any(x in text for x in self.rules.special) else ():
            yield from self._words(text, at, m.start())
            yield self.rules.special[m[0]]
            at = m.end()
        yield from self._words(text, at, len(text))

    def _words(self, text: str, at: int, end: int) -> Iterator[list[str] | tuple[int, int]]:
        while at < end:
            stop = min(at + SLICE, end)
            if stop < end:
                gap = _SPACE.search(text, stop, min(end, stop + SLICE))
                stop = gap.start() if gap else end
            if stop - at > 2 * SLICE:  # no white space for long: the words before, then one word
                gaps = [m.end() for m in _SPACE.finditer(text, at, at + SLICE)]
                if gaps and gaps[-1] > at:
                    stop = gaps[-1]
                else:
                    gap = _SPACE.search(text, at, end)
                    stop = gap.start() if gap else end
                    yield at, stop
                    at = stop
                    continue
            some = text[at:stop]
            words = _SPACE.split(some) if _ODD_SPACE.search(some) else some.split()
            yield [w for w in words if w] if words and not (words[0] and words[-1]) else words
            at = stop

    def ids(self, text: str | None) -> Iterator[list[int]]:
        """The whole text's ids, some at a time."""
        for written, _ in self.written(text):
            yield list(map(int, written.split()))

    def written(self, text: str | None, parts: list | None = None) -> Iterator[tuple[str, str]]:
        """The ids in decimal and the decoded names, some at a time, a space before each. parts: those of the text, where their words are known already."""
        for part in self.parts(text or "") if parts is None else parts:
            if isinstance(part, list):
                if parts is None:
                    self.words.learn(part)
                yield self.words.form(np.frombuffer(b"".join(map(self.words.ids.__getitem__, part)), np.uint32).tolist())
            else:
                for ids in [[part]] if isinstance(part, int) else self.long_word(text, *part):
                    yield self.words.form(ids)

    def all_written(self, texts: list[str]) -> Iterator[Iterator[tuple[str, str]]]:
        """``written`` of each text; words of texts that stand together in a slice are learnt together."""
        k = 0
        while k < len(texts):
            size, end = 0, k
            while end < len(texts) and (end == k or size + len(texts[end]) <= SLICE):
                size += len(texts[end])
                end += 1
            if size > SLICE:
                yield self.written(texts[k])
            else:
                parts = [list(self.parts(t)) for t in texts[k:end]]
                self.words.learn(w for each in parts for part in each if isinstance(part, list) for w in part)
                for text, each in zip(texts[k:end], parts, strict=True):
                    yield self.written(text, each)
            k = end


_followers: frozenset = frozenset()


def followers() -> frozenset:
    """Characters that may be composed with one before them although they aren't combining marks."""
    global _followers
    if not _followers:
        found = set(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
        for code in range(0x80, 0x110000):
            parts = unicodedata.decomposition(chr(code)).split()
            if len(parts) == 2 and not parts[0].startswith("<"):
                found.add(chr(int(parts[1], 16)))
        _followers = frozenset(found)
    return _followers


class Words:
    """Words' ids, as bytes. Emptied when it holds CACHE_BYTES."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.size = encoder, 0
        self.ids: dict[str, bytes] = {}
        decoder = Decoder(encoder.rules, True)
        decoder.begun = True  # within a text
        self.decimal = [f" {i}" for i in range(encoder.rules.width)]
        self.names = [decoder.push([i]) if i in encoder.rules.names else "" for i in range(encoder.rules.width)]

    def form(self, ids: list[int]) -> tuple[str, str]:
        """Ids in decimal, and their decoded names, a space before each."""
        return "".join(map(self.decimal.__getitem__, ids)), "".join(map(self.names.__getitem__, ids))

    def learn(self, words: Iterable[str]) -> None:
        """Sees to it that all of these are known."""
        words = set(words)
        if self.size > CACHE_BYTES:
            self.ids.clear()
            self.size = 0
        new = words.difference(self.ids)
        long_ = [w for w in new if len(w) > LONGEST]
        short = new.difference(long_) if long_ else new
        plain = list(filter(str.isascii, short))
        beyond = list(short.difference(plain)) if len(plain) < len(short) else []
        cut, counts = self.encoder.cut_words(beyond, plain)
        flat, each = self.encoder.rules.together(cut)
        ends = (np.concatenate([[0], np.cumsum(each)])[np.cumsum(counts)] * 4).tolist()
        ids = flat.astype(np.uint32).tobytes()
        self.ids.update(zip(chain(beyond, plain), (ids[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        for w in long_:
            self.ids[w] = b"".join(np.array(some, np.uint32).tobytes() for some in self.encoder.long_word(w, 0, len(w)))
        # objects and entries besides
        self.size += sum(map(len, new)) * 3 + 4 * len(flat) + 250 * len(new)


def encoder(path: str) -> Encoder:
    """One object a worker and file."""
    if path not in _worker:
        _worker[path] = Encoder(path)
    return _worker[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids array<int>), one for each row of docs (doc_id, text, ...). Null texts are empty; empty ones have no ids; other columns are ignored."""
    ship(docs.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import bpe_stream as own

        for batch in pieces(batches, 100):
            ids = [[i for some in own.encoder(path).ids(t) for i in some] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, named: bool = False) -> DataFrame:
    """Rows (doc_id, text) of rows (doc_id, ids): the text that the ids' bytes spell, or, named, their names with spaces between. Null ids are none."""
    ship(rows.sparkSession)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import bpe_stream as own

        for batch in pieces(batches, 100):
            texts = []
            for ids in batch.column(1).to_pylist():
                d = own.Decoder(own.encoder(path).rules, named)
                texts.append(d.push(ids or ()) + d.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decoded, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one for each row of docs (doc_id, text, ...).

    Ids and decoded names go into the digests as they come, so memory doesn't
    grow with a text. Null texts are empty: no tokens, and the digests of
    nothing. Repeated rows and null doc_ids are kept, other columns are ignored,
    an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import bpe_stream as own

        for batch in pieces(batches, 100):
            out: tuple = [], [], []
            for written in own.encoder(path).all_written([t or "" for t in batch.column(1).to_pylist()]):
                n, first, sums = 0, 1, (hashlib.sha256(), hashlib.sha256())
                for ids, named in written:
                    if ids:
                        n += ids.count(" ")
                        sums[0].update(ids[first:].encode())
                        sums[1].update(named[first:].encode())
                        first = 0
                for column, value in zip(out, (n, sums[0].hexdigest(), sums[1].hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("word_bpe_49k.json"))
