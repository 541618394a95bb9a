"""BPE encoding and decoding by forced-boundary splitting.

The tokenizer file is a byte-level BPE with word ends (``</w>``).  A merge can
only make a token of the vocabulary, so two neighbouring bytes that never occur
side by side inside any token can never be merged over: the place between them
is a certain cut.  A text is cut at white space, by the file's word pattern, and
then at every such pair; all fragments of a stretch of text are merged side by
side in numpy, and their ids are concatenated.  The result equals merging whole
words.  Chunks between white space recur, so their ids are kept in a bounded
table.

``encode`` and ``decode`` are column operators: a narrow Arrow function without a
shuffle, whatever the size.  A task holds one Arrow batch and the table.

Edge cases: a null text encodes like an empty one (no ids); null ids decode to
an empty text; an id that is not in the file decodes to nothing, as the library
does; special tokens written in a text are recognised, as the library does.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens.llm.hashing import Hashes

TOKENIZER = "word_bpe_49k.json"
#: Chunks in the table before it starts anew: memory (about 45 bytes each), not results.
CACHE_ENTRIES = 1_000_000
#: Code points of text worked on at once.
STRETCH = 250_000
#: Symbols of a matrix of fragments.
MATRIX = 150_000
#: Fragments up to these widths share a matrix; longer ones are merged one by one with a heap.
WIDTHS = (4, 8, 12, 16, 24, 40, 64)
#: Rank of a pair that no merge joins.
NEVER = 1 << 30

# Fixed values of the tokenizer file's word pattern: contractions, then runs of letters, single
# numbers, and runs of what is neither white space (\\s), nor letter (\\p{L}), nor number (\\p{N}).
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE_SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Kind of each code point in the word pattern: 0 white space, 1 letter, 2 number, 3 other."""
    kind = np.full(sys.maxunicode + 1, 3, np.uint8)
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    for value, pattern in enumerate((f"[{WHITE_SPACE}]+", r"\p{L}+", r"\p{N}+")):
        for run in regex.finditer(pattern, every):
            kind[np.frombuffer(run[0].encode("utf-32-le"), np.uint32)] = value
    return kind


def word_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word of the pattern in a text of code points."""
    kind = kinds()[points]
    opens = np.ones(len(points), bool)
    opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    quotes = np.flatnonzero((points == ord("'")) & opens)
    for mark in CONTRACTIONS:  # a quote that begins a run, and its letters, are a word
        at = quotes[quotes + len(mark) <= len(points)]
        for i, letter in enumerate(mark[1:], 1):
            at = at[points[at + i] == ord(letter)]
        opens[at + 1] = False
        after = at + len(mark)
        opens[after[after < len(points)]] = True
        quotes = np.setdiff1d(quotes, at, assume_unique=True)
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(points))
    word = kind[starts] > 0
    return starts[word], ends[word]


def chunk_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of UTF-8 bytes between white space."""
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    solid = ~blank[data]
    lead = np.flatnonzero((data == 0xC2) | (data >= 0xE1) & (data <= 0xE3))
    if len(lead):  # white space of two and three bytes
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        code = padded[lead].astype(np.int64) << 16 | padded[lead + 1].astype(np.int64) << 8
        two = lead[np.isin(code, WIDE[WIDE & 0xFF == 0])]
        three = lead[np.isin(code | padded[lead + 2], WIDE[WIDE & 0xFF != 0])]
        for at, size in ((two, 2), (three, 3)):
            for i in range(size):
                solid[at + i] = False
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: UTF-8 bytes of the white space beyond ASCII, as numbers (the third byte 0 if there are two).
WIDE = np.array(
    [
        int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big")
        for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
    ]
)


class Known:
    """A bounded table of chunks and their ids, asked for whole arrays of chunks at once.

    A chunk is told by its length, its first bytes and a 64-bit hash of all.
    """

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self, least: int = 0) -> None:
        """Forget all; make room for at least ``least`` chunks."""
        self.size = 0
        self.bits = max(4, (2 * max(self.most, least) - 1).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((2, 1024), np.uint64)
        self.start = np.zeros(1025, np.int64)
        self.flat = np.zeros(4096, np.uint32)

    def find(self, data: np.ndarray, a: np.ndarray, b: np.ndarray, only: np.ndarray | None = None, entry: np.ndarray | None = None) -> np.ndarray:
        """Entry of each chunk ``data[a:b]``, -1 if there is none; with ``only``, of those, into ``entry``."""
        if only is None:
            head = np.zeros(len(a), np.uint64)
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            for i in range(7):
                head |= np.where(a + i < b, padded[a + i], 0).astype(np.uint64) << np.uint64(8 * i)
            head |= np.minimum(b - a, 255).astype(np.uint64) << np.uint64(56)
            self.hash, self.head = Hashes(data).of(a, b), head
            only, entry = np.arange(len(a)), np.full(len(a), -1, np.int64)
        place = (self.hash[only] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(only):
            found = self.slot[place]
            used = found >= 0
            same = used & (self.keys[0, found] == self.hash[only]) & (self.keys[1, found] == self.head[only])
            entry[only[same]] = found[same]
            on = used & ~same
            only, place = only[on], place[on] + 1 & (1 << self.bits) - 1
        return entry

    def fresh(self, lacking: np.ndarray) -> np.ndarray:
        """One chunk for each different one of ``lacking`` (numbers of the last ``find``)."""
        order = np.lexsort((self.head[lacking], self.hash[lacking]))
        h, w = self.hash[lacking][order], self.head[lacking][order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        return np.sort(lacking[order[new]])

    def add(self, new: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Enter the chunks ``new`` (numbers of the last ``find``) with their ids."""
        first, last = self.size, self.size + len(new)
        if last > self.keys.shape[1]:
            room = max(last, 2 * self.keys.shape[1])
            self.keys = np.concatenate([self.keys, np.zeros((2, room - self.keys.shape[1]), np.uint64)], axis=1)
            self.start = np.concatenate([self.start, np.zeros(room + 1 - len(self.start), np.int64)])
        self.keys[0, first:last], self.keys[1, first:last] = self.hash[new], self.head[new]
        base = self.start[first]
        self.start[first + 1 : last + 1] = base + np.cumsum(count)
        if base + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(ids), np.uint32)])
        self.flat[base : base + len(ids)] = ids
        left = np.arange(first, last)
        place = (self.hash[new] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slot[place] < 0)
            self.slot[place[free]] = left[free]  # of several for one slot, one stays
            on = self.slot[place] != left
            left, place = left[on], place[on] + 1 & (1 << self.bits) - 1
        self.size = last

    def ids_of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries, one after the other, and how many each has."""
        count = self.start[entry + 1] - self.start[entry]
        at = np.arange(int(count.sum())) + np.repeat(self.start[entry] - (np.cumsum(count) - count), count)
        return self.flat[at], count


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (vocab | self.special).items()}
        self.size = max(self.names) + 1
        alphabet = byte_alphabet()
        #: Symbol -> id; symbol 256 + b is byte b at the end of a word.
        self.base = np.array([vocab[c] for c in alphabet] + [vocab[c + suffix] for c in alphabet], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        #: Sorted keys of the pairs that merge, their ranks, and the id that each rank makes.
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a.removesuffix(suffix) + b] if suffix else vocab[a + b] for a, b in pairs], np.int64)
        self.first = self._rank(np.repeat(self.base, 512), np.tile(self.base, 512)).reshape(512, 512)
        #: Byte pairs inside some token; between any other two bytes is a certain cut.
        byte = {c: b for b, c in enumerate(alphabet)}
        self.joined = np.zeros((256, 256), bool)
        for token in vocab:
            inside = [byte[c] for c in (token.removesuffix(suffix) if suffix else token)]
            self.joined[inside[:-1], inside[1:]] = True
        self.marker = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known = Known(entries)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids (-1: none), ``NEVER`` if no merge joins it."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NEVER).astype(np.int32)

    def _merge(self, symbols: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge fragments, one a row, the lowest rank and the leftmost first -> (ids, how many of a row)."""
        cols = np.arange(symbols.shape[1])
        inside = cols < width[:, None]
        ids = np.where(inside, self.base[symbols], -1)
        if ids.shape[1] == 1:
            return ids, width
        rank = np.where(inside[:, 1:], self.first[symbols[:, :-1], symbols[:, 1:]], NEVER)
        rows, done, length = np.arange(len(ids)), np.full_like(ids, -1), width.copy()
        while len(rows):
            at = rank.argmin(axis=1)
            low = rank[np.arange(len(rows)), at]
            done[rows[low == NEVER]] = ids[low == NEVER]
            go = low < NEVER
            rows, ids, rank, at, low = rows[go], ids[go], rank[go], at[go], low[go]
            if not len(rows):
                break
            length[rows] -= 1
            shift = np.minimum(cols + (cols > at[:, None]), len(cols) - 1)
            line = np.arange(len(rows))
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            ids[line, at] = self.made[low]
            rank = np.take_along_axis(rank, shift[:, :-1].clip(max=len(cols) - 2), 1)
            rank[:, -1] = NEVER
            left = at > 0
            rank[line[left], at[left] - 1] = self._rank(ids[line[left], at[left] - 1], ids[line[left], at[left]])
            right = at < len(cols) - 1
            rank[line[right], at[right]] = self._rank(ids[line[right], at[right]], ids[line[right], at[right] + 1])
        return done, length

    def _merge_long(self, symbols: np.ndarray) -> list[int]:
        """Merge one long fragment with a heap of (rank, place)."""
        ids = self.base[symbols].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        rank = lambda i: int(self._rank(np.array([ids[i]]), np.array([ids[after[i]]]))[0])
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(self.first[symbols[:-1], symbols[1:]].tolist()) if r < NEVER]
        heapify(heap)
        while heap:
            r, i, a, b = heappop(heap)
            if ids[i] != a or after[i] < 0 or ids[after[i]] != b:
                continue
            gone = after[i]
            ids[i], ids[gone], after[i] = int(self.made[r]), -1, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and after[j] >= 0 and (r := rank(j)) < NEVER:
                    heappush(heap, (r, j, ids[j], ids[after[j]]))
        return [x for x in ids if x >= 0]

    def _words(self, raw: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words (spans of bytes), one after the other, and how many each has: cut, merge, concatenate."""
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[opens] += 1
        inside[closes] -= 1
        text = raw[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        ends = np.cumsum(closes - opens)
        symbols = text.astype(np.int64)
        symbols[ends - 1] += 256
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = ~self.joined[text[:-1], text[1:]]
        cut[ends] = True
        starts = np.flatnonzero(cut)
        starts, size = starts[:-1], np.diff(starts)
        count = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # (fragments, their ids row by row)
        below = 0
        for width in WIDTHS:
            rows = np.flatnonzero((size > below) & (size <= width))
            below = width
            for some in np.array_split(rows, max(1, len(rows) * width // MATRIX)):
                if len(some):
                    at = np.minimum(starts[some][:, None] + np.arange(width), len(symbols) - 1)
                    ids, count[some] = self._merge(symbols[at], size[some])
                    parts.append((some, ids))
        for i in np.flatnonzero(size > below).tolist():
            ids = np.array(self._merge_long(symbols[starts[i] : starts[i] + size[i]]), np.int64)
            count[i] = len(ids)
            parts.append((np.array([i]), ids[None]))
        place = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(place[-1], np.int64)
        for some, ids in parts:
            full = np.arange(ids.shape[1]) < count[some][:, None]
            out[(place[some][:, None] + np.arange(ids.shape[1]))[full]] = ids[full]
        fragment_of = np.searchsorted(starts, ends)
        return out, np.diff(np.concatenate([[0], place[fragment_of]]))

    def _encode_plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks joined by line ends, without special tokens, and how many each chunk has."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(points == 10)
        opens, closes = word_bounds(points)
        if not len(opens):
            return np.zeros(0, np.int64), np.zeros(len(ends) + 1, np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte offset of each code point
        ids, count = self._words(raw, at[opens], at[closes])
        of = np.searchsorted(ends, opens)
        return ids, np.bincount(of, weights=count, minlength=len(ends) + 1).astype(np.int64)

    def _encode_chunks(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks joined by line ends, and how many each has; special tokens are found before anything else."""
        if not (self.marker and self.marker.search(text)):
            return self._encode_plain(text)
        ids, count = [], []
        for chunk in text.split("\n"):
            parts = [p for p in self.marker.split(chunk) if p]
            own = [np.array([self.special[p]]) if p in self.special else self._encode_plain(p)[0] for p in parts]
            ids += own
            count.append(sum(map(len, own)))
        return np.concatenate(ids), np.array(count)

    def pack(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit bytes; a null text has none."""
        packed: list[bytes] = []
        for some in stretches(texts):
            raw = "\n".join(t or "" for t in some).encode()
            data = np.frombuffer(raw, np.uint8)
            opens, closes = chunk_bounds(data)
            entry = self.known.find(data, opens, closes)
            lacking = np.flatnonzero(entry < 0)
            if len(lacking):
                if self.known.size + len(lacking) > self.known.most:
                    lacking = np.arange(len(opens))
                    self.known.clear(len(lacking))
                new = self.known.fresh(lacking)
                a, b = opens[new], closes[new]
                joined = np.full(int((b - a + 1).sum()), 10, np.uint8)
                at = np.cumsum(b - a + 1) - (b - a + 1)
                size = b - a
                inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                joined[np.repeat(at, size) + inside] = data[np.repeat(a, size) + inside]
                self.known.add(new, *self._encode_chunks(joined[:-1].tobytes().decode()))
                entry = self.known.find(data, opens, closes, lacking, entry)
            ids, count = self.known.ids_of(entry)
            ends = np.cumsum([len((t or "").encode()) + 1 for t in some]) if len(some) > 1 else np.array([len(raw) + 1])
            upto = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(opens, ends)] * 4
            out = ids.astype("<u4").tobytes()
            packed += [out[x:y] for x, y in zip([0, *upto[:-1].tolist()], upto.tolist())]
        return packed

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.pack([text])[0], "<u4").tolist()

    def decode(self, ids) -> str:
        """The tokens joined by one space: the file names no decoder."""
        if ids is None:
            return ""
        try:
            return " ".join(map(self.names.__getitem__, ids))
        except KeyError:
            return " ".join(self.names[i] for i in ids if i in self.names)


def stretches(texts: list[str | None], most: int = STRETCH):
    """Runs of whole texts of about ``most`` code points together (a longer text alone)."""
    some: list[str | None] = []
    total = 0
    for t in texts:
        if some and total + len(t or "") > most:
            yield some
            some, total = [], 0
        some.append(t)
        total += len(t or "")
    if some:
        yield some


@lru_cache(maxsize=2)
def load(path: str | None) -> WordBpe:
    """The encoder of a file, once per Python worker."""
    return WordBpe(path or default_tokenizer())


def encode(text: Column | str, tokenizer: str | None = None) -> Column:
    """``array<int>``: the ids of ``text`` by ``tokenizer`` (a path the executors can read; default: the public file)."""

    @F.arrow_udf("array<int>")
    def encode_batch(texts: pa.Array) -> pa.Array:
        packed = load(tokenizer).pack(texts.to_pylist())
        offsets = pa.array([0, *_running(len(p) // 4 for p in packed)], pa.int32())
        values = pa.Array.from_buffers(pa.int32(), offsets[-1].as_py(), [None, pa.py_buffer(b"".join(packed))])
        return pa.ListArray.from_arrays(offsets, values)

    return encode_batch(F.col(text) if isinstance(text, str) else text)


def decode(ids: Column | str, tokenizer: str | None = None) -> Column:
    """``string``: the text that the library's ``decode(ids, skip_special_tokens=False)`` gives."""

    @F.arrow_udf("string")
    def decode_batch(lists: pa.Array) -> pa.Array:
        bpe = load(tokenizer)
        flat, starts = lists.values.to_numpy(zero_copy_only=False).tolist(), lists.offsets.to_numpy().tolist()
        valid = lists.is_valid().to_pylist()
        return pa.array(
            [bpe.decode(flat[a:b]) if ok else "" for a, b, ok in zip(starts, starts[1:], valid)], pa.string()
        )

    return decode_batch(F.col(ids) if isinstance(ids, str) else ids)


def _running(counts):
    total = 0
    for n in counts:
        total += n
        yield total
