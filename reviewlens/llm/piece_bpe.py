"""Byte-level BPE through a sentencepiece model that is serialised from the ranks.

A file of ranks (base64 of a token's bytes, and its rank) becomes a sentencepiece BPE model
without any training: every token is a piece, its bytes written as printable characters, one a
byte; a piece's score is its negative rank, so the best pair to merge is the one of the lowest
rank; normalisation is the identity.  A text is cut into pre-tokens by the public pattern, each
is encoded by that model, and a piece's number is its rank.  Decoding is the inverse mapping:
the bytes of each rank, one after the other.

Pre-tokens recur, so a worker keeps the ids of a bounded number of them (memory, not results).
``encode`` and ``decode`` are narrow Arrow functions without a shuffle.  Ids travel packed, as
little-endian unsigned 32-bit integers: the form in which token files are stored.

Edge cases: a null text encodes like an empty one (no ids); null ids decode to no bytes; an id
that is not in the file decodes to nothing; a token that its own pairs cannot build is still
found when it is a whole pre-token, as the reference library does; texts of any length are cut
piecemeal; repeated rows give equal rows, an empty table an empty one.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens.llm.bpe import byte_alphabet

RANKS = "byte_bpe_50k.tiktoken"
#: Pre-tokens kept with their ids in a worker before the table starts anew.
KNOWN = 300_000
#: Longest pre-token that is kept, in characters.
KNOWN_LENGTH = 64
#: Pre-tokens of a long text worked on at once, and the length from which a text is long.
AT_ONCE = 100_000
LONG = 500_000

# Fixed values of the sentencepiece model format: field numbers and enumerations.
PIECE, PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 1, 2, 3
TRAINER, MODEL_TYPE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 2, 3, 40, 41, 42, 43
NORMALIZER, NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 3, 1, 3, 4, 5
UNKNOWN, BPE = 2, 2
VARINT, BYTES, FLOAT = 0, 2, 5


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """The tokens' bytes in order of rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, kind: int, value) -> bytes:
    """One field of the wire format."""
    tag = _varint(number << 3 | kind)
    if kind == VARINT:
        return tag + _varint(int(value))
    if kind == FLOAT:
        return tag + struct.pack("<f", value)
    return tag + _varint(len(value)) + value


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model of the tokens in order of rank; the unknown piece comes last."""
    letters = byte_alphabet()
    out = bytearray()
    for rank, token in enumerate(tokens):
        text = "".join(map(letters.__getitem__, token)).encode()
        out += _field(PIECE, BYTES, _field(PIECE_TEXT, BYTES, text) + _field(PIECE_SCORE, FLOAT, -float(rank)))
    unknown = _field(PIECE_TEXT, BYTES, b"<unk>") + _field(PIECE_SCORE, FLOAT, 0.0) + _field(PIECE_TYPE, VARINT, UNKNOWN)
    out += _field(PIECE, BYTES, unknown)
    trainer = _field(MODEL_TYPE, VARINT, BPE) + _field(UNK_ID, VARINT, len(tokens))
    for special in (BOS_ID, EOS_ID, PAD_ID):
        trainer += _field(special, VARINT, -1)
    normalizer = _field(NAME, BYTES, b"identity")
    for rule in (ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES):
        normalizer += _field(rule, VARINT, False)
    return bytes(out + _field(TRAINER, BYTES, trainer) + _field(NORMALIZER, BYTES, normalizer))


class _Known(dict):
    """Pre-token -> its packed ids; a lacking one is encoded, and kept while there is room."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class PieceBpe:
    """Encoder and decoder of one file of ranks."""

    def __init__(self, path: str, pattern: str, known: int = KNOWN):
        from sentencepiece import SentencePieceProcessor

        self.tokens = read_ranks(path)
        self.rank = {token: i for i, token in enumerate(self.tokens)}
        self.pieces = SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.letters = {b: letter for b, letter in enumerate(byte_alphabet())}
        self.words = regex.compile(pattern)
        self.known = _Known(self._encode_word, known)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.ends = np.cumsum([0, *map(len, self.tokens)])

    def _encode_word(self, word: str) -> bytes:
        raw = word.encode()
        whole = self.rank.get(raw)
        if whole is not None:
            return struct.pack("<I", whole)
        ids = self.pieces.encode(raw.decode("latin-1").translate(self.letters), num_threads=1)
        return np.array(ids, "<u4").tobytes()

    def pack(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(text) < LONG:
            return b"".join(map(self.known.__getitem__, self.words.findall(text)))
        out = bytearray()
        words = map(itemgetter(0), self.words.finditer(text))
        while some := b"".join(map(self.known.__getitem__, islice(words, AT_ONCE))):
            out += some
        return bytes(out)

    def unpack(self, packed: bytes | None) -> bytes:
        """The bytes of the ids, one token after the other."""
        if not packed:
            return b""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        ids = ids[ids < len(self.tokens)]
        size = self.ends[ids + 1] - self.ends[ids]
        before = np.cumsum(size) - size
        return self.flat[np.arange(int(size.sum())) + np.repeat(self.ends[ids] - before, size)].tobytes()


@lru_cache(maxsize=2)
def load(ranks: str | None, pattern: str | None) -> PieceBpe:
    """The encoder of a file, once per Python worker."""
    return PieceBpe(ranks or default_ranks(), pattern or default_pattern())


def encode(text: Column | str, ranks: str | None = None, pattern: str | None = None) -> Column:
    """``binary``: the packed ids of ``text``; ``ranks`` is a path that the executors can read (default: the public file)."""

    @F.arrow_udf("binary")
    def encode_batch(texts: pa.Array) -> pa.Array:
        bpe = load(ranks, pattern)
        return pa.array((bpe.pack(t.as_py()) for t in texts), pa.binary())

    return encode_batch(F.col(text) if isinstance(text, str) else text)


def decode(packed: Column | str, ranks: str | None = None, pattern: str | None = None) -> Column:
    """``binary``: the bytes that packed ids stand for."""

    @F.arrow_udf("binary")
    def decode_batch(lists: pa.Array) -> pa.Array:
        bpe = load(ranks, pattern)
        return pa.array((bpe.unpack(p.as_py()) for p in lists), pa.binary())

    return decode_batch(F.col(packed) if isinstance(packed, str) else packed)


def round_trip(text: Column | str, ranks: str | None = None, pattern: str | None = None) -> Column:
    """``struct<ids binary, decoded binary>``: the packed ids of ``text`` and what they decode to, in one pass.

    The same as ``decode(encode(text))`` beside ``encode(text)``, which Spark would encode twice.
    """

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def both(texts: pa.Array) -> pa.Array:
        bpe = load(ranks, pattern)
        ids = [bpe.pack(t.as_py()) for t in texts]
        columns = [pa.array(ids, pa.binary()), pa.array(map(bpe.unpack, ids), pa.binary())]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    return both(F.col(text) if isinstance(text, str) else text)
