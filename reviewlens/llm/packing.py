"""Sum-of-squares online packing of documents into token windows.

Each task packs the documents of its partition as they come; no shuffle.  A
document's full windows become sequences of their own.  Its last, shorter piece
goes to the fill level ``h`` (0: a new sequence) that makes the sum over all
levels of the squared number of partly filled sequences smallest; the numbers
are kept in a level array, ties go to the fullest level.  At the end of the
partition the sequences still open are closed by cutting: the emptiest fill up
the fullest, and the tokens of the last one form sequences whose lengths are
powers of two, which need no padding.  So no sequence is padded.

Memory of a task: one Arrow batch and the pieces in open sequences.  A retried
task reads the same rows and makes the same sequences; ids are unique because
the partition's number is part of them.

Edge cases: a null or empty text has the end token only; an empty table gives no
rows; repeated rows are packed as often as they come; a null ``doc_id`` is kept;
columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.bpe import load, stretches
from reviewlens.llm.common import give_back

WINDOW = 2048
END_ID = 1
#: Sequences of one partition are numbered below this.
PER_PARTITION = 1 << 40
#: Rows of an output batch.
BATCH_ROWS = 500
BYTES = 4  # of a token id


class LevelArray:
    """Open sequences by fill level, and the sum-of-squares rule."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        #: Number of open sequences at each level; level 0 and the full level count none.
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]

    def level(self, size: int) -> int:
        """Fill level for a piece of ``size`` tokens (less than a window)."""
        top = self.window - size
        # moving a sequence from h to h + size changes the sum of squares by 2 * (cost + 1)
        cost = self.count[size:] - self.count[: top + 1]
        cost = cost.astype(np.float64)
        cost[0] -= 0.5  # a new sequence leaves no level: its sum grows by 2 N + 1
        cost[top] -= 0.5  # a full sequence enters no level: its sum falls by 2 N - 1
        free = self.count[: top + 1] > 0
        free[0] = True
        cost[~free] = np.inf
        return top - int(cost[::-1].argmin())

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece into a sequence; the sequence if that fills it."""
        h = self.level(size)
        sequence = []
        if h:
            sequence = self.open[h].pop()
            self.count[h] -= 1
        sequence.append(piece)
        if h + size == self.window:
            return sequence
        self.open[h + size].append(sequence)
        self.count[h + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """Close all open sequences by cutting, full ones first; the last tokens in powers of two."""
        levels = deque((h, s) for h in range(self.window - 1, 0, -1) for s in self.open[h])
        while levels:
            h, sequence = levels.popleft()
            need = self.window - h
            while need and levels:
                low, donor = levels.pop()
                while donor and need:
                    piece = donor.pop()
                    length = len(piece[2]) // BYTES
                    if length > need:
                        donor.append(cut(piece, 0, length - need))
                        piece, length = cut(piece, length - need, length), need
                    sequence.append(piece)
                    need -= length
                    low -= length
                if donor:
                    levels.append((low, donor))
            if not need:
                yield sequence
                continue
            left = self.window - need
            for size in (1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1):
                part = []
                while size:
                    piece = sequence.pop()
                    length = len(piece[2]) // BYTES
                    if length > size:
                        sequence.append(cut(piece, 0, length - size))
                        piece, length = cut(piece, length - size, length), size
                    part.append(piece)
                    size -= length
                yield part
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0


def cut(piece: tuple, a: int, b: int) -> tuple:
    """Tokens ``a`` to ``b`` of a piece (doc_id, start, packed ids, doc_tokens)."""
    doc, start, ids, total = piece
    return doc, start + a, ids[a * BYTES : b * BYTES], total


def pack_partition(documents: Iterator[tuple], window: int = WINDOW) -> Iterator[list]:
    """Sequences (lists of pieces) of (doc_id, packed ids) pairs."""
    levels = LevelArray(window)
    step = window * BYTES
    for doc, ids in documents:
        total = len(ids) // BYTES
        full = len(ids) // step * step
        for at in range(0, full, step):
            yield [(doc, at // BYTES, ids[at : at + step], total)]
        if full < len(ids):
            done = levels.place((doc, full // BYTES, ids[full:], total), total - full // BYTES)
            if done:
                yield done
    yield from levels.rest()


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    tokenizer: str | None = None,
) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens, sequence_id, offset``."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    arrow = pa.schema(
        [(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in schema.split(", "))]
    )
    end = int(end_id).to_bytes(BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)

        def documents() -> Iterator[tuple]:
            for batch in batches:
                keys = iter(batch.column(0).to_pylist())
                for some in stretches(batch.column(1).to_pylist()):
                    for packed in bpe.pack(some):
                        yield next(keys), packed + end

        first = TaskContext.get().partitionId() * PER_PARTITION
        rows: list[tuple] = []
        for number, sequence in enumerate(pack_partition(documents(), window)):
            offset = 0
            for key, start, ids, total in sequence:
                length = len(ids) // BYTES
                rows.append((key, start, length, ids, total, first + number, offset))
                offset += length
            if len(rows) >= BATCH_ROWS:
                yield to_batch(rows)
                rows = []
        if rows:
            yield to_batch(rows)
        bpe.known.clear()
        give_back()

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return narrow.mapInArrow(run, schema)


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with their ids' CRC-32 in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
