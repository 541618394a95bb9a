"""Removal of repeated passages with suffix arrays built by induced sorting.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere else, in
the same or another document, judged on the input.  One suffix array of the corpus does
not fit one machine, so the corpus is cut into shards of strings such that equal strings
of ``LENGTH`` bytes (windows) always meet in one shard:

1. Each window has an anchor, its smallest hash of ``GRAM`` bytes (the leftmost of equal
   ones).  Windows that start next to each other mostly share it; such a run of windows is
   one string.  Equal windows have equal anchors, so only runs whose anchor occurs again are
   kept (counted in Spark).  An anchor whose strings are all equal is settled: all its
   windows are repeated.
2. Other strings, one for each different content, are cut into pieces of up to ``BLOCK``
   windows by the windows' distance to the anchor.  All windows of a piece hold the same
   core of ``LENGTH - BLOCK + 1`` bytes, so pieces with different cores have no window in
   common, and where cores are equal the core can be one symbol.  Pieces shrink to at most
   ``2 * BLOCK - 1`` symbols, and a window to ``BLOCK``.
3. Cores with several different pieces are dealt to shards of about ``SHARD_SYMBOLS``.  Each
   shard's suffix array and permuted common prefixes are computed in one task: a window is
   repeated if the common prefix with a neighbour in the array is as long as the window.  A
   core with more than ``CORE_SYMBOLS`` of pieces (the edge of a passage in very many
   documents) would be a hot shard; its windows are counted in Spark instead, exactly.
4. The repeated windows go back to the documents that hold the strings, by equi-joins, and
   their union is cut out of the text.

Hashes are compared as pairs of 64 bits (anchor and content).  Every step's result is a
written table; texts are shuffled to the strings kept of them, and to what is cut out.

Edge cases: a null text is empty; shorter texts lose nothing but count as they are; rows
repeated with id and text each count as a document of their own; a null ``doc_id`` is kept;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import give_back, release, unused
from reviewlens.llm.hashing import Hashes
from reviewlens.llm.suffix_array import common_prefixes, suffix_array
from reviewlens.session import materialize

LENGTH = 200
GRAM = 32
#: Windows of a piece.
BLOCK = 32
#: Symbols of a suffix array, and of one core's pieces beyond which windows are counted in Spark.
SHARD_SYMBOLS = 1 << 19
CORE_SYMBOLS = 1 << 21
#: Bytes of text worked on at once.
STRETCH = 1_000_000
#: Low bits of an ordering key that hold the place (leftmost of equal hashes first).
PLACE_BITS = 30


def runs(text: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor.

    (document's number, first window, windows, distance of the anchor from the first window,
    anchor's hash, string's hash).  ``text``: documents one after the other, from ``starts``;
    windows stay inside documents.
    """
    if len(text) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    hashes = Hashes(text)
    grams = hashes.grams(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, done = length - gram + 1, 1  # the smallest key of each span, by doubling
    while done * 2 <= span:
        key = np.minimum(key[:-done], key[done:])
        done *= 2
    if done < span:
        key = np.minimum(key[: len(key) - (span - done)], key[span - done :])
    anchor = (key & low).astype(np.int64)
    last = np.append(starts[1:], len(text)) - length  # last window of each document
    has = last >= starts
    edge = np.zeros(len(anchor) + 1, np.int32)
    edge[starts[has]] += 1
    edge[last[has] + 1] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    opens = inside.copy()
    opens[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    opens[starts[has]] = True
    at = np.flatnonzero(opens)
    number = np.cumsum(inside)  # of windows so far
    count = np.diff(np.concatenate([number[at] - 1, number[-1:]]))
    doc = np.searchsorted(starts, at, side="right") - 1
    whole = hashes.of(at, at + count + length - 1) + count.astype(np.uint64)
    return doc, at - starts[doc], count, anchor[at] - at, grams[anchor[at]], whole


def _stretches(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    some, total = [], 0
    for t in texts:
        if some and total + len(t) > most:
            yield some
            some, total = [], 0
        some.append(t)
        total += len(t)
    if some:
        yield some


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def document_runs(rows: DataFrame, length: int) -> DataFrame:
    """``doc_id, hash, low, windows, ahead, anchor, id`` of rows ``doc_id, hash, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for some in _stretches(_bytes(batch.column(2)), STRETCH):
                starts = np.cumsum([0, *(len(t) for t in some)])[:-1]
                doc, low, count, ahead, anchor, whole = runs(np.frombuffer(b"".join(some), np.uint8), starts, length)
                take = pa.array(doc + first)
                first += len(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        *(pa.array(c, pa.int32()) for c in (low, count, ahead)),
                        *(pa.array(c.view(np.int64)) for c in (anchor, whole)),
                    ],
                    ["doc_id", "hash", "low", "windows", "ahead", "anchor", "id"],
                )
        give_back()

    return rows.mapInArrow(run, "doc_id long, hash long, low int, windows int, ahead int, anchor long, id long")


def _slices(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Binary array of ``text[start:end]``."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.Array.from_buffers(
        pa.binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[at].tobytes())]
    )


def string_pieces(rows: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """Pieces of the strings of rows ``text, strings``.

    ``anchor, id, at`` (first window of the piece in its string), ``windows, n, core`` (hash),
    ``left, right`` (bytes of the piece before and after the core).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets, entries = lists.offsets.to_numpy(), lists.values
            first = 0
            for some in _stretches(_bytes(batch.column(0)), STRETCH):
                own = entries.slice(offsets[first], offsets[first + len(some)] - offsets[first])
                per_doc = np.diff(offsets[first : first + len(some) + 1])
                first += len(some)
                if not len(own):
                    continue
                col = {f.name: own.field(f.name).to_numpy() for f in own.type}
                text = np.frombuffer(b"".join(some), np.uint8)
                begin = np.repeat(np.cumsum([0, *(len(t) for t in some)])[:-1], per_doc) + col["low"]
                # distances to the anchor run from ahead down to ahead - windows + 1; one piece a block of them
                high, low = col["ahead"] // block, (col["ahead"] - col["windows"] + 1) // block
                each = high - low + 1
                of = np.repeat(np.arange(len(own)), each)
                number = high[of] - (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each))
                ahead = col["ahead"][of].astype(np.int64)
                most = np.minimum(ahead, number * block + block - 1)
                least = np.maximum(ahead - col["windows"][of] + 1, number * block)
                anchor = begin[of] + ahead
                core, stop = anchor - number * block, anchor - number * block + length - block + 1
                hashes = Hashes(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(col["anchor"][of]),
                        pa.array(col["id"][of]),
                        pa.array(ahead - most, pa.int32()),
                        pa.array(most - least + 1, pa.int32()),
                        pa.array(col["n"][of]),
                        pa.array((hashes.of(core, stop) + number.astype(np.uint64)).view(np.int64)),
                        _slices(text, anchor - most, core),
                        _slices(text, stop, anchor - least + length),
                    ],
                    ["anchor", "id", "at", "windows", "n", "core", "left", "right"],
                )
        give_back()

    schema = "anchor long, id long, at int, windows int, n long, core long, left binary, right binary"
    return rows.mapInArrow(run, schema)


def repeated_windows(cores: np.ndarray, left: list[bytes], right: list[bytes], block: int = BLOCK) -> list[np.ndarray]:
    """Windows of each piece that occur again in the pieces, by suffix array: ``[from, to, from, to, ...]``.

    A piece is ``left``, its core (a number from 0) as one symbol, and ``right``; a window has ``block`` symbols.
    """
    text = np.frombuffer(b"".join(a + b"\0" + b + b"\0" for a, b in zip(left, right)), np.uint8).astype(np.int64) + 1
    ahead = np.array([len(a) for a in left])
    size = ahead + np.array([len(b) for b in right]) + 2
    begin = np.cumsum(size) - size
    stop = begin + size - 1
    text[begin + ahead] = 257 + cores
    text[stop] = 0
    room = np.repeat(stop, size) - np.arange(len(text))
    before, shared = common_prefixes(text, suffix_array(text), room)
    long = np.flatnonzero(shared >= block)
    again = np.zeros(len(text) + 1, np.int8)
    again[long] = 1
    again[before[long]] = 1
    edges = np.flatnonzero(np.diff(np.concatenate([[0], again])))
    of = np.searchsorted(stop, edges[::2])
    spans = np.stack([edges[::2] - begin[of], edges[1::2] - begin[of]], axis=1)
    return [s.ravel() for s in np.split(spans, np.searchsorted(of, np.arange(1, len(left))))]


PIECE = ["anchor", "core", "left", "right"]


def _by_suffix_array(pieces: DataFrame, shards: int, block: int) -> DataFrame:
    """``PIECE`` and ``spans`` of distinct pieces."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = pdf.groupby(["anchor", "core"], sort=False).ngroup().to_numpy()
        found = repeated_windows(codes, pdf["left"].to_list(), pdf["right"].to_list(), block)
        give_back()
        return pdf[PIECE].assign(spans=found)

    dealt = pieces.select(F.pmod(F.xxhash64("anchor", "core"), F.lit(shards)).alias("shard"), *PIECE)
    schema = "anchor long, core long, left binary, right binary, spans array<int>"
    return dealt.groupBy("shard").applyInPandas(run, schema)


def _by_counting(pieces: DataFrame, block: int) -> DataFrame:
    """``PIECE`` and ``spans`` of distinct pieces with their ``windows`` and ``n``: every window counted."""
    at = F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("at")
    tail = F.substring(F.col("left"), F.col("at") + 1, F.lit(block))
    head = F.substring(F.col("right"), F.lit(1), F.lit(block - 1) - F.length("tail"))
    windows = pieces.select(*PIECE, "n", at).withColumn("tail", tail).withColumn("head", head)
    windows = materialize(windows, "passage-windows")
    window = ["anchor", "core", "tail", "head"]
    again = windows.groupBy(*window).agg(F.sum("n").alias("total")).filter("total > 1").select(*window)
    found = windows.join(again, window, "left_semi").groupBy(*PIECE).agg(F.collect_set("at").alias("at"))
    return found.select(*PIECE, F.flatten(F.transform("at", lambda a: F.array(a, a + 1))).alias("spans"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``doc_id, hash, spans`` (windows that occur again) of rows ``doc_id, hash, text`` that have any."""
    found = materialize(document_runs(rows, length), "passage-runs")
    anchors = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("total"), F.min("id").alias("x"), F.max("id").alias("y")
    )
    anchors = anchors.filter("total > 1").select("anchor", (F.col("x") == F.col("y")).alias("settled"))
    anchors = materialize(anchors, "passage-anchors")  # as a table, so that the join below can split a hot anchor
    kept = materialize(found.join(anchors, "anchor"), "passage-candidates")
    release(rows.sparkSession)

    # one document for each different string of the unsettled anchors, and its pieces
    place = F.struct("doc_id", "hash", "low", "windows", "ahead")
    strings = kept.filter("not settled").groupBy("anchor", "id").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p"))
    strings = materialize(strings, "passage-strings")
    own = strings.groupBy(F.col("p.doc_id").alias("d"), F.col("p.hash").alias("h")).agg(
        F.collect_list(F.struct("p.low", "p.windows", "p.ahead", "anchor", "id", "n")).alias("strings")
    )
    held = rows.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h")))
    pieces = materialize(string_pieces(held.select("text", "strings"), length, block), "passage-pieces")
    release(rows.sparkSession)

    distinct = pieces.groupBy(*PIECE).agg(F.sum("n").alias("n"), F.first("windows").alias("windows"))
    distinct = materialize(distinct, "passage-distinct")
    cores = distinct.groupBy("anchor", "core").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.length("left") + F.length("right") + 2).alias("symbols")
    )
    several = distinct.join(cores.filter("kinds > 1"), ["anchor", "core"])
    several = materialize(several, "passage-several")
    few, many = several.filter(F.col("symbols") <= CORE_SYMBOLS), several.filter(F.col("symbols") > CORE_SYMBOLS)
    total = few.agg(F.sum(F.length("left") + F.length("right") + 2)).first()[0] or 0
    whole = F.array(F.lit(0), F.col("windows"))
    spans = distinct.filter("n > 1").select(*PIECE, whole.alias("spans"))
    if total:
        spans = spans.union(_by_suffix_array(few, ceil(total / SHARD_SYMBOLS), block))
    if not many.isEmpty():
        spans = spans.union(_by_counting(many, block))
    spans = materialize(spans.filter(F.size("spans") > 0), "passage-spans")
    release(rows.sparkSession)

    # back to the strings, and from the strings to the documents
    shift = lambda by: F.transform("spans", lambda s: s + F.col(by)).alias("spans")
    in_strings = pieces.join(spans, PIECE).select("anchor", "id", shift("at")).groupBy("anchor", "id")
    in_strings = in_strings.agg(F.flatten(F.collect_set("spans")).alias("spans"))
    in_strings = materialize(in_strings, "passage-in-strings")  # so that the join below can split a hot string
    unsettled = kept.filter("not settled").select("doc_id", "hash", "low", "anchor", "id").distinct()
    placed = unsettled.join(in_strings, ["anchor", "id"]).select("doc_id", "hash", shift("low"))
    settled = kept.filter("settled").select(
        "doc_id", "hash", F.array(F.col("low"), F.col("low") + F.col("windows")).alias("spans")
    )
    return placed.union(settled).groupBy("doc_id", "hash").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def cut_spans(text: bytes, spans: np.ndarray, length: int = LENGTH) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal runs removed); ``spans``: windows ``[from, to, ...]``."""
    gone = np.zeros(len(text) + 1, np.int32)
    np.add.at(gone, spans[::2], 1)
    np.add.at(gone, spans[1::2] + length - 1, -1)
    kept = np.cumsum(gone[:-1]) == 0
    data = np.frombuffer(text, np.uint8)[kept].tobytes()
    runs_removed = int((~kept & np.concatenate([[True], kept[:-1]])).sum()) if len(kept) else 0
    return data, len(text) - len(data), runs_removed


def remaining_text(text: bytes, spans: np.ndarray, length: int = LENGTH) -> str:
    """The text that a cut leaves; where it goes through a character, what is left of that goes, too."""
    edges = np.stack([spans[::2], spans[1::2] + length - 1], axis=1)
    parts, at = [], 0
    for a, b in edges[np.argsort(edges[:, 0])].tolist():
        if a > at:
            parts.append(text[at:a].decode(errors="ignore"))  # only the ends of a part can be incomplete
        at = max(at, b)
    return "".join(parts) + text[at:].decode(errors="ignore")


def cut_out(docs: DataFrame, out: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """``docs`` with a column ``out``: null where nothing goes, else ``struct<kept, n_removed long, n_spans long>``.

    ``kept`` are the remaining bytes, or with ``as_text`` the remaining text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    spans = materialize(repeated_spans(rows, length), "passage-documents")
    release(docs.sparkSession)
    own_id, own_hash, own_spans = unused(docs, "__id", "__hash", "__spans")
    spans = spans.select(F.col("doc_id").alias(own_id), F.col("hash").alias(own_hash), F.col("spans").alias(own_spans))

    @F.arrow_udf(f"kept {'string' if as_text else 'binary'}, n_removed long, n_spans long")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        kept, removed, count = [], [], []
        for t, s in zip(texts.cast(pa.binary()), spans):
            places = s.as_py()
            if places is None:
                parts = None, None, None
            else:
                raw, windows = t.as_py(), np.array(places, np.int64)
                parts = cut_spans(raw, windows, length)
                if as_text:
                    parts = remaining_text(raw, windows, length), *parts[1:]
            for column, value in zip((kept, removed, count), parts):
                column.append(value)
        give_back()
        columns = [pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["kept", "n_removed", "n_spans"])

    same = F.col(doc_id).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(body) == F.col(own_hash))
    joined = docs.join(spans, same, "left")
    some = F.col(own_spans).isNotNull()
    done = cut(F.when(some, body), F.col(own_spans))
    return joined.withColumn(out, F.when(some, done)).drop(own_id, own_hash, own_spans)


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: the remaining bytes) for every row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return cut_out(docs.select(doc_id, text), "__cut", doc_id, text, length).select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.coalesce("__cut.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("__cut.n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("__cut.kept", body.cast("binary")).alias("kept"),
    )


def without_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the remaining text; rows of which nothing remains go.

    Where a cut goes through a character, what is left of it goes, too.
    """
    (out,) = unused(docs, "__cut")
    left = cut_out(docs, out, doc_id, text, length, as_text=True)
    changed = F.col(out).isNotNull()
    left = left.withColumn(text, F.when(changed, F.col(f"{out}.kept")).otherwise(F.col(text)))
    return left.filter(~changed | (F.length(text) > 0)).select(*docs.columns)
