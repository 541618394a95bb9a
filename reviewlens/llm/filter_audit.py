"""How filters that run one after the other share out what they remove.

``k`` filters can be applied in ``k!`` orders.  An order is a path through the lattice of subsets
of filters, from the empty set to the full one; a step is an edge ``(done, next)``.  What an edge
removes does not depend on the order of the filters before it: the documents that fail ``next``
and nothing of ``done``.  So one table of documents by the set of filters they fail gives the
removals of all ``k 2^(k-1)`` edges, and these give

* each order's steps: the edges on its path;
* each filter's Shapley sum: a forward pass counts the paths that reach every state, a backward
  pass those that leave it, and an edge counts as often as their product says.

Spark reads the documents once (``failures``: one narrow Arrow function over whole texts), finds the
smallest id of each text from digests, and counts documents by (part, failed set), summed before
they move.  Nothing is bound to a part's size; the lattice is worked out for many parts
side by side, from at most ``2^k`` counts a part.

Edge cases: a null text is an empty one; an empty text fails "under 50 words" and, unless it is the
first of its kind, "copy"; a null part is the empty string, and both are one part; rows equal in
id and text are none of them copies of each other (the id is not smaller); a row without an id is
no copy, and no copy's first; labels of one id count once, and as set if any row of it says so;
labels without a document, and rows without an id, change nothing; an empty table gives no rows;
columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import materialize

#: Filters in the order of their bits: few words, few different words, capitals, symbols, copy.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: UTF-8 bytes that do not begin a code point.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Bytes of a text whose words are split at once.
STRETCH = 1 << 20
#: Parts whose steps are worked out at once.
PARTS_AT_ONCE = 256
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The maximal runs without ASCII white space, a stretch of the text at a time."""
    at = 0
    while len(text) - at > STRETCH:
        blank = _BLANK.search(text, at + STRETCH)
        if blank is None:
            break
        yield text[at : blank.start()].split()
        at = blank.end()
    yield text[at:].split()


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, seen = 0, set()
    for words in words_of(text):
        n += len(words)
        seen.update(words)
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (n < MIN_WORDS)
        | (100 * len(seen) < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def failures(text: Column | str) -> Column:
    """``struct<mask int, digest binary>``: failed bits of A to D, and SHA-256 and length of the text."""

    @F.arrow_udf("struct<mask:int,digest:binary>")
    def of_batch(texts: pa.Array) -> pa.Array:
        masks, digests = [], []
        for t in texts.cast(pa.large_binary()):
            raw = t.as_py() or b""
            masks.append(failed(raw))
            digests.append(hashlib.sha256(raw).digest() + len(raw).to_bytes(8, "big"))
        return pa.StructArray.from_arrays([pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["mask", "digest"])

    return of_batch(F.col(text) if isinstance(text, str) else text)


def document_masks(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and set of failed filters.

    Texts are told apart by their digest.  The rows of a text that are no copies are those with its
    smallest id, so they are found by a join on digest and id together: the copies of a hot text
    are dealt by their ids.  The narrow rows are written once, as several joins read them.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failures(text).alias("f")
    ).select("id", "part", "f.mask", "f.digest")
    rows = materialize(rows, "audited")
    said = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    said = said.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    first = rows.filter(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    told = rows.join(said, "id", "left").join(first, ["digest", "id"], "left")
    copy = (F.col("id").isNotNull() & F.col("first").isNull()).cast("int")
    mark = lambda c: F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))).alias(c)
    masked = told.withColumn("mask", F.col("mask") + copy * (1 << FILTERS.index("E")))
    return masked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), mark("good"), mark("toxic"))


class Lattice:
    """States (sets of filters done), edges and path counts of ``k`` filters."""

    def __init__(self, k: int):
        self.k = k
        states = range(1 << k)
        self.edges = [(s, f) for s in states for f in range(k) if not s >> f & 1]
        self.number = {edge: e for e, edge in enumerate(self.edges)}
        self.reach = [1] + [0] * ((1 << k) - 1)
        self.leave = [0] * ((1 << k) - 1) + [1]
        for s, f in self.edges:  # an edge leads to a larger number, so states come in order
            self.reach[s | 1 << f] += self.reach[s]
        for s, f in reversed(self.edges):
            self.leave[s] += self.leave[s | 1 << f]
        masks = np.arange(1 << k)
        #: Which sets of failed filters an edge removes, and which are left in a state.
        self.removes = np.stack([(masks & s == 0) & (masks >> f & 1 == 1) for s, f in self.edges], axis=1).astype(np.int64)
        self.keeps = np.stack([masks & s == 0 for s in states], axis=1).astype(np.int64)
        self.fails = np.stack([masks >> f & 1 == 1 for f in range(k)], axis=1).astype(np.int64)
        self.weight = np.zeros((len(self.edges), k), np.int64)
        for e, (s, f) in enumerate(self.edges):
            self.weight[e, f] = self.reach[s] * self.leave[s | 1 << f]

    def paths(self) -> list[list[tuple[int, int]]]:
        """Every order as the edges that it takes."""
        found = []
        for order in permutations(range(self.k)):
            state, path = 0, []
            for f in order:
                path.append((state, f))
                state |= 1 << f
            found.append(path)
        return found


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """Every order's steps in every part, from ``part, mask, n, good, toxic``.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    """
    size = 1 << len(letters)
    per_mask = lambda c: F.array(*(F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(size)))
    parts = counts.groupBy("part").agg(*(per_mask(c).alias(c) for c in ("n", "good", "toxic")))
    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(len(letters))
        paths = lattice.paths()
        edge = np.array([lattice.number[e] for path in paths for e in path])
        after = np.array([s | 1 << f for path in paths for s, f in path])
        which = np.array([f for path in paths for _, f in path])
        order = np.repeat(["".join(letters[f] for _, f in path) for path in paths], len(letters))
        step = np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(paths))
        alone = 1 << np.arange(len(letters))
        for pdf in batches:
            for at in range(0, len(pdf), PARTS_AT_ONCE):
                some = pdf.iloc[at : at + PARTS_AT_ONCE]
                n, good, toxic = (np.stack(some[c].to_list()).astype(np.int64) for c in ("n", "good", "toxic"))
                removed = n @ lattice.removes
                yield pd.DataFrame(
                    {
                        "part": np.repeat(some["part"].to_numpy(), len(edge)),
                        "filter_order": np.tile(order, len(some)),
                        "step": np.tile(step, len(some)),
                        "kept": (n @ lattice.keeps)[:, after].ravel(),
                        "removed": removed[:, edge].ravel(),
                        "redundant": ((n @ lattice.fails)[:, which] - removed[:, edge]).ravel(),
                        "unique_fails": n[:, alone][:, which].ravel(),
                        "good_lost": (good @ lattice.removes)[:, edge].ravel(),
                        "toxic_lost": (toxic @ lattice.removes)[:, edge].ravel(),
                        "shapley": (removed @ lattice.weight)[:, which].ravel(),
                    }
                )

    return parts.mapInPandas(steps, schema)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters' audit by source."""
    return audit(document_masks(docs, labels))
