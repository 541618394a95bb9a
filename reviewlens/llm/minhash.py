"""Near-duplicate documents by min-max hashing.

A document's set are its distinct word shingles (64-bit hashes).  Every permutation
gives two signature values, the minimum and the maximum of the permuted set, so a
signature of 2 p values needs p hash evaluations a shingle.  The values are cut into
bands; documents that share a band are candidates.  With ``BANDS`` bands of ``ROWS``
values a pair at the default threshold is missed with a chance below one in a million.

Steps, all of them on narrow rows but for the two that read sets:

1. Documents with equal sets form a class, so copies cost one row from here on.
2. In each bucket the member that meets the most others is the pivot, and every class has a
   best pivot over its buckets.  Candidate pairs are (best pivot, class): one a class.  They
   are compared on full sets, and what differs is kept: a bit for each of the pivot's
   shingles, and the member's others.
3. Components of the links found (labels and pointer jumping, written each round).
4. Where a bucket still holds several components and its members have several best pivots,
   they are compared with the bucket's own pivot, too; components again.
5. So members of a bucket that are in different components now have a pivot in common.  All
   members of such a pivot are held against those in another component than it, in blocks:
   the bits give the common shingles of the pivot, and shingles that no other member has
   cannot be shared, so few pairs need a look at the rest.  The comparison is exact, nothing
   is capped, and a task returns one link for two components that it joins, not all pairs.

Edge cases: a text without words (or null) has an empty set and is linked with nothing;
a row without a ``doc_id`` has no identity, is linked with nothing and kept; repeated
rows all get the same component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import give_back, release, unused
from reviewlens.llm.hashing import Hashes, mix
from reviewlens.session import materialize

#: Words in a shingle, and the similarity in hundredths from which documents are linked.
SHINGLE = 5
PERCENT = 80
BANDS = 28
ROWS = 4
SEED = 11
#: Members of a pivot in a block, or of several small ones in a task; bits of a block unpacked at once.
TASK_ROWS = 3000
SIDE_BITS = 1 << 22
#: Links of a partition while components are found.
LINK_ROWS = 200_000
#: Bytes of text worked on at once.
STRETCH = 1_000_000

# The white space of the word pattern [^\x20\x09-\x0D]+, and A-Z to a-z.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    """The permutations' odd factors."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, BANDS * ROWS // 2, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts (bytes one after the other, from ``starts``), and each word's place."""
    blank = np.zeros(256, bool)
    blank[list(WHITE)] = True
    solid = ~blank[text]
    edge = np.zeros(len(text) + 1, bool)
    edge[starts[starts < len(text)]] = True
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return mix(Hashes(text).of(a, b) + (b - a).astype(np.uint64)), a


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one after the other; and where each text's begin."""
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
    text = np.frombuffer(b"".join(texts).translate(LOWER), np.uint8)
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    words, at = word_hashes(text, starts)
    first = np.concatenate([np.searchsorted(at, starts), [len(words)]])
    # a shingle is hashed word by word; a text with fewer words is one shingle
    rolled = mix(words + np.uint64(size))
    whole = [0] * len(texts)
    for n, (i, j) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if 0 < j - i < size:
            h = np.uint64(j - i)
            for w in words[i:j]:
                h = mix(np.array([h]) * np.uint64(3) + w)[0]
            whole[n] = int(h)
    many = max(0, len(words) - size + 1)
    rolled = rolled[:many]
    for k in range(1, size):
        rolled = mix(rolled * np.uint64(3) + words[k : k + many])
    sets, sizes = [], np.zeros(len(texts) + 1, np.int64)
    for n, (i, j) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if j - i >= size:
            own = np.sort(rolled[i : j - size + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif j > i:
            own = np.array([whole[n]], np.uint64)
        else:
            continue
        sets.append(own)
        sizes[n + 1] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes)


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row by row the minimum and maximum under each permutation; ``starts`` of non-empty sets."""
    factors = _factors()
    out = np.empty((len(starts), 2 * len(factors)), np.uint64)
    for i, factor in enumerate(factors):
        permuted = sets * factor
        out[:, 2 * i] = np.minimum.reduceat(permuted, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, which holds the band's number."""
    keys = np.empty((len(signature), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(signature), band + 1, np.uint64)
        for row in range(ROWS):
            key = mix(key * np.uint64(3) + signature[:, band * ROWS + row])
        keys[:, band] = key
    return keys


def stretches(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, total = [], 0
    for t in texts:
        if some and total + len(t) >= STRETCH:
            yield some
            some, total = [], 0
        some.append(t)
        total += len(t)
    if some:
        yield some


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def fingerprint(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``doc_id, hash, n_shingles, set_key, bands``: text hash, the set's 128-bit key, band keys (null for empty sets)."""
    schema = "doc_id long, hash long, n_shingles long, set_key binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in stretches(_texts(batch.column(2))):
                sets, places = shingle_sets(some, size)
                count = np.diff(places)
                full = np.flatnonzero(count)
                keys, bands = [None] * len(some), [None] * len(some)
                if len(full):
                    starts = places[:-1][full]
                    sums = [np.add.reduceat(mix(sets ^ np.uint64(s)), starts) for s in (0x9E37, 0x79B9)]
                    both = np.stack(sums, axis=1)
                    rows = band_keys(signatures(sets, starts)).view(np.int64).tolist()
                    for i, row, key in zip(full.tolist(), rows, both):
                        keys[i], bands[i] = key.tobytes(), row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(some)),
                        batch.column(1).slice(at, len(some)),
                        pa.array(count, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "hash", "n_shingles", "set_key", "bands"],
                )
                at += len(some)
        give_back()

    body = F.col(text).cast("string")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    return narrow.mapInArrow(run, schema)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``set_key, shingles`` of the documents (``doc_id, text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in stretches(_texts(batch.column(0))):
                sets, places = shingle_sets(some, size)
                full = np.flatnonzero(np.diff(places))
                if not len(full):
                    continue
                starts = places[:-1][full]
                sums = [np.add.reduceat(mix(sets ^ np.uint64(s)), starts) for s in (0x9E37, 0x79B9)]
                keys = [k.tobytes() for k in np.stack(sums, axis=1)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(starts, len(sets)), pa.int32()), pa.array(sets.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], ["set_key", "shingles"])
        give_back()

    return docs.select("text").mapInArrow(run, "set_key binary, shingles array<long>")


def _similar(a, b, both, percent: int):
    return F.lit(100) * both >= F.lit(percent) * (a + b - both)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` (pivot, member) on their full sets.

    ``a, b, a_n, b_n, both, bits`` (one for each of the pivot's shingles), ``extra`` (the member's others).
    """
    side = lambda c: sets.select(F.col("set_key").alias(c), F.col("shingles").alias(f"{c}_set"))
    joined = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            sides = []
            for c in ("a_set", "b_set"):
                values = column[c].values.to_numpy().view(np.uint64)
                offsets = column[c].offsets.to_numpy()
                sides.append([values[x:y] for x, y in zip(offsets, offsets[1:])])
            rows = []
            for pivot, member in zip(*sides):
                has = np.isin(pivot, member, assume_unique=True)
                other = member[~np.isin(member, pivot, assume_unique=True)]
                rows.append((len(pivot), len(member), int(has.sum()), np.packbits(has).tobytes(), other.view(np.int64)))
            a_n, b_n, both, bits, extra = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    column["a"],
                    column["b"],
                    *(pa.array(c, pa.int64()) for c in (a_n, b_n, both)),
                    pa.array(bits, pa.binary()),
                    pa.array(extra, pa.list_(pa.int64())),
                ],
                ["a", "b", "a_n", "b_n", "both", "bits", "extra"],
            )
        give_back()

    schema = "a binary, b binary, a_n long, b_n long, both long, bits binary, extra array<long>"
    return joined.select("a", "b", "a_set", "b_set").mapInArrow(run, schema)


def _crossing_links(own: pd.DataFrame, members: pd.DataFrame, percent: int) -> list[tuple[bytes, bytes]]:
    """Links from ``own`` members of one pivot to its ``members`` that join two components."""
    comps = pd.factorize(pd.concat([own["comp"], members["comp"]]))[0]
    parent = list(range(int(comps.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    def side(rows: pd.DataFrame) -> tuple:
        bits = np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), -1)
        return bits, rows["n"].to_numpy(), rows["extra"].map(len).to_numpy(), rows["b"].to_numpy(), rows["extra"].to_numpy()

    x_bits, x_n, x_extra, x_key, x_other = side(own)
    y_bits, y_n, y_extra, y_key, y_other = side(members)
    x_comp, y_comp = comps[: len(own)], comps[len(own) :]
    step = max(16, SIDE_BITS // (8 * x_bits.shape[1]))
    links = []
    for i in range(0, len(own), step):
        x = np.unpackbits(x_bits[i : i + step], axis=1).astype(np.float32)
        for j in range(0, len(members), step):
            y = np.unpackbits(y_bits[j : j + step], axis=1).astype(np.float32)
            both = (x @ y.T).astype(np.int64)
            most = both + np.minimum.outer(x_extra[i : i + step], y_extra[j : j + step])
            total = x_n[i : i + step, None] + y_n[None, j : j + step]
            near = 100 * most >= percent * (total - most)
            near &= x_comp[i : i + step, None] != y_comp[None, j : j + step]
            for r, c in zip(*np.nonzero(near)):
                p, q = find(x_comp[i + r]), find(y_comp[j + c])
                if p != q:
                    common = int(both[r, c]) + len(np.intersect1d(x_other[i + r], y_other[j + c], assume_unique=True))
                    if 100 * common >= percent * (int(total[r, c]) - common):
                        parent[max(p, q)] = min(p, q)
                        links.append((x_key[i + r], y_key[j + c]))
    return links


def links_beside_pivots(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of a pivot that join components which the pivots' own links leave apart."""
    named = lambda c: labels.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    placed = compared.join(named("b"), "b", "left").join(named("a"), "a", "left")
    placed = placed.withColumn("comp", F.coalesce("b_comp", "b"))
    placed = placed.withColumn("apart", F.col("comp") != F.coalesce("a_comp", "a"))
    groups = placed.groupBy("a").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("apart").cast("int")).alias("aparts"))
    groups = groups.filter("aparts > 0 and members > 1")
    open_ = materialize(placed.join(groups, "a").drop("a_comp", "b_comp", "both", "a_n"), "minhash-open")
    extras = open_.select("a", "b", F.explode("extra").alias("e"))
    shared = extras.groupBy("a", "e").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "e")
    shared = extras.join(shared, ["a", "e"]).groupBy("a", "b").agg(F.collect_set("e").alias("shared"))
    none = F.array().cast("array<long>")
    rows = open_.drop("extra").join(shared, ["a", "b"], "left").withColumn("extra", F.coalesce("shared", none))
    rows = materialize(rows.select("a", "b", F.col("b_n").alias("n"), "comp", "apart", "bits", "extra", "members", "aparts"), "minhash-open")

    # small pivots share a task; the blocks of a large one meet two by two
    tasks = max(1, ceil(rows.count() / TASK_ROWS))
    task = F.pmod(F.xxhash64("a"), F.lit(tasks)).alias("task")
    blocks = lambda c: F.ceil(F.col(c) / TASK_ROWS).cast("int")
    number = lambda c: F.pmod(F.xxhash64("b", F.lit(1)), blocks(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    kept = ["a", "b", "n", "comp", "bits", "extra"]
    own = rows.filter("apart").select(task, *kept, number("aparts").alias("x"), every("members").alias("y"))
    members = rows.select(task, *kept, number("members").alias("y"), every("aparts").alias("x"))

    def meet(own: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        links = []
        by_pivot = dict(list(members.groupby("a", sort=False)))
        for pivot, part in own.groupby("a", sort=False):
            if pivot in by_pivot:
                links += _crossing_links(part, by_pivot[pivot], percent)
        return pd.DataFrame(links, columns=["a", "b"])

    keys = ["task", "x", "y"]
    return own.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(meet, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node reachable from each node of ``a, b`` links.

    Links are few next to the documents, and every round is some small shuffles: these have as many partitions
    as the links need, not as many as the texts.
    """
    links = materialize(links, "components-links")
    many = max(1, ceil(links.count() / LINK_ROWS))
    ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ways = materialize(ways.repartition(many, "a"), "components-ways")
    dealt = lambda df, key: df.repartition(many, key)
    first = dealt(ways, "a").groupBy("a").agg(F.min("b").alias("low"))
    labels = materialize(first.select(F.col("a").alias("node"), F.least("a", "low").alias("comp")), "components-labels")
    while True:
        named = dealt(labels.select(F.col("node").alias("b"), "comp"), "b")
        near = dealt(dealt(ways, "b").join(named, "b"), "a").groupBy("a").agg(F.min("comp").alias("low"))
        lower = dealt(labels, "node").join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("comp", "low").alias("comp"), F.col("comp").alias("was")
        )
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        step = dealt(lower, "comp").join(dealt(jump, "comp"), "comp", "left").select(
            "node", F.least(F.col("comp"), F.coalesce("further", "comp")).alias("comp"), "was"
        )
        step = materialize(step, "components-labels")
        labels = step.select("node", "comp")
        if step.filter("comp != was").isEmpty():
            return labels


def _with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.withColumnRenamed("node", "set_key")
    return members.join(named, "set_key", "left").withColumn("comp", F.coalesce("comp", "set_key"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, hash`` (of the text), ``n_shingles, component_id, kept`` for every row of ``docs``."""
    prints = materialize(fingerprint(docs, doc_id, text, size), "minhash-prints")
    sized = prints.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = sized.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")
    )
    entries = classes.select("set_key", "rep", F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    full = materialize(full, "minhash-full")
    shared = materialize(entries.join(full, "bucket"), "minhash-buckets")

    # the pivot of a bucket meets the most others in all of its buckets; a class takes the best pivot of its buckets
    degree = shared.groupBy("set_key").agg(F.sum("members").alias("degree"))
    ranked = shared.select("bucket", "set_key").join(degree, "set_key")
    pivots = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "set_key")).alias("pivot"))
    members = shared.select("bucket", "set_key").join(pivots, "bucket")
    best = members.groupBy("set_key").agg(F.max("pivot").alias("best"))
    members = materialize(members.join(best, "set_key"), "minhash-members")
    star = members.select(F.col("best.set_key").alias("a"), F.col("set_key").alias("b")).filter("a != b").distinct()
    star = materialize(star, "minhash-star")
    release(docs.sparkSession)
    wanted = shared.select(F.col("rep").alias("doc_id"), "set_key").distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.join(wanted.select("doc_id").hint("merge"), "doc_id", "left_semi")
    sets = full_sets(texts, size).join(wanted.select("set_key"), "set_key", "left_semi").dropDuplicates(["set_key"])
    sets = materialize(sets, "minhash-sets")
    release(docs.sparkSession)
    near = _similar(F.col("a_n"), F.col("b_n"), F.col("both"), percent)
    compared = materialize(compare(star, sets), "minhash-compared")
    release(docs.sparkSession)
    labels = components(compared.filter(near).select("a", "b"))

    # buckets with several components and no pivot common to all members
    placed = _with_component(members, labels)
    other = (F.col("set_key") != F.col("ref.set_key")) & (F.col("best.set_key") != F.col("ref.set_key"))
    refs = members.groupBy("bucket").agg(F.max("best").alias("ref"))
    loose = placed.join(refs, "bucket").groupBy("bucket").agg(
        F.min("comp").alias("x"), F.max("comp").alias("y"), F.max(other).alias("other")
    )
    loose = loose.filter("other and x != y").select("bucket")
    again = members.join(loose, "bucket", "left_semi").select(F.col("pivot.set_key").alias("a"), F.col("set_key").alias("b"))
    again = materialize(again.filter("a != b").distinct().join(star, ["a", "b"], "left_anti"), "minhash-star")
    if not again.isEmpty():
        compared = materialize(compared.union(compare(again, sets)), "minhash-compared")
        release(docs.sparkSession)
        labels = components(compared.filter(near).select("a", "b"))
    links = compared.filter(near).select("a", "b")
    more = materialize(links_beside_pivots(compared, labels, percent), "minhash-links")
    if not more.isEmpty():
        labels = components(links.union(more))

    placed = _with_component(prints.select("doc_id", "hash", "n_shingles", "set_key"), labels)
    lowest = placed.filter(F.col("doc_id").isNotNull() & F.col("comp").isNotNull())
    lowest = lowest.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    lowest = materialize(lowest, "minhash-lowest")  # as a table, so that the join below can split a hot component
    linked = F.when(F.col("doc_id").isNotNull(), F.col("comp"))
    named = placed.withColumn("comp", linked).join(lowest, "comp", "left")
    return named.select(
        "doc_id", "hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component; of rows repeated with id and text, one."""
    found = near_duplicates(docs, doc_id, text, size, percent)
    gone_id, gone_hash, own_hash = unused(docs, "__gone_id", "__gone_hash", "__hash")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id), F.col("hash").alias(gone_hash))
    rows = docs.withColumn(own_hash, F.xxhash64(F.col(text).cast("string")))
    same = (F.col(doc_id).cast("long") == F.col(gone_id)) & (F.col(own_hash) == F.col(gone_hash))
    left = rows.join(gone.distinct(), same, "left_anti")
    return left.dropDuplicates([doc_id, own_hash]).drop(own_hash)
