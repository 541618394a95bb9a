"""Document fingerprints by order MinHash, in DataFrame functions only.

A text is cut into words.  Runs without white space of more than ``RUN`` code points are cut at places that
their content chooses, so that an edit changes the words beside it and no others: after each
printable ASCII character whose code divides by four, and around every other code point.  Its k-mers
are ``KMER`` consecutive words, and each k-mer is numbered by its occurrence in the text.
A hash of (k-mer, occurrence) puts it into one of ``BINS`` bins; each bin keeps its
``KEEP`` smallest hashes, puts them back into text order and hashes that tuple.  The
tuples of the bins are the signature.  Equal tuples mean the same k-mers in the same
order, so the share of equal bins falls with the edit distance and not only with the
overlap.  One hash evaluation a k-mer serves all bins.

With ``whole`` every bin is a slot of its own over all k-mers of the text: a slot's order is that
of the hashes less the bin's first value, modulo 2^64, so its smallest are the next ones on the
ring of hashes, from later bins where its own has too few.  All 64 slots of a text with two
k-mers hold an order then, however short it is; slots of a short text share tuples, which
widens the spread of its likeness but not its mean.  Without ``whole`` a bin with one k-mer
holds no order.

Inside a row, hashes carry their place in their low bits, so that two sorts of plain
longs give runs of equal k-mers (the occurrence numbers) and the smallest of each bin.

The successor of each document in descending id order comes from a range-partitioned
narrow table: neighbours inside a partition by a window, across partitions by the table
of first rows (one a partition).  Texts are shuffled once by document (both joins read that
shuffle), and once more what the predecessor needs: a stretch of text and the signature, which is
made a second time there, as that is cheaper on disk than to shuffle all signatures for a join.

Edge cases: very long texts are taken whole, an expression holding all of their words; a null or empty text has an empty fingerprint, equal to other empty ones
(likeness 1) and unlike all others (0); a text with fewer words than a k-mer is one
k-mer; rows repeated with id and text are one document in the order and each get a row;
documents that share an id are ordered by text hash, those without an id come last; a
single document follows itself; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize

KMER = 2
RUN = 16
BINS = 64
KEEP = 2
#: Low bits of a packed hash that hold the place in the text.
PLACE_BITS = 28
PLACE = (1 << PLACE_BITS) - 1
BIN_SHIFT = 64 - (BINS.bit_length() - 1)

_SPACE = r" \t\n\x0b\f\r"
_LAST, _OTHER = ("".join(re.escape(chr(c)) for c in range(33, 127) if (c % 4 == 0) == last) for last in (True, False))
#: A whole word, or a part of a longer run.
WORD = rf"(?<![^{_SPACE}])[^{_SPACE}]{{1,{RUN}}}(?![^{_SPACE}])|[{_OTHER}]*[{_LAST}]|[{_OTHER}]+|[^{_SPACE}!-~]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(hash_: Column, place: Column) -> Column:
    return hash_.bitwiseAND(F.lit(~PLACE)).bitwiseOR(place.cast("long").bitwiseAND(F.lit(PLACE)))


def _kmer(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, BIN_SHIFT)


def _kmers(words: Column) -> Column:
    """Packed hashes of a text's k-mers, sorted."""
    n = F.size(words)
    rolling = F.transform(
        F.sequence(F.lit(0), n - KMER),
        lambda i: _packed(F.xxhash64(*[F.get(words, i + j) for j in range(KMER)]), i),
    )
    whole = F.array(_packed(F.xxhash64(words), F.lit(0)))
    none = F.array().cast("array<long>")
    return F.sort_array(F.when(n >= KMER, rolling).when(n > 0, whole).otherwise(none))


def _numbered(kmers: Column) -> Column:
    """Packed hashes of (k-mer, occurrence number), sorted; ``kmers`` sorted."""
    n = F.size(kmers)
    opens = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (_kmer(F.get(kmers, i)) != _kmer(F.get(kmers, i - 1))),
    )

    def number(opens: Column) -> Column:
        runs = F.transform(
            opens,
            lambda a, j: F.transform(
                F.sequence(a, F.coalesce(F.get(opens, j + 1), n) - 1),
                lambda p: _packed(F.xxhash64(_kmer(F.get(kmers, a)), p - a), F.get(kmers, p).bitwiseAND(F.lit(PLACE))),
            ),
        )
        return F.sort_array(F.flatten(runs))

    return F.when(n > 0, let(opens, number)).otherwise(kmers)


def _tuples(numbered: Column, whole: bool = False) -> Column:
    """``bin << 32 | hash of the bin's smallest in text order`` for each bin that has any; ``whole``: for each slot."""
    low = F.filter(
        numbered, lambda x, i: (i < KEEP) | (_bin(x) != _bin(F.get(numbered, i - KEEP)))
    )

    def hash_bins(low: Column) -> Column:
        heads = F.filter(
            F.transform(low, lambda x, i: F.when((i == 0) | (_bin(x) != _bin(F.get(low, i - 1))), i)),
            lambda i: i.isNotNull(),
        )

        def one(i: Column, own: Column) -> Column:
            # place first, for the sort; then the hash alone
            ordered = F.sort_array(
                F.transform(
                    own,
                    lambda x: F.shiftleft(x.bitwiseAND(F.lit(PLACE)), 63 - PLACE_BITS).bitwiseOR(
                        F.shiftrightunsigned(x, PLACE_BITS + 1)
                    ),
                )
            )
            mask = F.lit((1 << (63 - PLACE_BITS)) - 1)
            hashed = F.xxhash64(F.transform(ordered, lambda y: y.bitwiseAND(mask)))
            return F.shiftrightunsigned(hashed, 32)

        def own_bin(i: Column) -> Column:
            own = F.filter(F.slice(low, i + 1, KEEP), lambda x: _bin(x) == _bin(F.get(low, i)))
            return F.shiftleft(_bin(F.get(low, i)), 32).bitwiseOR(one(i, own))

        def slots(i: Column, j: Column, heads: Column) -> Column:
            """The head's tuple for its bin and the empty ones before it, around the ring."""
            size = F.size(low)
            ring = F.transform(F.sequence(F.lit(0), F.least(F.lit(KEEP), size) - 1), lambda k: F.get(low, F.pmod(i + k, size)))
            before = F.get(heads, F.pmod(j - 1, F.size(heads)))
            gap = F.pmod(_bin(F.get(low, i)) - _bin(F.get(low, before)) - 1, F.lit(BINS)).cast("int")
            fill = F.sequence(F.lit(0), gap)
            at = lambda k: F.shiftleft(F.pmod(_bin(F.get(low, i)) - k, F.lit(BINS)), 32)
            return let(one(i, ring), lambda t: F.transform(fill, lambda k: at(k).bitwiseOR(t)))

        if whole:
            return let(heads, lambda h: F.flatten(F.transform(h, lambda i, j: slots(i, j, h))))
        return F.transform(heads, own_bin)

    return let(low, hash_bins)


def order_minhash(text: Column | str, whole: bool = False) -> Column:
    """``array<long>``: the signature's tuples, one a bin in use, with the bin's number in the high bits.

    ``whole``: one a slot, each from all k-mers of the text.
    """
    text = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return let(words, lambda w: let(_kmers(w), lambda k: let(_numbered(k), lambda n: _tuples(n, whole))))


def fingerprint(tuples: Column | str) -> Column:
    """The signature as hexadecimal digits, ten a bin in use."""
    tuples = F.col(tuples) if isinstance(tuples, str) else tuples
    return F.lower(F.array_join(F.transform(tuples, lambda t: F.hex(t + F.lit(BINS << 32))), ""))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal tuples among the bins that either signature uses; 1 for two empty ones."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    bins = F.array_union(F.transform(a, lambda t: F.shiftright(t, 32)), F.transform(b, lambda t: F.shiftright(t, 32)))
    return F.when(F.size(bins) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(bins))


def successors(docs: DataFrame) -> DataFrame:
    """``doc_id, hash, n_chars, next_id, next_hash`` for each document (``doc_id, hash, n_chars``), descending, in a ring."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").asc()]
    single = docs.groupBy("doc_id", "hash").agg(F.first("n_chars").alias("n_chars"))
    ranged = materialize(single.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "omh-order")
    within = Window.partitionBy("part").orderBy(*order)
    here = F.struct(F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"))
    led = ranged.withColumn("next", F.lead(here).over(within)).withColumn("at", F.row_number().over(within))
    heads = led.filter("at = 1").select("part", here.alias("head"))  # one row a partition
    by_part = Window.orderBy("part")
    first = F.first("head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select("part", F.coalesce(F.lead("head").over(by_part), first).alias("after"))
    joined = led.join(after, "part").withColumn("next", F.coalesce("next", "after"))
    return joined.select("doc_id", "hash", "n_chars", "next.next_id", "next.next_hash")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Signatures (``whole``: see above) of each text and of its edited text.

    ``doc_id, n_chars, edited_sha256, tuples, edited_tuples, near_edited, near_next``.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    links = successors(rows.select("doc_id", "hash", F.char_length("text").alias("n_chars")))

    same = lambda a, b, names: a.join(
        b, F.col("doc_id").eqNullSafe(F.col(names[0])) & (F.col("hash") == F.col(names[1]))
    )
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # what the predecessor takes from each document
    taken = same(rows, links.withColumnsRenamed({"doc_id": "x_id", "hash": "x_hash"}), ("next_id", "next_hash"))
    taken = taken.select(
        "x_id",
        "x_hash",
        "n_chars",
        F.substring(F.col("text"), F.lit(1), third).alias("taken"),
        order_minhash("text", whole).alias("next_tuples"),
    ).dropDuplicates(["x_id", "x_hash"])
    edited = same(rows, taken, ("x_id", "x_hash")).select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "next_tuples",
        "text",
        F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars") - third), "taken").alias("edited"),
    )
    printed = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash("text", whole).alias("tuples"),
        order_minhash("edited", whole).alias("edited_tuples"),
        "next_tuples",
    )
    return printed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "tuples",
        "edited_tuples",
        likeness("tuples", "edited_tuples").alias("near_edited"),
        likeness("tuples", "next_tuples").alias("near_next"),
    )
