"""Word vectors that repeat: skip-gram on shards by content, averaged after each pass.

Spark's Word2Vec keeps all word vectors on the driver and, with several partitions, gives other vectors
each time.  Here the vectors are a table (one row a word) and so is what the documents get:

1. Content tokens are counted; words seen ``min_count`` times start at a hash of the word, the seed and the component,
   ``(h - 2^31) / (dim 2^32)`` with ``h`` from MD5, so that any engine gives the same start.
2. Texts are cut into windows of ``WINDOW_TOKENS`` tokens.  Equal windows are counted, numbered and dealt to shards by a
   hash of content and number: a third of all rows may be one text.  The number of shards follows the tokens
   (``shard_tokens``), never the cluster.
3. In each pass a task trains the shards of a group one after another (each in the order of that hash), every one on its own copy of the
   vectors of its words: negative sampling, with the pairs at one distance of a stretch of text worked on together.  The first
   pass's start needs no sending, as the task hashes its words; later an equi-join brings a group's vectors, once for all of its shards.
4. A word's new vector is the mean over the shards that hold it.  Vectors are whole multiples of ``2^-UNIT_BITS``, so sums are
   exact in whatever order they are made, and a group sends one sum a word.

So two runs give equal vectors on any number of cores and with any layout of the input (on the same kind of processor and
library: one shard's arithmetic is single precision).  A task holds the tokens of at most ``SHARDS_A_TASK`` shards and the vectors of their words; the
driver holds nothing but the number of shards.  Each pass's vectors are written in the shared folder, and the ones before are removed.

A document's vector is the sum of its known words' vectors over the number of its content tokens, as with Spark's.  With
``passes=0`` the words keep their hashed start: random indexing, which needs no training.

Edge cases: null texts, and texts of stop words or rare words only, have no part in training and the zero vector; an empty
text has one empty token, as Spark's tokenizer gives it; equal rows get a row each; an empty table gives no words and no rows; other columns of the input may have any name that
does not start with ``wv__``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import md5
from math import ceil, sin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.operators.text import DEFAULT_DIM, DEFAULT_MIN_COUNT, DEFAULT_W2V_SEED, content_col, tokenize
from reviewlens.session import release, remove_path, shared_path, written

#: Vectors are whole multiples of 2^-UNIT_BITS, below 2^LIMIT_BITS in size.
UNIT_BITS = 30
LIMIT_BITS = 8
WINDOW_TOKENS = 1000
SHARD_TOKENS = 150_000
#: Copies of a window that one row stands for until they are dealt.
COPIES = 1000
#: Tokens on whose vectors one step works, farthest pair, negatives a step, negatives a pair, and step size.
STEP = 128
REACH = 5
NEGATIVES = 64
PER_PAIR = 5
RATE = 0.05
#: Tasks that train, for a core, and the shards that one takes at most; code points of the texts that a task embeds at most, and where
#: there are fewer texts than that for every core; tokens whose vectors it adds at once.
TASKS_A_CORE = 2
SHARDS_A_TASK = 16
BLOCK_CHARS = 24_000_000
SMALL_BLOCK_CHARS = 3_000_000
STRETCH = 1 << 14
#: MD5: words hashed at once, first state, constants and shifts.
MD5_WORDS = 512
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_SINES = [np.uint32(int(abs(sin(i + 1)) * 2**32)) for i in range(64)]
MD5_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))


def hashed_units(words: Sequence[str], dim: int, seed: int) -> np.ndarray:
    """The vectors that words start from, in units, a row each: ``floor((h - 2^31) 2^UNIT_BITS / (dim 2^32))`` with ``h`` the first four
    bytes of the MD5 of ``word:seed:component``.

    Words of one length are hashed side by side; those that need a second block of MD5 by the standard library.
    """
    ends = [str(i).encode() for i in range(dim)]
    heads = [f"{w}:{seed}:".encode() for w in words]
    sizes = np.fromiter(map(len, heads), np.int64, len(heads))
    units = np.empty((len(heads), dim), np.int64)
    scale = float(1 << UNIT_BITS) / (dim * float(1 << 32))
    order = np.argsort(sizes, kind="stable")
    for first in range(0, len(order), MD5_WORDS):
        some = order[first : first + MD5_WORDS]
        for size in np.unique(sizes[some]):
            rows = some[sizes[some] == size]
            if size + len(ends[-1]) <= 55:
                h = _md5_heads(np.frombuffer(b"".join(heads[r] for r in rows), np.uint8).reshape(len(rows), size), ends)
            else:
                h = np.array([[int.from_bytes(md5(heads[r] + e).digest()[:4], "big") for e in ends] for r in rows])
            units[rows] = np.floor((h.astype(np.int64) - (1 << 31)) * scale).astype(np.int64)
    return units


def _md5_heads(heads: np.ndarray, ends: Sequence[bytes]) -> np.ndarray:
    """First four bytes, as a number, of the MD5 of each head (a row of bytes) with each end: one block a message."""
    count, size = heads.shape
    blocks = np.zeros((count, 64), np.uint8)
    blocks[:, :size] = heads
    tails = np.zeros((len(ends), 64), np.uint8)
    for tail, end in zip(tails, ends):
        tail[size : size + len(end) + 1] = np.frombuffer(end + b"\x80", np.uint8)
        tail[56:64] = np.frombuffer((8 * (size + len(end))).to_bytes(8, "little"), np.uint8)
    blocks, tails = blocks.view("<u4"), tails.view("<u4")
    # a message's words: those that its end has no part in are the same for all ends
    words = [blocks[:, g, None] | tails[:, g] if tails[:, g].any() else blocks[:, g, None] for g in range(16)]
    a, b, c, d = (np.full((count, len(ends)), v, np.uint32) for v in MD5_START)
    mixed, moved = np.empty_like(a), np.empty_like(a)
    for i in range(61):  # the last three rounds do not change the first four bytes
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=mixed)
            mixed &= b
            mixed ^= d
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=mixed)
            mixed &= d
            mixed ^= c
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=mixed)
            mixed ^= d
        else:
            g = 7 * i % 16
            np.bitwise_not(d, out=mixed)
            mixed |= b
            mixed ^= c
        mixed += a
        mixed += words[g] + MD5_SINES[i]
        left = MD5_SHIFTS[i // 16][i % 4]
        np.left_shift(mixed, np.uint32(left), out=moved)
        mixed >>= np.uint32(32 - left)
        moved |= mixed
        moved += b
        a, b, c, d, moved = d, moved, b, c, a
    return (b + np.uint32(MD5_START[0])).byteswap()


def hashed_words(words: DataFrame, dim: int, seed: int) -> DataFrame:
    """``token, n`` and the vectors that the words start from."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = hashed_units(batch.column("token").to_pylist(), dim, seed)
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("n"), _lists(units)], ["token", "n", "units"])

    return words.select("token", "n").mapInArrow(add, "token string, n long, units array<long>")


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())


def windows(df: DataFrame, text_col: str) -> DataFrame:
    """``tokens, n``: the different windows of content tokens, and how often each occurs."""
    tokens = F.col(content_col(text_col))
    starts = F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / WINDOW_TOKENS).cast("int"))
    cut = F.transform(starts, lambda i: F.slice(tokens, i * WINDOW_TOKENS + 1, WINDOW_TOKENS))
    rows = tokenize(df.select(text_col).filter(F.col(text_col).isNotNull()), text_col, stop_words=True)
    return rows.filter(F.size(tokens) > 0).select(F.explode(cut).alias("tokens")).groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))


def deal(counted: DataFrame, shards: int) -> DataFrame:
    """``tokens, order, shard``: a row for each copy of a window, dealt by content and the copy's number."""
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("long"))))
    first = F.col("block") * COPIES
    copies = F.sequence(first, F.least(first + COPIES, F.col("n")) - 1)
    dealt = blocks.select("tokens", F.explode(copies).alias("copy"))
    order = F.xxhash64("tokens", "copy")
    return dealt.select("tokens", order.alias("order"), F.pmod(order, F.lit(shards)).cast("int").alias("shard"))


def train_word_vectors(
    df: DataFrame,
    text_col: str,
    dim: int = DEFAULT_DIM,
    min_count: int = DEFAULT_MIN_COUNT,
    seed: int = DEFAULT_W2V_SEED,
    passes: int = 1,
    shard_tokens: int = SHARD_TOKENS,
) -> tuple[DataFrame, str]:
    """(``token, n, units``: each word's count and vector in units, the written table's path)."""
    spark = df.sparkSession
    texts_path, held_path, path = (shared_path(spark, f"word-{name}") for name in ("windows", "held", "vectors"))
    texts = written(windows(df, text_col), texts_path)  # texts are read and cut into tokens once
    if not passes:
        counts = texts.select("n", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("n"))
        table = written(hashed_words(counts.filter(F.col("n") >= min_count), dim, seed), path)
        remove_path(spark, texts_path)
        return table, path
    total = texts.agg(F.sum(F.size("tokens") * F.col("n"))).first()[0] or 0
    shards = max(1, ceil(total / shard_tokens))
    # a task trains the shards of a group one after another, and a word's vectors come and go once a group: a few groups a core and no
    # more, each of a bounded number of shards.  Sums are exact, so that groups change no vector
    groups = min(shards, max(ceil(shards / SHARDS_A_TASK), TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    dealt = deal(texts, shards).withColumn("home", F.col("shard") % groups)
    held = dealt.select("home", F.explode("tokens").alias("token")).groupBy("home", "token").agg(F.count(F.lit(1)).alias("m"))
    known = F.sum("m").over(Window.partitionBy("token")) >= min_count
    held = written(held.select("home", "token", known.alias("known")).filter("known").drop("known"), held_path)
    release(spark)
    table = None
    dealt = dealt.repartitionById(groups, "home")  # by hash some tasks would get several groups and others none
    for turn in range(passes):
        # vectors start at hashes of the words and contexts at zero, which need no sending, and nothing reads the contexts of the last pass
        wanted = ["units", "out"] if turn < passes - 1 else ["units"]
        theirs = (held.join(packed(table, ["units", "out"]), "token") if turn else held).repartitionById(groups, "home")
        train = _group_trainer(seed, turn, passes, dim, wanted)
        schema = ", ".join(["token string, k long, n long", *(f"{c} binary" for c in wanted)])
        trained = dealt.groupBy("home").cogroup(theirs.groupBy("home")).applyInArrow(train, schema)
        sorted_sums = trained.repartition("token").sortWithinPartitions("token")
        schema = ", ".join(["token string, n long", *(f"{c} array<long>" for c in wanted)])
        new_path = shared_path(spark, "word-vectors")
        new = written(sorted_sums.mapInArrow(_means(dim, wanted), schema), new_path)
        if turn:
            remove_path(spark, path)
        table, path = new, new_path
        del theirs, trained, sorted_sums  # nothing holds their shuffles then
        release(spark)
    remove_path(spark, texts_path)
    remove_path(spark, held_path)
    return table, path


def packed(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``token`` and the vectors of ``columns``, three bytes a component or as many as the vector's largest needs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [_packed_rows(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column("token"), *vectors], ["token", *columns])

    schema = ", ".join(["token string", *(f"{c} binary" for c in columns)])
    return table.select("token", *columns).mapInArrow(pack, schema)


def _packed_rows(units: np.ndarray) -> pa.Array:
    largest = np.maximum(units, ~units).max(axis=1, initial=0)
    widths = 3 + sum((largest >> (8 * w - 1) > 0).astype(int) for w in range(3, 8))
    rows: list[bytes] = [b""] * len(units)
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        shifted = (units[some] + (1 << (8 * int(width) - 1))).astype("<i8").view(np.uint8).reshape(len(some), -1, 8)
        for row, vector in zip(some.tolist(), shifted[:, :, :width]):
            rows[row] = vector.tobytes()
    return pa.array(rows, pa.binary())


def unpacked(vectors: Sequence[bytes], dim: int) -> np.ndarray:
    """Vectors in units, a row each, from ``packed`` bytes."""
    widths = np.fromiter(map(len, vectors), np.int64, len(vectors)) // dim
    units = np.empty((len(vectors), dim), np.int64)
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        rows = np.zeros((len(some), dim, 8), np.uint8)
        rows[:, :, :width] = np.frombuffer(b"".join(vectors[i] for i in some.tolist()), np.uint8).reshape(len(some), dim, width)
        units[some] = rows.view("<i8")[:, :, 0] - (1 << (8 * int(width) - 1))
    return units


def _group_trainer(
    seed: int, turn: int, passes: int, dim: int, wanted: Sequence[str]
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A function that trains the shards of a group and returns, for each of its words, how many shards hold it, how often it occurs,
    and the sums of the ``wanted`` vectors over the shards."""
    unit, top = np.float64(1 << UNIT_BITS), float(1 << LIMIT_BITS)

    def in_singles(units: np.ndarray) -> np.ndarray:
        return (units / unit).astype(np.float32)

    def train(texts: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("token")
        token = words.column("token").combine_chunks()
        moved = {c: np.zeros((len(token), dim), np.int64) for c in wanted}
        k, n = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
        start = {c: np.empty((len(token), dim), np.float32) for c in ("units", "out") if turn or c == "units"}
        for at in range(0, len(token), STRETCH):
            for c, vectors in start.items():
                some = words.column(c).slice(at, STRETCH).to_pylist() if turn else token.slice(at, STRETCH).to_pylist()
                vectors[at : at + STRETCH] = in_singles(unpacked(some, dim) if turn else hashed_units(some, dim, seed))
        shard, order = texts.column("shard").to_numpy(), texts.column("order").to_numpy()
        tokens = texts.column("tokens").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
        ids = pc.fill_null(pc.index_in(pc.list_flatten(tokens), value_set=token), -1).to_numpy()
        ends = np.cumsum(sizes)
        rows = np.lexsort((order, shard))
        for number in np.unique(shard):
            mine = rows[shard[rows] == number]
            own = np.concatenate([ids[ends[r] - sizes[r] : ends[r]] for r in mine])
            owner = np.repeat(np.arange(len(mine)), sizes[mine])[own >= 0]
            held, own, times = np.unique(own[own >= 0], return_inverse=True, return_counts=True)
            if not len(held):
                continue
            x = start["units"][held]
            y = start["out"][held] if turn else np.zeros_like(x)
            rng = np.random.default_rng([seed, turn, int(number)])
            skip_gram(own, owner, x, y, times, rng, turn / passes, 1 / passes)
            for c, vectors in (("units", x), ("out", y)):
                if c in moved:
                    moved[c][held] += np.rint(np.clip(vectors, -top, top).astype(np.float64) * unit).astype(np.int64)
            k[held] += 1
            n[held] += times
        out = []
        for at in range(0, len(token), STRETCH):
            some = slice(at, at + STRETCH)
            out.append(
                pa.RecordBatch.from_arrays(
                    [token.slice(at, STRETCH), pa.array(k[some]), pa.array(n[some]), *(_packed_rows(moved[c][some]) for c in wanted)],
                    ["token", "k", "n", *wanted],
                )
            )
        types = [("token", pa.string()), ("k", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in wanted)]
        return pa.Table.from_batches(out, pa.schema(types))

    return train


def _means(dim: int, wanted: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that adds up the rows of each word, which follow each other, and divides by the number of shards, towards zero."""

    def row(token: list[str], k: np.ndarray, n: np.ndarray, sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        means = [np.sign(s) * (np.abs(s) // k[:, None]) for s in sums.values()]
        return pa.RecordBatch.from_arrays([pa.array(token, pa.string()), pa.array(n), *map(_lists, means)], ["token", "n", *sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the word whose rows may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column("token").to_pylist()
            first = np.flatnonzero([i == 0 or t != token[i - 1] for i, t in enumerate(token)])
            k, n = (np.add.reduceat(batch.column(c).to_numpy(), first) for c in ("k", "n"))
            sums = {c: np.add.reduceat(unpacked(batch.column(c).to_pylist(), dim), first, axis=0) for c in wanted}
            token = [token[i] for i in first]
            if last is not None and last[0][0] == token[0]:
                k[0] += last[1][0]
                n[0] += last[2][0]
                for c in wanted:
                    sums[c][0] += last[3][c][0]
            elif last is not None:
                yield row(*last)
            if len(token) > 1:
                yield row(token[:-1], k[:-1], n[:-1], {c: s[:-1] for c, s in sums.items()})
            last = token[-1:], k[-1:], n[-1:], {c: s[-1:] for c, s in sums.items()}
        if last is not None:
            yield row(*last)

    return run


def skip_gram(
    ids: np.ndarray, owner: np.ndarray, x: np.ndarray, y: np.ndarray, counts: np.ndarray, rng: np.random.Generator,
    done: float = 0.0, share: float = 1.0,
) -> None:
    """One pass over the words ``ids`` of the windows ``owner``; changes the vectors ``x`` (words) and ``y`` (contexts).

    A pair stands at most a random reach apart, drawn for its centre, within one window.  Each step works on the pairs whose first
    word lies in a stretch of ``STEP`` words and on ``NEGATIVES`` words drawn by count^0.75 for all of its pairs; a word that occurs m times in a
    step moves by its summed gradient over sqrt(m).
    """
    drawn = np.cumsum(counts.astype(np.float64) ** 0.75)
    longest = STEP + REACH
    # a row a gap and direction: dot products, and 1 where the pair counts
    products, counted = (np.zeros((2 * REACH, longest), np.float32) for _ in range(2))
    moves = np.empty((longest, x.shape[1]), np.float32)
    for at in range(0, len(ids), STEP):
        w, own = ids[at : at + longest], owner[at : at + longest]
        size = len(w)
        rate = np.float32(RATE * max(1e-4, 1 - done - share * at / len(ids)))
        reach = rng.integers(1, REACH + 1, size)
        a, b = x.take(w, axis=0), y.take(w, axis=0)
        sides = []  # (row, centre, context)
        for gap in range(1, min(REACH, size - 1) + 1):
            left, right = slice(0, size - gap), slice(gap, size)
            sides += [(2 * gap - 2, left, right), (2 * gap - 1, right, left)]
        products.fill(0)
        counted.fill(0)
        for row, centre, context in sides:
            gap = row // 2 + 1
            near = own[:-gap] == own[gap:]
            near[STEP:] = False
            np.einsum("ij,ij->i", a[centre], b[context], out=products[row, centre])
            counted[row, centre] = near & (reach[centre] >= gap)
        pulls = counted / (1 + np.exp(np.clip(products, -30, 30)))
        pairs = counted.sum(axis=0)[:size]
        move_a, move_b = np.zeros_like(a), np.zeros_like(b)
        for row, centre, context in sides:
            pull, some = pulls[row, centre, None], moves[: centre.stop - centre.start]
            move_a[centre] += np.multiply(pull, b[context], out=some)
            move_b[context] += np.multiply(pull, a[centre], out=some)
        others = np.searchsorted(drawn, rng.random(NEGATIVES) * drawn[-1], side="right").clip(0, len(drawn) - 1)
        c = y.take(others, axis=0)
        push = pairs[:, None] * np.float32(PER_PAIR / NEGATIVES) / (1 + np.exp(np.clip(-(a @ c.T), -30, 30)))
        move_a -= push @ c
        _add_by_word(x, w, move_a, rate)
        _add_by_word(y, np.concatenate([w, others]), np.concatenate([move_b, -(push.T @ a)]), rate)


def _add_by_word(vectors: np.ndarray, words: np.ndarray, moves: np.ndarray, rate: np.float32) -> None:
    order = words.argsort(kind="stable")
    found = words.take(order)
    ends = np.ones(len(words) + 1, bool)
    np.not_equal(found[1:], found[:-1], out=ends[1:-1])
    ends = ends.nonzero()[0]
    first, times = ends[:-1], ends[1:] - ends[:-1]
    sums = moves.take(order.take(first), axis=0)
    twice, more = (times == 2).nonzero()[0], (times > 2).nonzero()[0]
    if len(twice):  # most words occur once or twice: plain additions are the faster ones
        sums[twice] += moves.take(order.take(first[twice] + 1), axis=0)
    if len(more):
        rows = np.concatenate([order[i : i + m] for i, m in zip(first[more].tolist(), times[more].tolist())])
        sums[more] = np.add.reduceat(moves.take(rows, axis=0), np.cumsum(times[more]) - times[more], axis=0)
    sums *= rate
    sums /= np.sqrt(times)[:, None].astype(np.float32)
    found = found.take(first)
    sums += vectors.take(found, axis=0)
    vectors[found] = sums


def embed_by_words(
    df: DataFrame, vectors: dict[str, DataFrame], dim: int, keep: Sequence[str], out: str = "features"
) -> DataFrame:
    """``keep`` columns plus the document vector ``out``: the vectors of the text columns side by side.

    ``vectors`` has the words of each text column.  Different texts are embedded once, in blocks, by exact sums, and joined by two
    hashes.
    """
    rows = df.select(*keep, *[k.alias(f"wv__{i}_{j}") for i, c in enumerate(vectors) for j, k in enumerate(_text_key(c))])
    for i, (column, table) in enumerate(vectors.items()):
        mine = [f"wv__{i}_0", f"wv__{i}_1"]
        found = document_vectors(df, column, table, dim).withColumnsRenamed({"a": mine[0], "b": mine[1], "vector": f"wv__{i}"})
        rows = rows.join(found, mine, "left")
    zero = F.array_repeat(F.lit(0.0), dim)
    parts = F.concat(*[F.coalesce(F.col(f"wv__{i}"), zero) for i in range(len(vectors))])
    return rows.select(*keep, array_to_vector(parts).alias(out))


def _text_key(column: str) -> tuple[Column, Column]:
    return F.xxhash64(column), F.xxhash64(F.lit("text"), column)


def document_vectors(df: DataFrame, column: str, vectors: DataFrame, dim: int) -> DataFrame:
    """``a, b, vector`` for each different text that has a known word; ``a, b`` is the text's key.

    Texts are dealt to blocks of about ``BLOCK_CHARS`` code points, by key.  A block gets the vectors of its own words once and adds them up in
    one task, so neither sums nor copies of vectors multiply by documents, and a task holds one block.
    """
    a, b = _text_key(column)
    present = df.filter(F.col(column).isNotNull())
    chars = present.agg(F.sum(F.length(column))).first()[0] or 0
    few = min(df.sparkSession.sparkContext.defaultParallelism, ceil(chars / SMALL_BLOCK_CHARS))
    blocks = max(1, few, ceil(chars / BLOCK_CHARS))
    texts = present.select(a.alias("a"), b.alias("b"), column).dropDuplicates(["a", "b"])
    texts = texts.withColumn("block", F.pmod("a", F.lit(blocks)).cast("int")).repartitionById(blocks, "block")
    texts = tokenize(texts, column, stop_words=True).select("block", "a", "b", F.col(content_col(column)).alias("tokens"))
    words = texts.select("block", F.explode_outer("tokens").alias("token")).filter(F.col("token").isNotNull()).distinct()
    theirs = words.withColumnRenamed("block", "home").join(packed(vectors, ["units"]), "token").repartitionById(blocks, "home")
    # a block is a task's work whatever its bytes
    embedded = texts.groupBy("block").cogroup(theirs.groupBy("home"))
    return embedded.applyInArrow(_block_embedder(dim), "a long, b long, vector array<double>")


def _block_embedder(dim: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A function that gives the vectors of a block's texts from those of its words."""

    def embed(texts: pa.Table, words: pa.Table) -> pa.Table:
        tokens = texts.column("tokens").combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
        found = pc.index_in(pc.list_flatten(tokens), value_set=words.column("token").combine_chunks())
        known = found.is_valid().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)[known]
        word = found.drop_null().to_numpy(zero_copy_only=False)
        units = unpacked(words.column("units").to_pylist(), dim)
        sums = np.zeros((len(sizes), dim), np.int64)
        for at in range(0, len(word), STRETCH):
            texts_here, first = np.unique(owner[at : at + STRETCH], return_index=True)
            sums[texts_here] += np.add.reduceat(units[word[at : at + STRETCH]], first, axis=0)
        some = np.unique(owner)
        values = sums[some] / (sizes[some] * float(1 << UNIT_BITS))[:, None]
        vector = pa.ListArray.from_arrays(np.arange(0, values.size + 1, dim, dtype=np.int32), values.ravel())
        return pa.table({"a": texts.column("a").take(some), "b": texts.column("b").take(some), "vector": vector})

    return embed
