"""Hard negatives by bounds that spread along a spanning tree of the anchors.

Anchors are queries against all rows.  A block of anchors gets a minimum spanning tree; for an
anchor ``a`` with parent ``p`` and a candidate ``c``, the score ``<a, c>`` differs from ``<p, c>``
by at most ``|a - p| |c|``.  So a candidate's interval at the parent, widened by edge distance times
candidate norm, bounds its score at the child.  Only candidates whose interval overlaps a window
that is still open are scored exactly, which closes their interval to a point for the subtree
below; the others pass their wider interval on.  Nothing is capped: the bounds decide.

Two passes over the candidates use the same walk: the first finds each anchor's positives (best
rows of its own label), the second the best rows of other labels within the score window of each
positive.  A window is open from its lower end, or the last score that still counts, to its upper end.

Vectors are quantised to integers, so scores are exact and ties are real.  Anchors are dealt by
ranges of (dimension, label, a projection), which keeps tree edges short; a hot label fills several
ranges.  Candidates travel as packed blocks.  A range of anchors meets the blocks in a few cells, as
many as keep the cluster busy; a cell streams its blocks against its trees, so a task holds its anchors
and one block, and its result is bounded by its anchors, whatever the number of candidates.  All
anchors meet all rows, as the operator asks, so the work grows with anchors × rows.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component take no part;
nor do rows with so large components that a score might not fit a long; a vector without components scores 0; vectors meet those of their own dimension only; of
rows that share an id the least by (vector, label) counts, so an exact repetition counts once; an
anchor without a positive, or a positive without a negative, has no rows; a negative positive score
has an empty window; equal scores rank by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize, remove_path, shared_path, written

POSITIVES = 5
NEGATIVES = 10
EVERY = 100
#: Percent of a positive's score between which a negative's lies.
LOWEST, HIGHEST = 30, 90
SCALE = 256
#: Anchors in a range, candidates in a block.
ANCHOR_ROWS = 1024
CANDIDATE_ROWS = 2048
#: Scores stay below this; sums of products below the other are exact in double precision.
LARGEST, EXACT = 1 << 62, 1 << 53
NOTHING = np.iinfo(np.int64).min
#: Components gathered at once for exact scores.
GATHER = 1 << 22


def quantised(df: DataFrame, vec_id: str, vector: str, label: Column) -> DataFrame:
    """``id long, label long, v array<int>``: one valid row an id."""
    rows = df.select(
        F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x")
    )
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    peak = F.coalesce(F.array_max(F.transform("x", lambda x: F.abs(x) * SCALE + 1)), F.lit(0.0))
    rows = rows.filter(F.size("x") * peak * peak < float(LARGEST))
    v = F.transform("x", lambda x: F.floor(x * SCALE).cast("int"))
    one = rows.select("id", "label", v.alias("v")).groupBy("id").agg(F.min(F.struct("v", "label")).alias("r"))
    return one.select("id", "r.label", "r.v")


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree: (points in the order in which they join, parent's place in it, edge's length)."""
    n = len(points)
    square = (points * points).sum(axis=1)
    order, parent, length = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    place, near, best = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, np.inf)
    out = np.ones(n, bool)
    last = 0
    for i in range(n):
        if i:
            last = int(np.where(out, best, np.inf).argmin())
            parent[i] = place[near[last]]
            length[i] = np.linalg.norm(points[last] - points[near[last]])
        order[i], place[last], out[last] = last, i, False
        distance = square + square[last] - 2.0 * (points @ points[last])
        closer = out & (distance < best)
        best[closer], near[closer] = distance[closer], last
    return order, parent, length


def levels(parent: np.ndarray) -> list[np.ndarray]:
    """Places of the tree by depth."""
    depth = np.zeros(len(parent), np.int64)
    for i in range(1, len(parent)):  # a parent comes before its children
        depth[i] = depth[parent[i]] + 1
    by = np.argsort(depth, kind="stable")
    return np.split(by, np.flatnonzero(np.diff(depth[by])) + 1)


class Tree:
    """Anchors in tree order, and for every window of each the best rows so far.

    ``low`` and ``high`` (anchors × windows) are the scores between which a window lies; ``same`` says
    whether its rows have the anchor's label or another one.
    """

    def __init__(self, ids, labels, vectors, parent, length, low, high, same: bool, k: int):
        self.ids, self.labels, self.vectors, self.parent, self.length = ids, labels, vectors, parent, length
        self.low, self.high, self.same, self.k = low, high, same, k
        self.levels = levels(parent)
        self.scores = np.full((*low.shape, k), NOTHING)
        self.rows = np.zeros((*low.shape, k), np.int64)
        self.scored = 0  # pairs

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Hold a block of candidates against all anchors."""
        real = vectors.astype(np.float64)
        norms = np.linalg.norm(real, axis=1)
        bound = np.abs(self.vectors).max(initial=0) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        kind = np.float64 if bound < EXACT else np.int64
        anchors, rows = self.vectors.astype(kind), vectors.astype(kind)
        shape = len(self.ids), len(ids)
        under, over = np.empty(shape, np.int64), np.empty(shape, np.int64)
        for level in self.levels:
            right = (labels == self.labels[level][:, None]) == self.same
            right &= ids != self.ids[level][:, None]
            if self.parent[level[0]] < 0:
                under[level] = over[level] = (anchors[level] @ rows.T).astype(np.int64)
                exact = right
                self.scored += right.size
            else:
                wide = np.minimum(np.ceil(np.outer(self.length[level], norms) * (1 + 1e-9)) + 1, float(LARGEST)).astype(np.int64)
                lower = np.maximum(under[self.parent[level]] - wide, -LARGEST)
                upper = np.minimum(over[self.parent[level]] + wide, LARGEST)
                exact = right & self._open(level, lower, upper)
                at, row = np.nonzero(exact)
                self.scored += len(at)
                for some in np.array_split(np.arange(len(at)), len(at) * max(1, vectors.shape[1]) // GATHER + 1):
                    scores = np.einsum("ij,ij->i", anchors[level[at[some]]], rows[row[some]]).astype(np.int64)
                    lower[at[some], row[some]] = upper[at[some], row[some]] = scores
                under[level], over[level] = lower, upper
            for i in np.flatnonzero(exact.any(axis=1)):
                near = np.flatnonzero(exact[i])
                self._take(level[i], under[level[i], near], ids[near])

    def _open(self, level: np.ndarray, under: np.ndarray, over: np.ndarray) -> np.ndarray:
        """Whose intervals overlap the open part of a window; a row that ties with the last may win by its id."""
        some = np.zeros(under.shape, bool)
        for w in range(self.low.shape[1]):
            least = np.maximum(self.low[level, w], self.scores[level, w, -1])
            some |= (over >= least[:, None]) & (under <= self.high[level, w][:, None])
        return some

    def _take(self, place: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Enter scored rows into the anchor's windows."""
        for w in range(self.low.shape[1]):
            kept = self.scores[place, w]
            fit = (scores >= max(self.low[place, w], kept[-1])) & (scores <= self.high[place, w])
            if fit.any():
                s, r = np.append(kept, scores[fit]), np.append(self.rows[place, w], ids[fit])
                best = np.lexsort((r, ~s))[: self.k]  # ~s: descending, without overflow
                self.scores[place, w], self.rows[place, w] = s[best], r[best]

    def found(self) -> pa.RecordBatch:
        place, window, at = np.nonzero(self.scores > NOTHING)
        columns = self.ids[place], window.astype(np.int32), self.rows[place, window, at], self.scores[place, window, at]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "row", "score"])


FOUND = "anchor long, window int, row long, score long"
BLOCK = "block long, dim int, ids binary, labels binary, vectors binary"
PLANTED = "range int, block long, place int, dim int, id long, label long, vector binary, parent int, length double"


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """(id, label, vector) of each row."""
    lists = batch.column("v")
    flat, starts = lists.values.to_numpy(zero_copy_only=False).astype("<i4"), lists.offsets.to_numpy()
    pairs = zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())
    for (id_, label), a, b in zip(pairs, starts, starts[1:]):
        yield id_, label, flat[a:b]


def pack_candidates(rows: DataFrame) -> DataFrame:
    """Rows of one dimension in blocks of up to ``CANDIDATE_ROWS``, one a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, int, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, labels, vectors = zip(*waiting.pop(dim))
            bytes_ = (np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), np.concatenate(vectors).tobytes())
            columns = [pa.array([ids[0]], pa.int64()), pa.array([dim], pa.int32()), *(pa.array([b], pa.binary()) for b in bytes_)]
            return pa.RecordBatch.from_arrays(columns, ["block", "dim", "ids", "labels", "vectors"])

        for batch in batches:
            for row in _rows(batch):
                some = waiting.setdefault(len(row[2]), [])
                some.append(row)
                if len(some) == CANDIDATE_ROWS:
                    yield block(len(row[2]))
        for dim in list(waiting):
            yield block(dim)

    return rows.mapInArrow(pack, BLOCK)


def plant(anchors: DataFrame, ranges: int) -> DataFrame:
    """Anchors with their trees: in each range, one tree a dimension."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple[int, int, np.ndarray]] = []

        def tree() -> pa.RecordBatch:
            ids, labels, vectors = zip(*some)
            order, parent, length = spanning_tree(np.stack(vectors).astype(np.float64))
            n = len(ids)
            columns = [
                pa.array([TaskContext.get().partitionId()] * n, pa.int32()),
                pa.array([ids[0]] * n, pa.int64()),
                pa.array(np.arange(n, dtype=np.int32)),
                pa.array([len(vectors[0])] * n, pa.int32()),
                pa.array(np.array(ids, np.int64)[order]),
                pa.array(np.array(labels, np.int64)[order]),
                pa.array([vectors[i].tobytes() for i in order], pa.binary()),
                pa.array(parent.astype(np.int32)),
                pa.array(length),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PLANTED.split(", ")])

        for batch in batches:
            for row in _rows(batch):
                if some and (len(some) == 2 * ANCHOR_ROWS or len(some[0][2]) != len(row[2])):
                    yield tree()
                    some.clear()
                some.append(row)
        if some:
            yield tree()

    # the projection: components against a fixed, irregular row of small weights
    weighted = F.transform("v", lambda x, i: x.cast("double") * (i % 23 * (i % 29) % 11 - 5))
    along = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    keys = ["dim", "label", "along", "id"]
    keyed = anchors.select("id", "label", "v", F.size("v").alias("dim"), along.alias("along"))
    return keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select("id", "label", "v").mapInArrow(trees, PLANTED)


def walk(planted: DataFrame, blocks: DataFrame, ranges: int, splits: int, same: bool, k: int, lowest: int, highest: int) -> DataFrame:
    """Each anchor's best ``k`` rows in each of its windows, as ``FOUND`` rows with their ``rank``.

    With ``same`` an anchor has one window, all rows of its label; else one for each of its ``positives``
    (an array of scores), of rows with other labels.
    """
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cell = (F.col("range") * splits + F.col("split")).cast("int").alias("cell")
    positives = F.lit(None).cast("array<long>") if same else F.col("positives")
    asked = planted.withColumn("split", each(splits)).select(
        cell,
        F.lit(0).alias("kind"),
        "block",
        "dim",
        F.struct("id", "label", "vector", "place", "parent", "length", positives.alias("positives")).alias("anchor"),
        F.lit(None).cast("struct<ids binary, labels binary, vectors binary>").alias("rows"),
    )
    given = blocks.withColumn("split", F.pmod(F.xxhash64("block"), F.lit(splits))).withColumn("range", each(ranges))
    given = given.select(
        cell,
        F.lit(1).alias("kind"),
        "block",
        "dim",
        F.lit(None).cast(asked.schema["anchor"].dataType).alias("anchor"),
        F.struct("ids", "labels", "vectors").alias("rows"),
    )

    def tree_of(dim: int, rows: list[dict]) -> Tree:
        rows.sort(key=lambda r: r["place"])
        vectors = np.frombuffer(b"".join(r["vector"] for r in rows), "<i4").reshape(len(rows), dim).astype(np.int64)
        if same:
            low, high = np.full((len(rows), 1), NOTHING), np.full((len(rows), 1), np.iinfo(np.int64).max)
        else:
            most = max(len(r["positives"] or ()) for r in rows)
            low, high = np.ones((len(rows), most), np.int64), np.zeros((len(rows), most), np.int64)  # empty windows
            for i, r in enumerate(rows):
                for w, p in enumerate(r["positives"] or ()):
                    low[i, w], high[i, w] = -(-lowest * p // 100), highest * p // 100
        ids, labels = np.array([r["id"] for r in rows]), np.array([r["label"] for r in rows])
        parent, length = np.array([r["parent"] for r in rows]), np.array([r["length"] for r in rows])
        return Tree(ids, labels, vectors, parent, length, low, high, same, k)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[tuple[int, int], list[dict]] = {}
        trees: dict[int, list[Tree]] | None = None
        for batch in batches:
            for kind, block, dim, anchor, rows in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                if not kind:
                    anchors.setdefault((block, dim), []).append(anchor)
                    continue
                if trees is None:
                    trees = {}
                    for (_, d), some in anchors.items():
                        trees.setdefault(d, []).append(tree_of(d, some))
                ids, labels = np.frombuffer(rows["ids"], "<i8"), np.frombuffer(rows["labels"], "<i8")
                vectors = np.frombuffer(rows["vectors"], "<i4").reshape(len(ids), dim).astype(np.int64)
                for tree in trees.get(dim, ()):
                    if tree.low.shape[1]:
                        tree.meet(ids, labels, vectors)
        for some in (trees or {}).values():
            for tree in some:
                yield tree.found()

    cells = asked.unionByName(given).repartitionById(ranges * splits, F.col("cell")).sortWithinPartitions("kind", "block")
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "row")
    return cells.mapInArrow(search, FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Anchors (ids divisible by ``every``), their positives, and the hard negatives of each.

    ``anchor_id, positive_id long, rank int, negative_id, positive_score, negative_score long``.
    """
    spark = df.sparkSession
    rows = quantised(df, vec_id, vector, F.col(label) if isinstance(label, str) else label)
    paths = [shared_path(spark, f"mining-{name}") for name in ("rows", "blocks", "trees", "positives")]
    rows = written(rows, paths[0])
    anchors = rows.filter(F.col("id") % every == 0)
    ranges = max(1, ceil(anchors.count() / ANCHOR_ROWS))
    splits = max(1, ceil(2 * spark.sparkContext.defaultParallelism / ranges))
    blocks = written(pack_candidates(rows), paths[1])
    planted = written(plant(anchors, ranges), paths[2])
    liked = written(walk(planted, blocks, ranges, splits, True, positives, lowest, highest), paths[3])
    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    windows = liked.groupBy(F.col("anchor").alias("id")).agg(scores.alias("positives"))
    disliked = walk(planted.join(windows, "id", "left"), blocks, ranges, splits, False, negatives, lowest, highest)
    of = liked.select("anchor", (F.col("rank") - 1).alias("window"), F.col("row").alias("positive"), F.col("score").alias("positive_score"))
    result = of.join(disliked, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("row").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    result = materialize(result, "hard-negatives")
    for path in paths:
        remove_path(spark, path)
    return result
