"""Balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together.  The differencing
method starts with one partial partition per group (its bytes in one part, none
in the others) and repeatedly combines the two partial partitions with the
largest spread, oppositely ordered, until one is left.  Here it runs as a tree:
groups are hashed into buckets of about ``FANOUT``, each bucket is differenced in
its own task, and the buckets' partial partitions (one vector of part sums each)
are differenced again, level by level, until a single one remains.  A group's
shard follows from the places recorded on the way down.

Only ids, sizes and hashes are shuffled, never texts.  Copies are summed before
the shuffle, so a hot group is one row; rows find their shard through an equi-join
that adaptive execution can split.  Slots are numbered in sub-buckets whose
offsets come from a small table of counts.  Everything between is a written table.

Edge cases: a null text has size 16 and CRC 0 and is a group of its own kind; a
null ``doc_id`` is kept; repeated rows each get a slot; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize

SHARDS = 40
#: Bytes that each row has besides its text.
ROW_BYTES = 16
#: Partial partitions differenced in one task.
FANOUT = 20_000
#: Rows numbered in one window.
SLOT_ROWS = 20_000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows: part sums, descending) into one.

    Returns the place of each row's parts in the result, and the result's part
    sums (descending).  Ties are broken by row order.
    """
    n, parts = vectors.shape
    sums = [v for v in vectors]
    label_kind = np.uint8 if parts <= 256 else np.uint32
    children: list[tuple[int, int]] = [(-1, -1)] * n
    moves: list[tuple[np.ndarray, np.ndarray] | None] = [None] * n
    heap = [(-int(v[0] - v[-1]), i) for i, v in enumerate(sums)]
    heapq.heapify(heap)
    place = np.empty(parts, label_kind)
    for _ in range(n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(-joined, kind="stable")
        place = np.empty(parts, label_kind)
        place[order] = np.arange(parts)
        children.append((a, b))
        moves.append((place, place[::-1]))
        sums[a] = sums[b] = None
        joined = joined[order]
        sums.append(joined)
        heapq.heappush(heap, (-int(joined[0] - joined[-1]), len(sums) - 1))
    labels: list[np.ndarray | None] = [None] * len(sums)
    labels[-1] = np.arange(parts, dtype=label_kind)
    for node in range(len(sums) - 1, n - 1, -1):
        for child, move in zip(children[node], moves[node]):
            labels[child] = labels[node][move]
        labels[node] = None
    return np.stack(labels[:n]).astype(np.int32), sums[-1]


def _first_level(groups: DataFrame, buckets: int, shards: int) -> DataFrame:
    """Difference the groups of each bucket -> (node, key, place) and one (node, sums) row a bucket."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable")
        vectors = np.zeros((len(pdf), shards), np.int64)
        vectors[:, 0] = pdf["bytes"]
        places, sums = difference(vectors)
        node = int(pdf["node"].iloc[0])
        rows = pd.DataFrame({"node": node, "key": pdf["key"], "place": places[:, 0], "sums": None})
        return pd.concat([rows, pd.DataFrame({"node": [node], "key": [None], "place": [-1], "sums": [sums]})])

    node = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("node")
    keyed = groups.select(node, "key", "bytes")
    return keyed.groupBy("node").applyInPandas(run, "node long, key binary, place int, sums array<long>")


def _next_level(nodes: DataFrame) -> DataFrame:
    """Difference up to ``FANOUT`` nodes each -> (node, child, places) and one (node, sums) row a parent."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("child", kind="stable")
        places, sums = difference(np.stack(pdf["sums"].to_list()).astype(np.int64))
        node = int(pdf["node"].iloc[0])
        rows = pd.DataFrame({"node": node, "child": pdf["child"], "places": list(places), "sums": None})
        return pd.concat([rows, pd.DataFrame({"node": [node], "child": [None], "places": [None], "sums": [sums]})])

    keyed = nodes.select(
        F.floor(F.col("node") / F.lit(FANOUT)).cast("long").alias("node"), F.col("node").alias("child"), "sums"
    )
    return keyed.groupBy("node").applyInPandas(run, "node long, child long, places array<int>, sums array<long>")


def assign_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``key, shard`` for groups ``key binary, bytes long`` (unique keys)."""
    n = groups.count()
    buckets = max(1, ceil(n / FANOUT))
    level = materialize(_first_level(groups, buckets, shards), "kk-groups")
    leaves = level.filter("key is not null").select("node", "key", "place")
    nodes, ups = level.filter("key is null").select("node", "sums"), []
    while buckets > 1:
        level = materialize(_next_level(nodes), "kk-nodes")
        ups.append(level.filter("child is not null").select("node", "child", "places"))
        nodes, buckets = level.filter("child is null").select("node", "sums"), ceil(buckets / FANOUT)
    if not ups:
        return leaves.select("key", F.col("place").alias("shard"))
    # the way down: a child's places within its parent, then the parent's within its own
    down = ups.pop().select(F.col("child").alias("node"), "places")
    while ups:
        above = down.select("node", F.col("places").alias("above"))
        down = ups.pop().join(above, "node").select(
            F.col("child").alias("node"), F.transform("places", lambda p: F.get("above", p)).alias("places")
        )
    return leaves.join(down, "node").select("key", F.get("places", F.col("place")).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; shards are near equal in bytes, equal texts together."""
    body = F.col(text).cast("string")
    rows = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.md5(body.cast("binary"))), F.lit(b"")).alias("key"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    subs = max(1, ceil(rows.count() / shards / SLOT_ROWS))
    placed = materialize(
        rows.join(assign_groups(groups, shards), "key").withColumn(
            "sub", F.pmod(F.xxhash64("doc_id", "key"), F.lit(subs))
        ),
        "shard-placed",
    )
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "sub")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("shard", "sub").orderBy("doc_id", "key")
    numbered = placed.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "sub"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot")
    )
