"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector ``x`` becomes its norm, the sign bits of a random rotation of ``x/|x|``
(packed), and a correction scalar: the inner product ``a`` of the rotated unit
vector with its own code.  For a query ``q`` the estimate of ``<x, q>`` is
``|x| <code, Rq> / a``, and its error is, but for a small chance, at most
``|x| |q| EPSILON sqrt(1 - a^2) / (a sqrt(d - 1))``.  Per query and block of codes the
vectors with the best estimates are scored exactly first; the k-th best of these
scores is a floor, and every other vector whose upper bound reaches the floor is
scored exactly, too.  So the bounds decide what is reranked; nothing is capped.

Every valid row is indexed; nothing is fitted (the rotation depends on a seed and
the dimension only).  Estimates come from the packed bits: a query becomes a table of partial
sums, one for each byte of a code and each value of that byte, and a code's bytes look up and add theirs;
codes are never unpacked.  A query block meets a code block in one task, as all queries
must be held against all rows; both block sizes are fixed, so a task's memory is, and a row is
copied once for each ``QUERY_ROWS`` queries.
Vectors travel beside the codes: with one bit a component the bounds leave a large share of the
rows to be scored (half of 2,000 vectors of 64 components), and fetching these for each query would move more than
each block's vectors once.
Each pair of blocks gives k rows a query, and a window keeps the k best.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite values
take no part, nor do rows without an id; of rows that share an id the smallest vector
counts; a query meets vectors of its own dimension only; with fewer than k candidates
all are returned; equal scores rank by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize

K = 20
SEED = 7
#: Error bound in standard deviations of the estimate.
EPSILON = 3.0
#: Codes in a block, queries in a block, and queries estimated at once.
CODE_ROWS = 8192
QUERY_ROWS = 8192
AT_ONCE = 64
#: Best estimates scored first, as a multiple of k.
FIRST = 4


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id long, v array<double>``: one valid vector an id."""
    top = F.lit(float("inf"))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top))
    some = F.exists(v, lambda x: x != 0)
    kept = rows.filter(F.col("id").isNotNull() & v.isNotNull() & finite & some)
    return kept.groupBy("id").agg(F.min("v").alias("v"))


def encode(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, norms, correction scalars) of the rows."""
    peak = np.abs(vectors).max(axis=1)
    unit = vectors / peak[:, None]
    length = np.linalg.norm(unit, axis=1)
    turned = (unit / length[:, None]) @ rotation(vectors.shape[1], seed)
    a = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), length * peak, a


@lru_cache(maxsize=1)
def byte_signs() -> np.ndarray:
    """The eight signs of each byte, first bit first."""
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1


def code_products(bits: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``turned`` with packed codes, given as one row for each byte of a code."""
    queries, dim = turned.shape
    width = len(bits)
    padded = np.zeros((queries, width * 8), np.float32)
    padded[:, :dim] = turned
    tables = padded.reshape(queries, width, 8) @ byte_signs().T  # query, place, value of the byte
    total = np.zeros((queries, bits.shape[1]), np.float32)
    for place in range(width):
        total += tables[:, place].take(bits[place], axis=1)
    return total


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in order of the components."""
    return np.cumsum(rows * query, axis=1)[:, -1]


def search_block(
    ids: np.ndarray,
    vectors: np.ndarray,
    codes: tuple[np.ndarray, np.ndarray, np.ndarray],
    queries: np.ndarray,
    own: np.ndarray,
    k: int = K,
    epsilon: float = EPSILON,
    seed: int = SEED,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the (ids, scores) of the block's k best by the codes, bounds and reranking."""
    bits, norms, a = codes
    dim = vectors.shape[1]
    places = np.ascontiguousarray(bits.T)
    scale = norms / (a * np.sqrt(dim))
    spread = epsilon * norms * np.sqrt(np.maximum(0, 1 - a * a)) / (a * np.sqrt(max(1, dim - 1)))
    spread += 2.0**-22 * (dim + 8) * norms / a  # rounding of the estimate
    first = min(len(ids), FIRST * k + 1)
    for at in range(0, len(queries), AT_ONCE):
        some = queries[at : at + AT_ONCE]
        turned = some @ rotation(dim, seed)
        estimates = code_products(places, turned) * scale
        lengths = np.linalg.norm(some, axis=1)
        for query, me, estimate, length in zip(some, own[at:], estimates, lengths):
            best = np.argpartition(-estimate, first - 1)[:first]
            best = best[ids[best] != me]
            scores = exact(vectors[best], query)
            floor = np.partition(scores, len(scores) - k)[-k] if len(scores) >= k else -np.inf
            reach = estimate + length * spread >= floor
            reach[best] = False
            more = np.flatnonzero(reach)
            more = more[ids[more] != me]
            near = np.concatenate([best, more])
            scores = np.concatenate([scores, exact(vectors[more], query)])
            order = np.lexsort((ids[near], -scores))[:k]
            yield ids[near[order]], scores[order]


def search(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = K, epsilon: float = EPSILON
) -> DataFrame:
    """``query_id long, rank int, vec_id long, score double`` for the ids divisible by ``every``."""
    rows = valid_vectors(df, vec_id, vector)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in pdf.groupby(pdf["v"].map(len)):
                bits, norms, a = encode(np.stack(part["v"].to_list()))
                yield part.assign(dim=len(part["v"].iloc[0]), bits=[b.tobytes() for b in bits], norm=norms, a=a)

    schema = "id long, v array<double>, dim int, bits binary, norm double, a double"
    coded = materialize(rows.mapInPandas(index, schema), "ann-codes")
    n = coded.count()
    code_blocks, query_blocks = max(1, ceil(n / CODE_ROWS)), max(1, ceil(n / every / QUERY_ROWS))

    # a block's number by hash; a copy of each code block for each query block, and the other way round
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    codes = coded.withColumn("cb", block(code_blocks, 1)).withColumn("qb", spread(query_blocks))
    asked = coded.filter(F.col("id") % every == 0).select("id", "v", "dim")
    asked = asked.withColumn("qb", block(query_blocks, 2)).withColumn("cb", spread(code_blocks))

    def meet(codes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(codes) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        queries, own = np.stack(asked["v"].to_list()), asked["id"].to_numpy()
        vectors, ids = np.stack(codes["v"].to_list()), codes["id"].to_numpy()
        bits = np.frombuffer(b"".join(codes["bits"]), np.uint8).reshape(len(ids), -1)
        kept = (bits, codes["norm"].to_numpy(), codes["a"].to_numpy())
        found = list(search_block(ids, vectors, kept, queries, own, k, epsilon))
        return pd.DataFrame(
            {
                "query_id": np.repeat(own, [len(i) for i, _ in found]),
                "vec_id": np.concatenate([i for i, _ in found]),
                "score": np.concatenate([s for _, s in found]),
            }
        )

    keys = ["dim", "qb", "cb"]
    met = codes.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
