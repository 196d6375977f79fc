"""Exact top-k search by inner product: columnar branch and bound.

Vectors and queries meet in a grid of blocks.  In a cell the candidates lie in vertical layout
(one row of the matrix per dimension).  For each query the scores grow dimension block by
dimension block, the query's heaviest blocks first; by Cauchy-Schwarz the mass that remains in
both vectors bounds what a candidate can still gain, and candidates whose upper bound is below
the k-th best lower bound are compacted away.  Equal scores stay, so ties are exact.

Each query block is a stated part of the query set and meets all rows; no side is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16384
WIDTH = 8  # dimensions of a block
_EXACT = float(1 << 53)


def integer_vectors(embeddings: DataFrame, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of each component.

    Vectors that are null or empty, or hold a null or non-finite component, and rows without an
    id are left out.  Rows that repeat an id and its vector count once.
    """
    x = F.col(vector_column)
    bad = F.exists(x, lambda y: F.coalesce(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")), F.lit(True)))
    usable = embeddings.where(F.col(id_column).isNotNull() & (F.size(x) > 0) & ~bad)
    return usable.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda y: F.floor(F.lit(scale) * y.cast("double"))).alias("v")).distinct()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return pa.compute.list_flatten(column).to_numpy().reshape(-1, width)


def top_of_cell(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """(query number, vector number, score) of each query's k best in a cell, ties included up to k by smaller id."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    dims = vectors.shape[1]
    blocks = [slice(a, min(a + WIDTH, dims)) for a in range(0, dims, WIDTH)]
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
    # Doubles hold every sum exactly while it stays below 2**53; beyond that Python's integers do.
    kind = np.float64 if largest < _EXACT else object
    vertical = np.ascontiguousarray(vectors.T).astype(kind)
    mass = np.stack([(vectors[:, b].astype(float) ** 2).sum(1) for b in blocks])
    total = mass.sum(0)
    out = []
    for number, query in enumerate(queries):
        own = ids == query_ids[number]
        alive = np.flatnonzero(~own) if own.any() else None
        weights = np.array([(query[b].astype(float) ** 2).sum() for b in blocks])
        turn = np.argsort(-weights, kind="stable")
        left = weights.sum()
        q = query.astype(kind)
        score, rest = np.zeros(len(ids) if alive is None else len(alive), kind), total if alive is None else total[alive]
        for step, b in enumerate(turn):
            rows = vertical[blocks[b]]
            score = score + q[blocks[b]] @ (rows if alive is None else rows[:, alive])
            rest = rest - (mass[b] if alive is None else mass[b][alive])
            left -= weights[b]
            if step + 1 == len(turn) or len(score) <= 4 * k:
                continue
            # Slack covers the rounding of the bound, which is the only inexact part.
            gain = np.sqrt(np.maximum(left, 0.0) * np.maximum(rest, 0.0)) * (1 + 1e-9) + 1e-6 * (1 + np.sqrt(total.max()))
            have = score.astype(float)
            floor = np.partition(have - gain, len(have) - k)[len(have) - k]
            stay = have + gain >= floor - abs(floor) * 1e-12
            if stay.mean() < 0.7:
                alive = np.flatnonzero(stay) if alive is None else alive[stay]
                score, rest = score[stay], rest[stay]
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            at = np.flatnonzero(score >= least)
        else:
            at = np.arange(len(score))
        places = at if alive is None else alive[at]
        best = np.lexsort((ids[places], -score[at]))[:k]
        out += [(number, ids[places[i]], score[at[i]]) for i in best]
    return out


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        width = left.column("dims")[0].as_py()
        query_ids, ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        found = top_of_cell(_matrix(left.column("v"), width), query_ids, _matrix(right.column("v"), width), ids, k)
        low, high = -(1 << 63), (1 << 63) - 1
        return pa.table({"query_id": pa.array([int(query_ids[n]) for n, _, _ in found], pa.int64()),
                         "vec_id": pa.array([int(i) for _, i, _ in found], pa.int64()),
                         "score": pa.array([min(max(int(s), low), high) for _, _, s in found], pa.int64())})

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, ties to the smaller vec_id.

    Both inputs are tables of integer_vectors.  A query's own id is no candidate; vectors of
    another length are none either.  Scores beyond a signed long are cut to its range.  Ids that
    carry several vectors are several candidates.  Without queries or rows the result is empty.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n, m = vectors.count(), queries.count()
    c_blocks = max(-(-n // candidate_block), min(4 * cores, -(-n // 256)), 1)
    q_blocks = max(-(-m // query_block), 1)
    spread = F.xxhash64("vec_id", "v")
    sized = [d.select("vec_id", "v", F.size("v").alias("dims")) for d in (queries, vectors)]
    left = sized[0].withColumn("q", F.pmod(spread, F.lit(q_blocks))).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    right = sized[1].withColumn("c", F.pmod(spread, F.lit(c_blocks))).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    cells = left.groupBy("dims", "q", "c").cogroup(right.groupBy("dims", "q", "c"))
    best = cells.applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
