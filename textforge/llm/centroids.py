"""Centroid clustering with norm-of-sum bounds.

Lloyd's rounds over integer vectors.  For each vector and centroid the distance of their last
exact evaluation is kept with the round it was made in.  The history of all centroids is kept
too, so in a later round a stored distance is loosened by the length of the centroid's whole
displacement since that round, |c(now) - c(then)|, which is never more than the sum of its
steps.  A vector whose loosened distance to its own centroid stays below those to all others
keeps its centroid unseen.  The rest are evaluated again exactly: first the own centroid, then
every centroid whose bound does not exclude it.  Bounds only decide what to evaluate; assignments,
sums and distances are exact integers, so the result is that of plain rounds.

Vectors lie in blocks, one row each, with their state.  A round reads the blocks, rewrites the
state, and returns only the sums of vectors that moved.  The driver holds centroids, their
history and the sums: numbers that depend on parameters, never on the rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.storage import discard, materialize


@dataclass(frozen=True)
class ClusterSettings:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: float = 1024.0
    salt: str = "3"
    block_rows: int = 8192


#: Components beyond it could overflow the sum of a squared distance.
_LARGEST = 1 << 27
_STATE = "block long, ids binary, given binary, v binary, cluster binary, dist binary, seen binary, moved array<long>"
_COLUMNS = {"block": pa.int64(), "ids": pa.binary(), "given": pa.binary(), "v": pa.binary(), "cluster": pa.binary(), "dist": pa.binary(),
            "seen": pa.binary(), "moved": pa.list_(pa.int64())}


def integer_vectors(embeddings: DataFrame, s: ClusterSettings, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of the vectors that have exactly ``dims`` components, none null or non-finite."""
    x = F.col(vector_column)
    bad = F.exists(x, lambda y: F.coalesce(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")), F.lit(True)))
    far = F.raise_error(F.lit(f"a component times the scale is beyond {_LARGEST}"))
    whole = F.transform(x, lambda y: F.floor(F.lit(s.scale) * y.cast("double")))
    kept = embeddings.where((F.size(x) == s.dims) & ~bad).select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"))
    return kept.withColumn("v", F.when(F.forall("v", lambda y: (y <= _LARGEST) & (y >= -_LARGEST)), F.col("v")).otherwise(far.cast("array<bigint>")))


def first_centroids(vectors: DataFrame, s: ClusterSettings) -> np.ndarray:
    """The vectors with the smallest hashes of their salted ids, in that order; equal ids in order of their components, missing ids last."""
    key = F.sha2(F.concat(F.lit(f"{s.salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.withColumn("key", key).orderBy(F.asc_nulls_last("key"), "v").limit(s.clusters).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), s.dims)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` from one centroid."""
    step = v.astype(np.int64) - c
    return np.einsum("ij,ij->i", step, step)


def squared_all(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances from every centroid; by matrix products while doubles hold every sum exactly."""
    widest = float(max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)))
    if 4 * v.shape[1] * widest * widest < 1 << 53:
        x, c = v.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([squared(v, c) for c in centroids], axis=1)


def assign(v: np.ndarray, cluster: np.ndarray, dist: np.ndarray, seen: np.ndarray, history: np.ndarray):
    """One round over a block: (cluster, dist, seen, vectors evaluated).

    ``history`` holds the centroids of every round so far, the current ones last; ``dist`` and ``seen``
    the squared distance and round of each pair's last evaluation.
    """
    now, current = len(history) - 1, history[-1]
    if not dist.size:
        dist = squared_all(v, current)
        return np.argmin(dist, axis=1).astype(np.int16), dist, np.full(dist.shape, now, np.int16), len(v)
    n, rows = len(v), np.arange(len(v))
    # [round, centroid]: how far the centroid now is from where it was; rounded outward with the bounds below.
    moved = np.sqrt(((history - current) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
    drift = moved[seen, np.arange(len(current))]
    root = np.sqrt(dist.astype(np.float64))
    low = (root * (1 - 1e-12) - drift) * (1 - 1e-12)
    own_high = (root[rows, cluster] * (1 + 1e-12) + drift[rows, cluster]) * (1 + 1e-12)
    low[rows, cluster] = np.inf
    open_rows = np.flatnonzero(own_high >= low.min(axis=1))
    if not len(open_rows):
        return cluster, dist, seen, 0
    dist, seen, cluster = dist.copy(), seen.copy(), cluster.copy()
    own = cluster[open_rows]
    stale = seen[open_rows, own] != now
    for j in np.unique(own[stale]):
        at = open_rows[stale & (own == j)]
        dist[at, j], seen[at, j] = squared(v[at], current[j]), now
    exact = dist[open_rows, own]
    high = np.sqrt(exact.astype(np.float64)) * (1 + 1e-12)
    best, place = exact.copy(), own.copy()
    for j in range(len(current)):
        need = np.flatnonzero((low[open_rows, j] <= high) & (own != j))
        at = open_rows[need]
        stale = seen[at, j] != now
        dist[at[stale], j] = squared(v[at[stale]], current[j])
        seen[at, j] = now
        d = dist[at, j]
        wins = (d < best[need]) | ((d == best[need]) & (j < place[need]))
        best[need[wins]], place[need[wins]] = d[wins], j
    cluster[open_rows] = place
    return cluster, dist, seen, len(open_rows)


def _opened(row: dict, dims: int):
    """(vectors, cluster, dist, seen) of a block."""
    v = np.frombuffer(row["v"], "<i4").reshape(-1, dims)
    pairs = (len(v), -1)
    return v, np.frombuffer(row["cluster"], "<i2"), np.frombuffer(row["dist"], "<i8").reshape(pairs), np.frombuffer(row["seen"], "<i2").reshape(pairs)


def _evaluated(block: dict, v: np.ndarray, before: np.ndarray, dist: np.ndarray, seen: np.ndarray, history: np.ndarray) -> pa.RecordBatch:
    """The block after a round, and by how much its vectors that moved change every centroid's sum and count."""
    cluster, dist, seen, checked = assign(v, before, dist, seen, history)
    k, dims = history.shape[1:]
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    change = np.flatnonzero(cluster != before)
    for j in range(k) if len(change) else ():
        into, out = change[cluster[change] == j], change[before[change] == j]
        sums[j] = v[into].sum(0, dtype=np.int64) - v[out].sum(0, dtype=np.int64)
        counts[j] = len(into) - len(out)
    row = block | {"cluster": cluster.astype("<i2").tobytes(), "dist": dist.astype("<i8").tobytes(), "seen": seen.astype("<i2").tobytes(),
                   "moved": np.concatenate([sums.reshape(-1), counts, [checked]])}
    return pa.RecordBatch.from_arrays([pa.array([row[name]], kind) for name, kind in _COLUMNS.items()], names=list(_COLUMNS))


def _blocks(s: ClusterSettings, centroids: np.ndarray):
    """Vectors of a task in rows of ``block_rows``, evaluated against the first centroids."""

    def row(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        ids = table.column("vec_id").combine_chunks()
        v = pc.list_flatten(table.column("v")).to_numpy().astype("<i4").reshape(len(ids), s.dims)
        block = {"block": TaskContext.get().partitionId() << 32 | number, "ids": np.asarray(ids.fill_null(0)).astype("<i8").tobytes(),
                 "given": np.asarray(ids.is_valid()).astype(np.uint8).tobytes(), "v": v.tobytes()}
        return _evaluated(block, v, np.full(len(ids), -1, np.int16), np.empty((0, len(centroids)), np.int64), np.empty(0, np.int16), centroids[None])

    def run(batches):
        held, size, number = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, s.block_rows - size)
                held.append(part)
                size, at = size + part.num_rows, at + part.num_rows
                if size == s.block_rows:
                    yield row(held, number)
                    held, size, number = [], 0, number + 1
        if held:
            yield row(held, number)

    return run


def _rows(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}


def _round(history: np.ndarray, s: ClusterSettings):
    def run(batches):
        for row in _rows(batches):
            yield _evaluated({name: row[name] for name in ("block", "ids", "given", "v")}, *_opened(row, s.dims), history)

    return run


def _answers(centroids: np.ndarray, s: ClusterSettings):
    def run(batches):
        for row in _rows(batches):
            v, cluster, _, _ = _opened(row, s.dims)
            distance = np.zeros(len(v), np.int64)
            for j in range(len(centroids)):
                at = np.flatnonzero(cluster == j)
                distance[at] = squared(v[at], centroids[j])
            given = np.frombuffer(row["given"], np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["ids"], "<i8"), mask=given == 0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return run


def _moved(blocks: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Changes of the sums and counts, and vectors evaluated, added over all blocks: k * (dims + 1) + 1 numbers."""
    rows = blocks.select(F.posexplode("moved").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect()
    total = np.zeros(k * (dims + 1) + 1, np.int64)
    for r in rows:
        total[r.place] = r.x
    return total[: k * dims].reshape(k, dims), total[k * dims : -1], int(total[-1])


def cluster_vectors(vectors: DataFrame, s: ClusterSettings = ClusterSettings()) -> tuple[DataFrame, np.ndarray, list[int]]:
    """((vec_id, cluster, distance) of every vector, final centroids, vectors evaluated in each round).

    ``vectors`` is a table of integer_vectors.  Ties go to the smaller number; an empty centroid stays where it is.
    With fewer vectors than clusters every vector starts one.  Rows that share an id, or have none, are vectors of
    their own.  Without vectors the result is empty.  Rounds end early when no centroid moves, which changes nothing.
    """
    if not (0 < s.clusters < 1 << 15 and 0 <= s.rounds < 1 << 15):
        raise ValueError("clusters and rounds must be below 32768")
    centroids = first_centroids(vectors, s)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids, []
    history = centroids[None]
    blocks = materialize(vectors.mapInArrow(_blocks(s, centroids), _STATE))
    sums, counts, _ = _moved(blocks, *centroids.shape)
    checked = []
    for _ in range(s.rounds):
        centroids = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        if (centroids == history[-1]).all():
            break
        history = np.concatenate([history, centroids[None]])
        previous, blocks = blocks, materialize(blocks.mapInArrow(_round(history, s), _STATE))
        discard(previous)
        step, change, seen = _moved(blocks, *centroids.shape)
        sums, counts = sums + step, counts + change
        checked.append(seen)
    answers = materialize(blocks.mapInArrow(_answers(centroids, s), "vec_id long, cluster int, distance long"))
    discard(blocks)
    return answers, centroids, checked


def clustered(embeddings: DataFrame, s: ClusterSettings = ClusterSettings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector; see cluster_vectors."""
    answers, centroids, _ = cluster_vectors(integer_vectors(embeddings, s, id_column, vector_column), s)
    total = {r.cluster: r.d for r in answers.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row per cluster, a parameter's number.
    heads = [(j, total.get(j, 0), sum(total.values()), digest[j]) for j in range(len(centroids))]
    side = embeddings.sparkSession.createDataFrame(heads, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return answers.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
