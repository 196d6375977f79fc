"""Batches of examples from a dense index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.operators.ordering import dense_index


def take_first(indexed: DataFrame, n: int, index: str = "idx") -> DataFrame:
    """The first n rows of the dense order: deterministic, unlike limit()."""
    return indexed.where(F.col(index) < n)


def repeat_to(indexed: DataFrame, n_rows: int, steps: int, batch: int, index: str = "idx") -> DataFrame:
    """steps*batch rows of an endless pass: row i is example i mod n_rows.

    Every row knows its own repeats (idx, idx + n, ...), so no join is needed.
    """
    n, total = F.lit(n_rows), steps * batch
    repeats = F.sequence(F.col(index).cast("long"), F.lit(total - 1).cast("long"), n.cast("long"))
    return indexed.where((F.col(index) < n_rows) & (F.col(index) < total)).withColumn("row_no", F.explode(repeats))


def shard(files: DataFrame, n_shards: int, which: int, index: str = "file_id") -> DataFrame:
    return files.where(F.col(index) % n_shards == which)


def with_batch(indexed: DataFrame, size: int, index: str = "idx") -> DataFrame:
    return indexed.withColumn("batch_id", F.floor(F.col(index) / size)).withColumn(
        "slot", (F.col(index) % size).cast("int"))


def make_batches(indexed: DataFrame, size: int, columns: list[str], n_rows: int | None = None,
                 index: str = "idx") -> DataFrame:
    """One row per batch with its rows in slot order; with n_rows the incomplete tail is dropped.

    A batch never holds more than ``size`` rows, so the collected arrays are bounded.
    """
    rows = with_batch(indexed, size, index)
    if n_rows is not None:
        rows = rows.where(F.col("batch_id") < n_rows // size)
    return rows.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("slot", *columns))).alias("rows"))


def per_replica(batch: int, replicas: int) -> int:
    """Batch size of one replica; the batch must divide evenly."""
    if replicas <= 1:
        return batch
    if batch % replicas:
        raise ValueError(f"batch size {batch} is not a multiple of {replicas} replicas; use {batch - batch % replicas}")
    return batch // replicas


def replica_batches(indexed: DataFrame, size: int, replicas: int, index: str = "idx") -> DataFrame:
    each = per_replica(size, replicas)
    return with_batch(indexed, size, index).withColumn("replica", F.floor(F.col("slot") / each).cast("int"))


def epoch_shuffle(examples: DataFrame, keys: list[str], seed: int, epoch: int) -> DataFrame:
    """A full shuffle, with a different order in every epoch."""
    return dense_index(examples, keys, seed + epoch)
