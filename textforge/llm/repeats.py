"""Removal of repeated passages: windows counted exactly by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is the smallest hash
among its ``mer``-word pieces, the leftmost of equal ones.  Consecutive windows with the same
minimiser travel as one packed string (a run) to the bucket of that minimiser's value, so equal
windows always meet; a bucket sorts its windows and counts them on the words themselves.

* Documents are stored once in numbered blocks, compressed, next to their minimisers.  Only
  runs whose minimiser occurs in a second run are packed: all other windows are unique.
* Equal strings of a block travel once, with their number, so copies are counted before the
  shuffle.  The answer to a string is a bit mask of its repeated windows; the block applies it
  to every run that holds the string.
* A minimiser of more than ``hot_runs`` runs is split: its windows travel as 128-bit
  fingerprints, one for each distinct window of a block, and are summed by fingerprint.  No
  bucket grows with the frequency of a passage.

Only a block, or one document that is longer than a block, is ever held by a task.
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

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class RepeatSettings:
    window: int = 35
    hot_runs: int = 200
    block_bytes: int = 1 << 20
    bucket_bytes: int = 4 << 20
    seed: int = 11

    @property
    def mer(self) -> int:
        """Words of a minimiser; a run has at most 62 windows, which fit the bits of a mask."""
        return max(self.window // 4, self.window - 61, 1)


_PRIME = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_BLOCK = "block long, data binary, minis array<long>, counts array<int>"
_STRING = "mini long, block long, run int, text binary, n int, hi long, lo long, place int"
_MASK = "block long, run int, mask long, split boolean"
_KEPT = "id long, n_words long, n_removed long, kept string"


class Words:
    """The words of some texts: their bytes joined by single spaces, hashes, and runs of windows."""

    def __init__(self, texts: pa.Array, s: RepeatSettings):
        self.s = s
        self.offsets, self.codes, dictionary = arrays.words(texts)
        sizes = np.asarray(pc.binary_length(dictionary), np.int64)[self.codes] if len(self.codes) else np.empty(0, np.int64)
        raw, ends = arrays.utf8(dictionary)
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.flat = np.full(self.starts[-1], 32, np.uint8)
        self.flat[_ranges(self.starts[:-1], sizes)] = raw[_ranges(ends[:-1][self.codes], sizes)]
        self._dictionary = dictionary
        self._find_runs()

    def _find_runs(self) -> None:
        window, mer = self.s.window, self.s.mer
        per_doc = np.maximum(np.diff(self.offsets) - window + 1, 0)
        at = _ranges(self.offsets[:-1], per_doc)
        if not len(at):
            self.first = self.count = np.empty(0, np.int64)
            self.mini = np.empty(0, np.int64)
            return
        hashed = self.hashes(self.s.seed)
        value = np.zeros(len(hashed) - mer + 1, np.uint64)
        for k in range(mer):
            value = value * _PRIME + hashed[k : k + len(value)]
        value = arrays.mix(value)
        least = _first_least(value, window - mer + 1)[at]
        breaks = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        self.first = at[breaks]
        self.count = np.diff(np.append(breaks, len(at)))
        self.mini = value[least[breaks]].view(np.int64)

    def hashes(self, seed: int) -> np.ndarray:
        return arrays.byte_hashes(self._dictionary, seed)[self.codes]

    def packed(self, runs: np.ndarray) -> pa.Array:
        """The words of each run's windows as one string."""
        begin = self.starts[self.first[runs]]
        sizes = self.starts[self.first[runs] + self.count[runs] + self.s.window - 1] - 1 - begin
        return arrays.binaries(self.flat[_ranges(begin, sizes)], np.concatenate([[0], np.cumsum(sizes)]))

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first words, places in ``runs``) of the windows of some runs."""
        return _ranges(self.first[runs], self.count[runs]), np.repeat(np.arange(len(runs)), self.count[runs])

    def fingerprints(self, starts: np.ndarray) -> np.ndarray:
        """128 bits of each window, as two columns."""
        out = np.zeros((len(starts), 2), np.uint64)
        for side, factor in enumerate((_PRIME, _OTHER)):
            hashed = self.hashes(self.s.seed + 1 + side)
            for k in range(self.s.window):
                out[:, side] = out[:, side] * factor + hashed[starts + k]
        return arrays.mix(out.reshape(-1)).view(np.int64).reshape(-1, 2)

    def covered(self, window_starts: np.ndarray) -> np.ndarray:
        """Which words lie in a window that starts at one of the places."""
        steps = np.bincount(window_starts, minlength=len(self.codes) + 1) - np.bincount(
            window_starts + self.s.window, minlength=len(self.codes) + 1)[: len(self.codes) + 1]
        return np.cumsum(steps)[: len(self.codes)] > 0


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of sizes[0] places, then those of the next range."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - sizes), sizes)


def _first_least(value: np.ndarray, width: int) -> np.ndarray:
    """For each place, the place of the first smallest of the ``width`` values from there on."""
    least, place, have = value, np.arange(len(value)), 1
    while have < width:
        step = min(have, width - have)
        other, there = least[step:], place[step:]
        left = least[: len(other)] <= other
        place = np.where(left, place[: len(other)], there)
        least = np.where(left, least[: len(other)], other)
        have += step
    return place


def _sealed(part: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return sink.getvalue().to_pybytes()


def _opened(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _blocks(s: RepeatSettings):
    def run(batches):
        task = TaskContext.get().partitionId()
        for number, part in enumerate(arrays.joined(batches, limit=s.block_bytes)):
            mini, counts = np.unique(Words(arrays.text_array(part.column("text")), s).mini, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number]), pa.array([_sealed(part)], pa.binary()),
                 arrays.lists(mini, np.array([0, len(mini)])), arrays.lists(counts.astype(np.int32), np.array([0, len(mini)]))],
                names=["block", "data", "minis", "counts"])

    return run


def _strings(s: RepeatSettings):
    """The packed strings of a block's runs whose minimiser occurs elsewhere, or their windows."""
    names = [part.split()[0] for part in _STRING.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]

    def rows(height: int, block: int, **columns) -> pa.Table:
        columns["block"] = np.full(height, block)
        return pa.table([pa.array(columns[c], k) if c in columns else pa.nulls(height, k) for c, k in zip(names, kinds)], names=names)

    def run(stored: pa.Table, wanted: pa.Table) -> pa.Table:
        if not stored.num_rows or not wanted.num_rows:
            return rows(0, 0)
        block = stored.column("block")[0].as_py()
        words = Words(arrays.text_array(_opened(stored.column("data")[0].as_py()).column("text")), s)
        minis, hot = wanted.column("mini").to_numpy(), wanted.column("hot").to_numpy(zero_copy_only=False).astype(bool)
        runs = np.flatnonzero(np.isin(words.mini, minis[~hot]))
        out = []
        if len(runs):
            codes, distinct = arrays.encode(words.packed(runs))
            _, heads, n = np.unique(codes, return_index=True, return_counts=True)
            out.append(rows(len(heads), block, mini=words.mini[runs[heads]], run=runs[heads].astype(np.int32),
                            text=distinct, n=np.minimum(n, 2).astype(np.int32)))
        runs = np.flatnonzero(np.isin(words.mini, minis[hot]))
        if len(runs):
            starts, owner = words.windows(runs)
            prints = words.fingerprints(starts)
            _, heads, n = np.unique(np.ascontiguousarray(prints).view("V16").reshape(-1), return_index=True, return_counts=True)
            owner, (hi, lo) = runs[owner], prints[heads].T
            out.append(rows(len(heads), block, mini=words.mini[owner[heads]], run=owner[heads].astype(np.int32), hi=hi, lo=lo,
                            place=(starts[heads] - words.first[owner[heads]]).astype(np.int32), n=np.minimum(n, 2).astype(np.int32)))
        return pa.concat_tables(out) if out else rows(0, block)

    return run


def window_ranks(codes: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal windows of ``codes``, in sorted order of the windows; places whose window would
    run over the end are left out.  Ranks of doubled lengths are joined in pairs."""
    rank, have = codes.astype(np.int64), 1
    while have < window:
        step = min(have, window - have)
        pair = rank[: len(rank) - step] * (int(rank.max(initial=0)) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].reshape(-1)
        have += step
    return rank


def _counted(s: RepeatSettings):
    """Masks of the repeated windows of a bucket's strings."""

    def run(table: pa.Table) -> pa.Table:
        which, distinct = arrays.encode(table.column("text").combine_chunks().cast(pa.string()))
        weight = np.bincount(which, table.column("n").to_numpy()).astype(np.int64)
        offsets, codes, _ = arrays.words(distinct)
        counts = np.diff(offsets) - s.window + 1
        starts = _ranges(offsets[:-1], counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        rank = window_ranks(codes, s.window)[starts]
        repeated = np.bincount(rank, weight[owner])[rank] > 1
        place = starts - offsets[:-1][owner]
        mask = np.zeros(len(counts), np.int64)
        np.bitwise_or.at(mask, owner[repeated], np.int64(1) << place[repeated])
        some = np.flatnonzero(mask[which])
        found = table.select(["block", "run"]).take(pa.array(some)).append_column("mask", pa.array(mask[which][some]))
        return found.append_column("split", pa.array(np.zeros(len(some), bool)))

    return run


def _by_string(words: Words, heads: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The repeated windows of all runs whose string is that of an answered run."""
    runs = np.flatnonzero(np.isin(words.mini, words.mini[heads]))
    codes, distinct = arrays.encode(words.packed(runs))
    mask_of = np.zeros(len(distinct), np.int64)
    mask_of[codes[np.searchsorted(runs, heads)]] = mask
    starts, owner = words.windows(runs)
    return starts[mask_of[codes][owner] >> (starts - words.first[runs][owner]) & 1 > 0]


def _by_print(words: Words, heads: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The windows of all runs whose fingerprint is that of an answered window."""
    starts, owner = words.windows(heads)
    answered = words.fingerprints(starts[mask[owner] >> (starts - words.first[heads][owner]) & 1 > 0])
    starts, _ = words.windows(np.flatnonzero(np.isin(words.mini, words.mini[heads])))
    same = np.isin(np.ascontiguousarray(words.fingerprints(starts)).view("V16").reshape(-1), np.ascontiguousarray(answered).view("V16").reshape(-1))
    return starts[same]


def _removed(s: RepeatSettings, with_text: bool):
    """Each document of a block with its kept words."""

    def run(stored: pa.Table, masks: pa.Table) -> pa.Table:
        if not stored.num_rows:
            return pa.table([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.string())], names=["id", "n_words", "n_removed", "kept"])
        part = _opened(stored.column("data")[0].as_py())
        words = Words(arrays.text_array(part.column("text")), s)
        gone = np.zeros(len(words.codes), bool)
        if masks.num_rows:
            heads, mask = masks.column("run").to_numpy(), masks.column("mask").to_numpy()
            split = masks.column("split").to_numpy(zero_copy_only=False).astype(bool)
            gone = words.covered(np.concatenate([_by_string(words, heads[~split], mask[~split]), _by_print(words, heads[split], mask[split])]))
        bounds = words.starts[words.offsets]
        kept = []
        for k in range(part.num_rows):
            a, b = words.offsets[k], words.offsets[k + 1]
            text = words.flat[bounds[k] : bounds[k + 1]]
            if gone[a:b].any():
                text = text[np.repeat(~gone[a:b], np.diff(words.starts[a : b + 1]))]
            kept.append(text[:-1].tobytes())
        n_removed = np.add.reduceat(np.append(gone, False), words.offsets[:-1]) if part.num_rows else gone[:0]
        n_words = np.diff(words.offsets)
        n_removed = np.where(n_words > 0, n_removed, 0).astype(np.int64)
        last = pa.array(kept, pa.binary()).cast(pa.string()) if with_text else pa.array([hashlib.sha256(t).hexdigest() for t in kept])
        return pa.table([part.column("id"), pa.array(n_words), pa.array(n_removed), last], names=["id", "n_words", "n_removed", "kept"])

    return run


def without_repeats(docs: DataFrame, s: RepeatSettings = RepeatSettings(), with_text: bool = True, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the remaining words joined by a space, or its SHA-256.

    Words are runs of characters other than \\x20 and \\x09-\\x0D, unchanged.  A word goes if a window over it
    has the same words as a window that starts anywhere else, in the same document or row as well.  Null texts
    have no words; texts shorter than a window lose nothing.  Rows that share an id, or have none, are documents
    of their own, so equal rows remove each other's windows.  An empty table gives an empty result.
    """
    if s.window < 1:
        raise ValueError("a window has one word at least")
    rows = arrays.text_rows(docs, id_column, text_column)
    stored = materialize(rows.mapInArrow(_blocks(s), _BLOCK))
    posted = stored.select(F.col("block").alias("of"), F.explode(F.arrays_zip("minis", "counts")).alias("p")).select("of", F.col("p.minis").alias("mini"), F.col("p.counts").alias("n"))
    met = posted.groupBy("mini").agg(F.sum("n").alias("runs")).where("runs > 1").select("mini", (F.col("runs") > s.hot_runs).alias("hot"))
    texts = stored.select("block", "data").groupBy("block")
    wanted = posted.select("of", "mini").join(met, "mini").select("of", "mini", "hot")
    strings = materialize(texts.cogroup(wanted.groupBy("of")).applyInArrow(_strings(s), _STRING))
    masks = materialize(_masks(strings, s))
    kept = texts.cogroup(masks.groupBy("block")).applyInArrow(_removed(s, with_text), _KEPT)
    return kept.withColumnRenamed("id", "doc_id")


def _masks(strings: DataFrame, s: RepeatSettings) -> DataFrame:
    """(block, run, mask, split): bits of the repeated windows of a block's strings, or of its windows by fingerprint."""
    whole = strings.where("text IS NOT NULL")
    volume = whole.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    spark = strings.sparkSession
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // s.bucket_bytes))
    sorted_out = whole.select(F.pmod("mini", F.lit(n_buckets)).alias("bucket"), "block", "run", "text", "n").groupBy("bucket").applyInArrow(
        _counted(s), _MASK)
    windows = strings.where("text IS NULL").select("hi", "lo", "block", "run", "place", "n")
    twice = windows.groupBy("hi", "lo").agg(F.sum("n").alias("_n")).where("_n > 1").select("hi", "lo")
    single = windows.join(twice, ["hi", "lo"]).groupBy("block", "run").agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("mask"))
    return sorted_out.unionByName(single.withColumn("split", F.lit(True)))
