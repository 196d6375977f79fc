"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed word and word-pair features, one of the target text (labelled
good and not toxic) and one of all raw text, give each document a log weight: the sum of its
features' log ratios, rare and frequent, below and above one.  Gumbel top-k draws the documents
to keep by these weights.

* Counts come from one pass over all documents; labels of a bounded sample mark target rows.
  A document counts a feature once, so that no single text can carry one, and its own count is
  taken out of both models when it is weighed itself.
* A ratio is a posterior mean.  Target documents hold a feature as often as any other document
  would (one binomial for all), or, with prior probability ``differs``, at a rate of its own with
  a beta prior worth ``strength`` documents.  Chance thus adds little to long texts, and the
  same rule holds for two hundred documents and for a thousand million.
* k is ``share`` of all documents; unless it is given, the draw goes on until it holds ``recall``
  of the documents labelled good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class QualitySettings:
    """``labelled_rows`` bounds the labels that the target model is fit on; ``share`` or ``recall`` ends the draw."""

    word_buckets: int = 1 << 19
    pair_buckets: int = 1 << 20
    labelled_rows: int = 50_000
    differs: float = 1e-3
    strength: float = 1.0
    share: float | None = None
    recall: float = 0.975
    seed: int = 11

    @property
    def size(self) -> int:
        """Words, pairs, and the one feature of repetition."""
        return self.word_buckets + self.pair_buckets + 1


CHUNK = 1 << 20  # bytes of text whose features a task holds
SENT = 1 << 16  # counts that a task sends at a time


def _features(texts: pa.Array, s: QualitySettings) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, owners): each document's distinct hashed words and pairs of neighbouring words."""
    offsets, codes, dictionary = arrays.word_and_sign_runs(texts)
    hashed = arrays.hashes(dictionary, s.seed)[codes]
    owner = arrays.spans_of(offsets)
    words = (hashed % np.uint64(s.word_buckets)).astype(np.int64)
    inside = owner[1:] == owner[:-1]
    pair = arrays.mix(hashed[:-1][inside] * np.uint64(0x9E3779B97F4A7C15) + hashed[1:][inside]) % np.uint64(s.pair_buckets)
    # A word or pair three times in a row is one and the same feature, whichever word it is.
    again = (hashed[2:] == hashed[:-2]) & (owner[2:] == owner[:-2])
    thrice = again[:-3] & again[1:-2] & again[2:-1] & again[3:]
    size = s.size
    found = np.unique(np.concatenate([owner * size + words, owner[1:][inside] * size + s.word_buckets + pair.astype(np.int64),
                                      owner[: len(thrice)][thrice] * size + size - 1]))
    return found % size, found // size


@dataclass(frozen=True)
class Sample:
    """The labelled sample: sorted ids of its good rows, at most ``labelled_rows``; none if it lacks either kind."""

    good_ids: np.ndarray

    def holds(self, ids: pa.Array) -> np.ndarray:
        """Which ids are labelled good; a null id is not."""
        found = np.isin(np.asarray(ids.fill_null(0)).astype(np.int64), self.good_ids)
        return found & np.asarray(ids.is_valid())


def labelled_sample(labels: DataFrame, s: QualitySettings) -> Sample:
    """At most ``labelled_rows`` labelled documents, in the order of a hash."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        ((F.min("quality") >= 1) & (F.max("toxic") <= 0)).alias("good"))
    rows = known.orderBy(F.xxhash64("label_id", F.lit(s.seed)), "label_id").limit(s.labelled_rows).toArrow()
    good = np.asarray(rows.column("good")).astype(bool)
    both = good.any() and not good.all()
    return Sample(np.sort(rows.column("label_id").to_numpy()[good]) if both else np.empty(0, np.int64))


def _counted(sample: Sample, s: QualitySettings):
    size = s.size

    def run(batches):
        raw, target = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)  # the last place counts documents
        for batch in arrays.chunks(batches, limit=CHUNK):
            buckets, owner = _features(arrays.text_array(batch.column("text")), s)
            good = sample.holds(batch.column("id"))
            raw[:size] += np.bincount(buckets, minlength=size)
            target[:size] += np.bincount(buckets[good[owner]], minlength=size)
            raw[size] += len(good)
            target[size] += good.sum()
        found = np.flatnonzero(raw)
        for at in range(0, len(found), SENT):
            part = found[at : at + SENT]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(raw[part].astype(np.int64)), pa.array(target[part].astype(np.int64))], names=["bucket", "raw", "target"])
        del raw, target, found
        arrays.release()

    return run


_log_gamma = np.frompyfunc(math.lgamma, 1, 1)


def log_ratios(raw: np.ndarray, target: np.ndarray, rate: float, s: QualitySettings) -> np.ndarray:
    """Posterior mean of log(rate of a feature / ``rate``) if ``target`` of ``raw`` documents that hold it are target rows."""
    pairs, place = np.unique(np.stack([raw, target]), axis=1, return_inverse=True)
    r, t = pairs.astype(float)
    a, b = s.strength * rate, s.strength * (1 - rate)
    gamma = lambda x: np.asarray(_log_gamma(x), dtype=float)
    own = gamma(t + a) + gamma(r - t + b) - gamma(r + s.strength) - math.lgamma(a) - math.lgamma(b) + math.lgamma(s.strength)
    common = t * math.log(rate) + (r - t) * math.log1p(-rate)
    odds = own - common + math.log(s.differs / (1 - s.differs))
    probability = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    return (probability * (np.log((t + a) / (r + s.strength)) - math.log(rate)))[place.ravel()]


def fit(docs: DataFrame, sample: Sample, s: QualitySettings) -> tuple[np.ndarray, int]:
    """(ratios, number of documents): log ratio per bucket for a document outside the target (row 0) and in it (row 1).

    Each row leaves out the document weighed: one count of the raw text, and in row 1 one of the target.
    """
    counts = arrays.text_rows(docs).mapInArrow(_counted(sample, s), "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = counts.toArrow()
    raw, target = np.zeros(s.size + 1, np.int64), np.zeros(s.size + 1, np.int64)
    at = found.column("bucket").to_numpy()
    raw[at], target[at] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    n, n_target = int(raw[-1]), int(target[-1])
    if not 0 < n_target < n:
        return np.zeros((2, s.size), np.float32), n
    others = np.maximum(raw[:-1] - 1, 0)
    rows = [log_ratios(others, np.clip(target[:-1] - own, 0, others), n_target / n, s) for own in (0, 1)]
    return np.stack(rows).astype(np.float32), n


def _weighed(ratio: np.ndarray, sample: Sample, s: QualitySettings, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(log weight, Gumbel key) of each row; the noise is a function of the row's id and text."""
    texts = arrays.text_array(batch.column("text"))
    buckets, owner = _features(texts, s)
    good = sample.holds(batch.column("id")).astype(np.int64)
    weight = np.bincount(owner, weights=ratio[good[owner], buckets], minlength=len(texts))[: len(texts)] if len(buckets) else np.zeros(len(texts))
    ids = np.asarray(batch.column("id").fill_null(-1)).astype(np.int64).view(np.uint64)
    spread = arrays.mix(arrays.hashes(texts, s.seed) + arrays.mix(ids + np.uint64(s.seed)))
    uniform = (spread >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54
    return weight, weight - np.log(-np.log(uniform))


def _scored(ratio: np.ndarray, sample: Sample, s: QualitySettings):
    def run(batches):
        for batch in arrays.chunks(batches, limit=CHUNK):
            weight, key = _weighed(ratio, sample, s, batch)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sample.holds(batch.column("id"))), pa.array(weight), pa.array(key)], names=["doc_id", "good", "log_weight", "key"])
        arrays.release()

    return run


def kth_largest(scored: DataFrame, k: int, column: str = "key", bins: int = 4096) -> float:
    """The k-th largest value, by counting in ever finer bins: no sort, no collected rows."""
    low, high = scored.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int") if width > 0 else F.lit(0)
        inside = scored.where((F.col(column) >= low) & (F.col(column) <= high))
        above = scored.where(F.col(column) > high).count()
        rows = inside.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("b")).collect()
        for r in rows:
            above += r.n
            if above >= k:
                break
        if (r.lo, r.hi) == (low, high):
            return low
        low, high = r.lo, r.hi
        if above - r.n + 1 == k:
            return high
        if above == k:
            return low
    return low


@dataclass(frozen=True)
class Resampling:
    ratio: np.ndarray
    sample: Sample
    threshold: float
    scored: DataFrame


def resample(docs: DataFrame, labels: DataFrame, s: QualitySettings = QualitySettings()) -> Resampling:
    """Fit the models and find the key of the k-th drawn document."""
    sample = labelled_sample(labels, s)
    ratio, n = fit(docs, sample, s)
    scored = materialize(arrays.text_rows(docs).mapInArrow(_scored(ratio, sample, s), "doc_id long, good boolean, log_weight double, key double"))
    if s.share is not None:
        k = round(s.share * n)
        threshold = kth_largest(scored, k) if k else float("inf")
    else:
        good = scored.where("good")
        k = math.ceil(s.recall * good.count()) if ratio.any() else 0
        threshold = kth_largest(good, k) if k else float("-inf")
    return Resampling(ratio, sample, threshold, scored)


def sampled_documents(docs: DataFrame, labels: DataFrame, s: QualitySettings = QualitySettings()) -> DataFrame:
    """(doc_id, log_weight, key, kept) of the documents that the draw keeps; kept is always true.

    Null texts count as empty, with log weight 0.  Rows that share a doc_id are drawn each for
    themselves, equal rows alike; keys that tie with the k-th stay.  Without labels of both
    kinds every document stays unless ``share`` says otherwise.
    """
    made = resample(docs, labels, s)
    return made.scored.where(F.col("key") >= made.threshold).select("doc_id", "log_weight", "key", F.lit(True).alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame, s: QualitySettings = QualitySettings()) -> DataFrame:
    """The rows of ``docs`` that the draw keeps, with all their columns."""
    made = resample(docs, labels, s)
    ratio, sample, threshold, id_at, text_at = made.ratio, made.sample, made.threshold, docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches):
        for whole in batches:
            text = pa.compute.fill_null(whole.column(text_at), "")
            slim = pa.RecordBatch.from_arrays([whole.column(id_at).cast(pa.int64()), text], names=["id", "text"])
            at = 0
            for part in arrays.chunks(iter([slim]), limit=CHUNK):
                yield whole.slice(at, part.num_rows).filter(pa.array(_weighed(ratio, sample, s, part)[1] >= threshold))
                at += part.num_rows
        arrays.release()

    return docs.mapInArrow(run, docs.schema)
