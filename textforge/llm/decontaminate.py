"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most ``longest`` words, documents into passages of
``fit_words`` words.  A randomised singular value decomposition of the passages' TF-IDF matrix
is computed in one distributed pass over all documents: terms are hashed to a fixed number of
rows, every passage adds a^T (a Omega), and the Nystroem formula turns the sum into the leading
right singular vectors (Gram matrix sketch; sums are integers, so they do not depend on order).
The first of them tell languages and common words apart, not passages, and are left out.

Each document word then has a latent vector, and a window's vector is a difference of running
sums.  Windows as long as a benchmark passage are compared with it by cosine; those above
``cosine`` are checked on their words: the longest common subsequence with the passage, by bit
parallel steps, must cover ``copy`` of it, or ``paraphrase`` of it if the answer (its last
words) is there as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class LatentSettings:
    terms: int = 1 << 13
    leading: int = 8  # directions left out: languages and common words, which all passages share
    rank: int = 24
    oversample: int = 8
    fit_words: int = 64
    shortest: int = 8  # words of a benchmark passage; shorter items are too common to search
    longest: int = 60
    stride: float = 0.25  # of the window's length
    cosine: float = 0.65
    copy: float = 0.8
    paraphrase: float = 0.6
    answer_words: int = 6
    answer: float = 0.5
    item_block: int = 4096
    seed: int = 5

    @property
    def width(self) -> int:
        return self.leading + self.rank + self.oversample


CHUNK = 6 << 20
PART_WORDS = 1 << 17  # words that a search holds running sums of: 8 bytes a direction and word
_FIX = 1 << 16  # fixed-point factor of the sketch


def _hashed_words(texts: pa.Array, s: LatentSettings) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, 64-bit hashes) of each text's words: lower case, signs left out."""
    offsets, codes, dictionary = arrays.plain_words(texts)
    lowered = pc.utf8_lower(dictionary)
    return offsets, arrays.byte_hashes(lowered, s.seed)[codes] if len(codes) else np.empty(0, np.uint64)


def _terms(hashed: np.ndarray, s: LatentSettings) -> np.ndarray:
    return (arrays.mix(hashed) % np.uint64(s.terms)).astype(np.int64)


def _passage_terms(offsets: np.ndarray, hashed: np.ndarray, s: LatentSettings) -> tuple[np.ndarray, np.ndarray, int]:
    """(passage, term) of the distinct terms of every passage, in this order, and the number of passages.

    Passages do not cross documents.  A term counts once in a passage, so that no repeated
    word makes a direction of its own.
    """
    per_text = -(-np.diff(offsets) // s.fit_words)
    first = np.cumsum(per_text) - per_text
    owner = arrays.spans_of(offsets)
    place = np.arange(offsets[-1]) - offsets[owner]
    total = int(per_text.sum())
    rows = np.full((total, s.fit_words), s.terms, np.uint16 if s.terms < 1 << 16 else np.int64)
    rows[first[owner] + place // s.fit_words, place % s.fit_words] = _terms(hashed, s)
    rows.sort(axis=1)
    fresh = rows < s.terms
    fresh[:, 1:] &= rows[:, 1:] != rows[:, :-1]
    return np.nonzero(fresh)[0], rows[fresh], total


def _frequencies(s: LatentSettings):
    def run(batches):
        found, total = np.zeros(s.terms, np.int64), 0
        for batch in arrays.joined(batches, limit=CHUNK):
            offsets, hashed = _hashed_words(arrays.text_array(batch.column("text")), s)
            if not len(hashed):
                continue
            _, terms, passages = _passage_terms(offsets, hashed, s)
            found += np.bincount(terms, minlength=s.terms)
            total += passages
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, s.terms)), pa.array(np.append(total, found))], names=["term", "n"])
        arrays.release()

    return run


def inverse_frequencies(rows: DataFrame, s: LatentSettings) -> np.ndarray:
    """IDF per term row over all passages; a vector of fixed size."""
    counts = rows.select("text").mapInArrow(_frequencies(s), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(s.terms + 1)
    found[counts.column("term").to_numpy() + 1] = counts.column("n").to_numpy()
    return np.log((1 + found[0]) / (1 + found[1:]))


def _omega(s: LatentSettings) -> np.ndarray:
    return np.random.default_rng(s.seed).standard_normal((s.terms, s.width)).astype(np.float32)


def _sketch(idf: np.ndarray, s: LatentSettings):
    def run(batches):
        width = s.width
        omega, weight = _omega(s) * idf[:, None].astype(np.float32), idf.astype(np.float32)
        total = np.zeros((s.terms, width), np.int64)
        for batch in arrays.joined(batches, limit=CHUNK):
            offsets, hashed = _hashed_words(arrays.text_array(batch.column("text")), s)
            if not len(hashed):
                continue
            passage, terms, _ = _passage_terms(offsets, hashed, s)
            starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
            norm = np.sqrt(np.add.reduceat(weight[terms] ** 2, starts)) + 1e-6
            order = np.argsort(terms, kind="stable")
            grouped = terms[order]
            heads = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]]))
            part = np.zeros((s.terms, width))
            for j in range(width):  # column by column, so that a chunk's words need no matrix
                column = np.add.reduceat(omega[terms, j], starts) / (norm * norm)
                part[grouped[heads], j] = np.add.reduceat(column[passage[order]], heads)
            total += np.rint(part * idf[:, None] * _FIX).astype(np.int64)
        found = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(found), *(pa.array(total[found, j]) for j in range(width))], names=["term", *(f"y{j}" for j in range(width))])
        del total
        arrays.release()

    return run


def latent_terms(rows: DataFrame, s: LatentSettings) -> np.ndarray:
    """IDF-weighted latent vector of each term row: terms x rank, a matrix of fixed size."""
    idf = inverse_frequencies(rows, s)
    width = s.width
    names = [f"y{j}" for j in range(width)]
    sums = rows.select("text").mapInArrow(_sketch(idf, s), "term long, " + ", ".join(f"{c} long" for c in names))
    found = sums.groupBy("term").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    y = np.zeros((s.terms, width))
    if found.num_rows:
        y[found.column("term").to_numpy()] = np.stack([found.column(c).to_numpy() for c in names], axis=1) / _FIX
    omega = _omega(s).astype(float)
    shift = 1e-7 * np.linalg.norm(y) + 1e-12
    y += shift * omega
    small = omega.T @ y
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    keep = values > values.max() * 1e-10
    basis, sizes, _ = np.linalg.svd(y @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return (basis[:, s.leading : s.leading + s.rank] * idf[:, None]).astype(np.float32)


@dataclass(frozen=True)
class _Items:
    """Passages of a block of items: one row of each array per passage."""

    item: np.ndarray
    words: list[np.ndarray]
    vectors: np.ndarray
    lengths: np.ndarray


def _item_passages(ids, texts: pa.Array, latent: np.ndarray, s: LatentSettings) -> _Items:
    offsets, hashed = _hashed_words(texts, s)
    items, words = [], []
    for k, item in enumerate(ids):
        own = hashed[offsets[k] : offsets[k + 1]]
        if len(own) < s.shortest or item is None:
            continue
        for part in np.array_split(own, -(-len(own) // s.longest)):
            items.append(item)
            words.append(part)
    vectors = np.stack([latent[_terms(w, s)].sum(0) for w in words]) if words else np.zeros((0, latent.shape[1]), np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    return _Items(np.array(items, np.int64), words, vectors.astype(np.float32), np.array([len(w) for w in words], np.int64))


def common_subsequences(masks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Lengths of longest common subsequences, by bits.

    masks[p, t] has bit i where word t of window p is word i of its passage (at most 63 words).
    """
    row = np.full(len(masks), ~np.uint64(0))
    for t in range(masks.shape[1]):
        met = row & masks[:, t]
        row = (row + met) | (row - met)
    full = (np.uint64(1) << lengths.astype(np.uint64)) - np.uint64(1)
    return np.bitwise_count(~row & full).astype(np.int64)


def _masks(windows: np.ndarray, passage: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bits of each window word in its passage, by one search in the sorted (passage, word) keys."""
    wanted = arrays.mix(windows + arrays.mix(passage.astype(np.uint64) + np.uint64(1))[:, None])
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, bits[at], np.uint64(0))


def _key_table(items: _Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, bits of the whole passage, bits of its answer)."""
    n = len(items.words)
    owner = np.repeat(np.arange(n), items.lengths)
    place = np.concatenate([np.arange(len(w)) for w in items.words])
    key = arrays.mix(np.concatenate(items.words) + arrays.mix(owner.astype(np.uint64) + np.uint64(1)))
    keys, which = np.unique(key, return_inverse=True)
    bits = np.zeros(len(keys), np.uint64)
    np.bitwise_or.at(bits, which, np.uint64(1) << place.astype(np.uint64))
    return keys, bits, place


def _parts(batches, s: LatentSettings):
    """(ids, offsets, hashed words) of documents with at most PART_WORDS words, one document at least."""
    for batch in arrays.joined(batches, limit=CHUNK):
        offsets, hashed = _hashed_words(arrays.text_array(batch.column("text")), s)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PART_WORDS, side="right")) - 1)
            yield batch.column("id").slice(start, stop - start), offsets[start : stop + 1] - offsets[start], hashed[offsets[start] : offsets[stop]]
            start = stop


def _search(items: _Items, latent: np.ndarray, s: LatentSettings):
    classes = [np.flatnonzero((items.lengths >= a) & (items.lengths < b)) for a, b in zip((0, 11, 15, 20, 27, 36, 48), (11, 15, 20, 27, 36, 48, 1 << 30))]
    classes = [c for c in classes if len(c)]
    keys, bits, _ = _key_table(items)
    tail = np.minimum(s.answer_words, items.lengths)
    answer_bits = ((np.uint64(1) << tail.astype(np.uint64)) - np.uint64(1)) << (items.lengths - tail).astype(np.uint64)

    def check(hashed, low, high, passage):
        """(whole, answer) LCS of each candidate window [low, high) with its passage."""
        width = int((high - low).max())
        at = low[:, None] + np.arange(width)
        inside = at < high[:, None]
        masks = np.where(inside, _masks(hashed[np.minimum(at, len(hashed) - 1)], passage, keys, bits), np.uint64(0))
        whole = common_subsequences(masks, items.lengths[passage])
        shifted = (masks & answer_bits[passage][:, None]) >> (items.lengths - tail)[passage].astype(np.uint64)[:, None]
        return whole, common_subsequences(shifted, tail[passage])

    def run(batches):
        for ids, offsets, hashed in _parts(batches, s):
            terms = _terms(hashed, s)
            sums = np.zeros((latent.shape[1], len(hashed) + 1), np.float64)
            for running, values in zip(sums, latent.T):  # one direction at a time, along memory
                np.cumsum(np.take(values, terms), dtype=np.float64, out=running[1:])
            found = []
            for chosen in classes:
                width = int(np.median(items.lengths[chosen]))
                step = max(1, int(width * s.stride))
                n = np.diff(offsets)
                per_text = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - width) // step)))
                ends = np.concatenate([[0], np.cumsum(per_text)])
                owner = arrays.spans_of(ends)
                low = offsets[owner] + (np.arange(ends[-1]) - ends[owner]) * step
                high = np.minimum(low + width, offsets[owner + 1])
                for a in range(0, len(low), 1 << 17):
                    b = min(a + (1 << 17), len(low))
                    vector = np.stack([running[high[a:b]] - running[low[a:b]] for running in sums]).astype(np.float32)
                    vector /= np.linalg.norm(vector, axis=0) + 1e-9
                    for c in range(0, len(chosen), 512):
                        score = vector.T @ items.vectors[chosen[c : c + 512]].T
                        w, p = np.nonzero(score >= s.cosine)
                        if len(w):
                            found.append((owner[a:b][w], low[a:b][w], high[a:b][w], chosen[c : c + 512][p], score[w, p]))
            if not found:
                continue
            owner, low, high, passage, score = (np.concatenate(x) for x in zip(*found))
            margin = np.maximum(2, (items.lengths[passage] * s.stride).astype(np.int64) + 2)
            low, high = np.maximum(low - margin, offsets[owner]), np.minimum(high + margin, offsets[owner + 1])
            parts = [check(hashed, low[k : k + 65536], high[k : k + 65536], passage[k : k + 65536]) for k in range(0, len(low), 65536)]
            whole, answer = (np.concatenate(x) for x in zip(*parts))
            share = whole / items.lengths[passage]
            hit = (share >= s.copy) | ((share >= s.paraphrase) & (answer >= s.answer * tail[passage]))
            if hit.any():
                rows = np.flatnonzero(hit)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner[rows])), pa.array(items.item[passage[rows]]), pa.array((low - offsets[owner])[rows]),
                     pa.array((high - offsets[owner])[rows]), pa.array(score[rows].astype(float)), pa.array(share[rows])], names=_NAMES)
        arrays.release()

    return run


_FOUND = "doc_id long, item_id long, word_start long, word_end long, cosine double, covered double"
_NAMES = [part.split()[0] for part in _FOUND.split(", ")]


def contaminated(docs: DataFrame, benchmark: DataFrame, s: LatentSettings = LatentSettings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, word_start, word_end, cosine, covered): the best match of each pair.

    Items meet all documents in blocks of ``item_block``.  Null or short items and null texts
    match nothing; rows that share a doc_id are searched each and reported as one document; rows
    without a doc_id are reported under null.  An empty benchmark or table gives no rows.
    """
    rows = arrays.text_rows(docs, id_column, text_column)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    blocks = max(1, -(-items.count() // s.item_block))
    latent = latent_terms(rows, s)
    found = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").toArrow()
        made = _item_passages(block.column("item_id").to_pylist(), arrays.text_array(block.column("text").combine_chunks()), latent, s) if block.num_rows else None
        if made is None or not len(made.item):
            continue
        part = rows.mapInArrow(_search(made, latent, s), _FOUND)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], _FOUND)
    best = F.max_by(F.struct("word_start", "word_end", "cosine", "covered"), F.struct("covered", "cosine", -F.col("word_start")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("_b")).select("doc_id", "item_id", "_b.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, s: LatentSettings = LatentSettings(), small: int = 500_000) -> DataFrame:
    """The rows of ``docs`` without a match, with all their columns; rows without a doc_id stay.

    The list of matches is broadcast if it is short, else joined by a shuffle.
    """
    hits = materialize(contaminated(docs.where("doc_id IS NOT NULL"), benchmark, s).select(F.col("doc_id").alias("_hit")).distinct())
    if hits.count() <= small:
        hits = F.broadcast(hits)
    return docs.join(hits, docs["doc_id"] == hits["_hit"], "left_anti")
