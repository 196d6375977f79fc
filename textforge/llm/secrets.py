"""Secrets in texts: fixed patterns and a randomness test battery.

Three patterns give the base spans (assign, access, hex).  Beyond them, every maximal run of
key characters (letters, digits, + / _ -) is a candidate; its encoding is inferred, and a battery asks how random it is:

* alphabet uniformity: chi-squared of the character classes against the encoding's alphabet,
* runs: changes between letter classes (lower, upper, digit, sign) against independent draws,
* serial correlation: product moment of neighbouring characters.

Each test gives the probability that ordinary key-like text of the same length looks that
random.  The tests' values are combined per candidate, and Benjamini-Hochberg over all candidates of all
documents, weighted by length class, keeps the share of false discoveries below ``fdr``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize

# The base patterns' keywords and expressions, and the kinds in listed order.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")


@dataclass(frozen=True)
class SecretSettings:
    min_length: int = 20
    fdr: float = 0.01
    bins: int = 2048
    per_bin: float = 0.25  # of -ln p


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True
_KEY = np.zeros(256, bool)
_KEY[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True


def _runs(mask: np.ndarray, breaks: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least ``least`` true bytes that cross no break."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    # A run over a document's start is cut there.
    inner = breaks[1:-1]
    at = np.searchsorted(starts, inner, side="right") - 1
    crossing = inner[(at >= 0) & (inner > starts[np.maximum(at, 0)]) & (inner < ends[np.maximum(at, 0)])] if len(starts) else inner[:0]
    starts, ends = np.sort(np.append(starts, crossing)), np.sort(np.append(ends, crossing))
    long = ends - starts >= least
    return starts[long], ends[long]


def _found(buffer: bytes, word: bytes) -> list[int]:
    out, at = [], buffer.find(word)
    while at >= 0:
        out.append(at)
        at = buffer.find(word, at + 1)
    return out


def _assigned(buffer: bytes, lower: bytes, breaks: np.ndarray) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of ASSIGN in each document.

    A match begins with a keyword, so the expression is tried where one stands.
    """
    places = sorted(p for word in KEYWORDS for p in _found(lower, word))
    if not places:
        return []
    stops = breaks[np.searchsorted(breaks, places, side="right")].tolist()
    out, free = [], 0
    for at, stop in zip(places, stops):
        if at >= free and (m := ASSIGN.match(buffer, at, stop)):
            free = m.end()
            if m.end(2) - m.start(2) >= 6:
                out.append((at, free))
    return out


def base_spans(raw: np.ndarray, breaks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Byte starts and ends of each base kind over concatenated documents."""
    buffer = raw.tobytes()
    assign = _assigned(buffer, _LOWER[raw].tobytes(), breaks)
    access, free = [], 0
    for at in _found(buffer, b"AKIA"):
        if at >= free and (m := ACCESS.match(buffer, at, int(breaks[np.searchsorted(breaks, at, side="right")]))):
            free = m.end()
            if m.end() - at >= 20:
                access.append((at, free))
    pairs = [np.array(x, np.int64).reshape(-1, 2) for x in (assign, access)]
    return [(x[:, 0], x[:, 1]) for x in pairs] + [_runs(_HEX[raw], breaks, 24)]


# Encodings as (name, alphabet size); a candidate's is the smallest that holds its characters.
ENCODINGS = (("digits", 10), ("hex", 16), ("base32", 32), ("lower", 36), ("alnum", 62), ("base64", 64))
_CLASS = np.full(256, 3, np.int8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_DIGIT = _CLASS == 2
_HEXANY = np.zeros(256, bool)
_HEXANY[[*range(48, 58), *range(97, 103), *range(65, 71)]] = True
_B32 = np.zeros(256, bool)
_B32[[*range(65, 91), *range(50, 56), 61]] = True


def _survival(z: np.ndarray) -> np.ndarray:
    return np.fromiter((0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()), float, len(z))


def battery(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(-ln p, alphabet size) per candidate: p bounds how likely ordinary text is as random.

    Ordinary key-like text (words, identifiers, numbers written out) stays in one letter class
    for long, uses few characters often, and repeats neighbouring pairs.  Each test has its
    null distribution from that text: class changes are rarer than one in eight characters,
    and the chance that two of its characters are equal is at least 0.07.
    """
    n = ends - starts
    owner = np.repeat(np.arange(len(n)), n)
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    chars = raw[at]
    heads = np.cumsum(n) - n

    def held(mask):
        return np.logical_and.reduceat(mask[chars], heads)

    kinds = _CLASS[chars]
    has = [np.logical_or.reduceat(kinds == k, heads) for k in range(4)]
    size = np.select([held(_DIGIT), held(_HEXANY), held(_B32), ~has[1] & ~has[3], ~has[3]], [10, 16, 32, 36, 62], 64)
    # Uniformity: pairs of equal characters; chi-squared of the counts is a linear function of it.
    pair = np.bincount(owner * 256 + chars, minlength=256 * len(n)).reshape(len(n), 256).astype(float)
    equal = (pair * (pair - 1)).sum(1) / (n * (n - 1.0))
    chi = size * (equal * (n - 1) + 1) - n  # chi-squared against the uniform alphabet
    ordinary = np.maximum(0.07, 1.3 / size)
    spread = np.sqrt(2 * ordinary * (1 - ordinary) / (n * (n - 1.0)) + 0.0008 / n)
    too_uneven = _survival((chi - (size - 1)) / np.sqrt(2.0 * (size - 1)))
    p_uniform = _survival((ordinary - equal) / spread)
    # Runs of letter classes.
    same_owner = owner[1:] == owner[:-1]
    changes = np.bincount(owner[1:][same_owner & (kinds[1:] != kinds[:-1])], minlength=len(n))
    expected = (n - 1) * 0.125
    p_runs = _survival((changes - expected) / np.sqrt(expected * 0.875 + 0.25))
    # Serial correlation of neighbours, which in words comes from vowels and consonants in turn.
    value = chars.astype(float)
    mean, square = (np.add.reduceat(x, heads) / n for x in (value, value * value))
    product = np.bincount(owner[1:][same_owner], weights=(value[1:] * value[:-1])[same_owner], minlength=len(n)) / np.maximum(n - 1, 1)
    variance = np.maximum(square - mean * mean, 1e-9)
    serial = (product - mean * mean) / variance
    too_serial = 2 * _survival(np.abs(serial + 1.0 / n) * np.sqrt(n))
    # A string that a test finds far from random is ordinary, however the others turn out.
    p = np.clip(p_uniform * p_runs * (1 - np.log(np.maximum(p_uniform * p_runs, 1e-300))), 1e-300, 1.0)
    p[(too_uneven < 1e-4) | (too_serial < 1e-4)] = 1.0
    return -np.log(p), size


_SCANNED = "id long, starts array<int>, ends array<int>, kinds array<int>, scores array<double>"


def _all_spans(raw: np.ndarray, breaks: np.ndarray, s: SecretSettings):
    """(start, end, kind, score) in bytes of all base spans and candidates, unsorted."""
    parts = [(a, b, np.full(len(a), k), np.zeros(len(a))) for k, (a, b) in enumerate(base_spans(raw, breaks))]
    a, b = _runs(_KEY[raw], breaks, s.min_length)
    if len(a):
        parts.append((a, b, np.full(len(a), 3), battery(raw, a, b)[0]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _scan(s: SecretSettings):
    names = ["id", "starts", "ends", "kinds", "scores"]

    def run(batches):
        for batch in arrays.chunks(batches, limit=8 << 20):
            raw, breaks = arrays.utf8(arrays.text_array(batch.column("text")))
            # The number of code points before each byte.
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
            start, end, kind, score = _all_spans(raw, breaks, s)
            owner = np.searchsorted(breaks, start, side="right") - 1
            order = np.lexsort((kind, start, owner))
            start, end, kind, score, owner = (x[order] for x in (start, end, kind, score, owner))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            zero = points[breaks[:-1]][owner] if len(owner) else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), arrays.lists((points[start] - zero).astype(np.int32), ends), arrays.lists((points[end] - zero).astype(np.int32), ends),
                 arrays.lists(kind.astype(np.int32), ends), arrays.lists(score, ends)], names=names)
        arrays.release()

    return run


def length_class(length):
    """Doubling length classes from 16 characters on, as a Column."""
    return F.least(F.floor(F.log2(length / 16.0)), F.lit(8)).cast("int")


def _threshold(scanned: DataFrame, s: SecretSettings) -> dict[int, float]:
    """Per length class, the least -ln p of a discovery: weighted Benjamini-Hochberg over all candidates.

    A class's weight falls with its length, as long runs of key characters are paths and tables
    more often than keys; weights average one.  Candidates are counted in bins of -ln p, at most
    classes * bins rows.
    """
    spans = scanned.select(F.explode(F.arrays_zip("starts", "ends", "kinds", "scores")).alias("x")).where("x.kinds = 3")
    at = F.least(F.floor(F.col("x.scores") / s.per_bin), F.lit(s.bins - 1)).cast("int")
    counts = spans.groupBy(length_class(F.col("x.ends") - F.col("x.starts")).alias("c"), at.alias("b")).count().collect()
    m = sum(r["count"] for r in counts)
    if not m:
        return {}
    sizes: dict[int, int] = {}
    for r in counts:
        sizes[r.c] = sizes.get(r.c, 0) + r["count"]
    raw = {c: 2.0 ** -c for c in sizes}
    mean = sum(raw[c] * n for c, n in sizes.items()) / m
    weight = {c: w / mean for c, w in raw.items()}
    # A candidate's weighted -ln p is its bin's lower edge plus ln(weight).
    ranked = sorted(((r.b * s.per_bin + math.log(weight[r.c]), r["count"]) for r in counts), reverse=True)
    found, cut = 0, math.inf
    for score, n in ranked:
        found += n
        if m * math.exp(-score) <= s.fdr * found:
            cut = score
    return {c: (cut - math.log(weight[c])) for c in sizes}


def find_secrets(docs: DataFrame, s: SecretSettings = SecretSettings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every row, by start and then kind.

    Offsets are code points, end exclusive.  Null and empty texts have no spans; rows that share
    a doc_id, or have none, are rows of their own.
    """
    scanned = materialize(arrays.text_rows(docs, id_column, text_column).mapInArrow(
        _scan(s), _SCANNED))
    return _spans(scanned, _threshold(scanned, s), s).select(F.col("id").alias("doc_id"), "spans")


def _spans(scanned: DataFrame, cuts: dict[int, float], s: SecretSettings) -> DataFrame:
    def taken(x):
        width = length_class(x["ends"] - x["starts"])
        passed = F.lit(False)
        for c, cut in cuts.items():
            if math.isfinite(cut):
                passed = passed | ((width == c) & (F.floor(x["scores"] / s.per_bin) * s.per_bin >= cut - 1e-9))
        return (x["kinds"] < 3) | passed

    kept = F.filter(F.arrays_zip("starts", "ends", "kinds", "scores"), taken)
    named = F.transform(kept, lambda x: F.struct(
        F.element_at(F.array(*map(F.lit, KINDS)), x["kinds"] + 1).alias("kind"), x["starts"].alias("start"), x["ends"].alias("end")))
    return scanned.withColumn("spans", named)


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans, and all spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


MARK = b"[SECRET]"


def _redacted(texts: pa.Array, cuts: dict[int, float], s: SecretSettings) -> pa.Array:
    raw, breaks = arrays.utf8(texts)
    start, end, kind, score = _all_spans(raw, breaks, s)
    # Candidates are ASCII, so their length in bytes is that in code points.
    width = np.clip(np.floor(np.log2(np.maximum(end - start, 1) / 16.0)), None, 8).astype(int)
    least = np.array([cuts.get(int(w), math.inf) for w in width])
    taken = (kind < 3) | (np.floor(score / s.per_bin) * s.per_bin >= least - 1e-9)
    owner = np.searchsorted(breaks, start, side="right") - 1
    out = texts.to_pylist()
    buffer = raw.tobytes()
    for k in np.unique(owner[taken]).tolist():
        low, high = int(breaks[k]), int(breaks[k + 1])
        parts, at = [], low
        for a, b in sorted(zip(start[taken & (owner == k)].tolist(), end[taken & (owner == k)].tolist())):
            if a >= at:
                parts += [buffer[at:a], MARK]
            at = max(at, b)
        out[k] = b"".join([*parts, buffer[at:high]]).decode()
    return pa.array(out, pa.string())


def redact(docs: DataFrame, s: SecretSettings = SecretSettings()) -> DataFrame:
    """``docs`` with every secret of its texts replaced by a mark, and n_chars as it then is.

    Null texts stay null.  All columns and rows stay.
    """
    scanned = materialize(arrays.text_rows(docs).mapInArrow(_scan(s), _SCANNED))
    cuts = _threshold(scanned, s)
    names, text_at = docs.columns, docs.columns.index("text")

    def run(batches):
        for batch in arrays.chunks(batches, limit=8 << 20):
            text = batch.column(text_at)
            made = _redacted(arrays.text_array(text), cuts, s)
            made = pa.compute.if_else(text.is_valid(), made, pa.scalar(None, pa.string()))
            columns = [made if k == text_at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        arrays.release()

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in names:
        return out
    counted = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", counted)
