"""Arrow and numpy helpers of the operators: texts of a batch as arrays of words or units.

Every helper works on whole texts; batches are cut into chunks of bounded bytes between
documents, so a task holds one chunk (or one very long document) at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 32 << 20


def text_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id long, text string) of a table, null texts as empty ones; other columns are left behind."""
    return docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def joined(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Like chunks, but small batches of a task are put together first."""
    held, size = [], 0
    for part in chunks(batches, column, limit):
        n = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and size + n > limit:
            yield _concat(held)
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield _concat(held)


def _concat(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def release() -> None:
    """Give memory that a task has freed back to the system: its worker stays for other tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_array(column: pa.Array) -> pa.Array:
    return pc.fill_null(column, "").cast(pa.string())


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts as uint8, offsets) of a string array without nulls."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def strings(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over existing bytes."""
    at = np.ascontiguousarray(offsets, np.int32)
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw)))


def encode(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    found = flat.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary): words between bytes \\x20 and \\x09-\\x0D; lower maps A-Z only."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = np.asarray(pc.binary_length(flat), dtype=np.int64) > 0
    running = np.concatenate([[0], np.cumsum(full)])
    lengths = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    offsets = running[np.concatenate([[0], np.cumsum(lengths)])]
    if not full.all():
        flat = flat.filter(pa.array(full))
    codes, dictionary = encode(pc.ascii_lower(flat) if lower else flat)
    return offsets, codes, dictionary


def hashes(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of strings."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in values.to_pylist()), np.uint64, len(values))


def byte_hashes(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of strings without a Python loop: a sum over bytes, mixed with their places."""
    raw, offsets = utf8(values)
    n = np.diff(offsets)
    place = np.arange(len(raw), dtype=np.uint64) - np.repeat(offsets[:-1], n).astype(np.uint64)
    parts = mix((place << np.uint64(8) | raw) + np.uint64(seed << 40))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)])
    return mix(running[offsets[1:]] - running[offsets[:-1]] + n.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finalizer)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def spans_of(offsets: np.ndarray) -> np.ndarray:
    """For each element of a flattened list column, the number of its list."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def binaries(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array: bytes raw[offsets[i]:offsets[i+1]]."""
    at = np.ascontiguousarray(offsets, np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw).view(np.uint8))])


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _after_wide_space(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position may be white space beyond ASCII."""
    one, two, three = (raw[np.maximum(at - k, 0)] for k in (1, 2, 3))
    short = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide = (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A)) & (one >= 0x80)
    return short | wide


_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def units(texts: pa.Array, signs: str = "") -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary): texts cut before every run of white space.

    No pre-tokenizer's piece goes on from another character into white space, so a text's
    pieces are those of its units, one after the other.  With ASCII ``signs``, texts are cut
    before each of these that stands behind an ASCII letter or digit, too.
    """
    raw, ends = utf8(texts)
    space = _SPACE[raw]
    begins = np.zeros(len(raw), bool)
    begins[1:] = space[1:] & ~space[:-1]
    cuts = np.flatnonzero(begins)
    begins[cuts[_after_wide_space(raw, cuts)]] = False
    if signs:
        cuts = np.flatnonzero(np.isin(raw, np.frombuffer(signs.encode(), np.uint8)))
        cuts = cuts[cuts > 0]
        begins[cuts[_LETTER[raw[cuts - 1]]]] = True
    begins[ends[:-1][np.diff(ends) > 0]] = True
    starts = np.flatnonzero(begins)
    codes, dictionary = encode(strings(raw, np.append(starts, len(raw))))
    return np.searchsorted(starts, ends), codes, dictionary


_PLAIN = np.full(256, 32, np.uint8)
for _span in (range(48, 58), range(97, 123), range(128, 256)):
    _PLAIN[list(_span)] = list(_span)
_PLAIN[65:91] = np.arange(97, 123)

_KIND = np.full(256, 2, np.uint8)  # signs
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[*range(9, 14), 32]] = 0


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """words() of lower-cased texts whose ASCII signs are white space."""
    raw, at = utf8(texts)
    return words(strings(_PLAIN[raw], at))


def word_and_sign_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary) of lower-cased runs of word characters and runs of signs."""
    raw, ends = utf8(texts)
    kind = _KIND[raw]
    begins = np.zeros(len(raw), bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins[ends[:-1][np.diff(ends) > 0]] = True
    starts = np.flatnonzero(begins)
    full = kind[starts] > 0
    flat = pc.ascii_lower(strings(raw, np.append(starts, len(raw))).filter(pa.array(full)))
    codes, dictionary = encode(flat)
    return np.searchsorted(starts[full], ends), codes, dictionary
