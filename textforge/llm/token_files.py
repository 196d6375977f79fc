"""Token ids of documents in binary files, and back.

A file is a row of blocks; a block holds some documents in ascending doc_id order:

    magic "TFB2" | documents u32 | ids u32 | ranked u32 | data bytes u32
    doc_id i64 each | doc_id given u8 each | ids per document u32 each
    ranked: the block's distinct ids, most frequent first, u32 each
    control bytes, one per four ids: two bits say how many bytes an id's rank takes
    data bytes: the ranks, little-endian, one to four bytes each
    one line feed

Frequent ids have small ranks, so most take one byte.  Control bytes are apart from the data,
so a decoder turns them into lengths by table lookup and gathers all ranks of a block at once.
Each block has its own ranks: it is written and read without a second pass over the table.

Spark's text writer writes the blocks (it passes bytes through and ends each with a line
feed), so files appear at job commit, on any file system that Spark reaches; binaryFile reads them.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textforge.llm import arrays

MAGIC = b"TFB2"
HEAD = struct.Struct("<4s4I")
BLOCK_BYTES = 6 << 20  # of text
BLOCKS_PER_FILE = 20
MAX_TOKENIZER = 64 << 20
KNOWN_UNITS = 300_000  # units that a worker remembers between blocks
AT_ONCE = 2_000  # units in one call of the library

# Fixed value: signs before which a byte-level pre-tokenizer always cuts, if a letter or digit is before.
_SIGNS = ",.;:!?"


def tokenizer_text(path: str) -> str:
    """A tokenizer file, read on the driver; executors get its text with the task's function."""
    if os.path.getsize(path) > MAX_TOKENIZER:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


class UnitEncoder:
    """Ids of units as the library gives them for the text around.

    Units go through the library many at once, joined by a special token: the library encodes
    what lies between special tokens apart.
    """

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        spec = json.loads(text)
        pre = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        direct = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                  and not spec.get("normalizer") and spec["model"]["type"] == "BPE"
                  and not any(re.search(r"\s", x) or not x for x in self.special)
                  and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])))
        self.signs = "".join(c for c in _SIGNS if not any(c in x for x in self.special)) if direct else ""
        self.mark = next((t["content"] for t in spec.get("added_tokens", []) if t["special"] and self._stands_apart(t["content"])), None) if direct else None
        self._forget()

    def _stands_apart(self, mark: str) -> bool:
        """Whether no special token can reach over the border of this one."""
        return not any((mark in x and mark != x) or any(mark.startswith(x[k:]) or mark.endswith(x[:k]) for k in range(1, len(x))) for x in self.special)

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.ends, self.seen = np.empty(0, np.uint32), np.zeros(1, np.int64), np.empty(0, np.int32)

    def _thin_out(self) -> None:
        """Forget the units seen least, half at least."""
        kept = np.flatnonzero(self.seen > 1)
        while len(kept) > KNOWN_UNITS // 2:
            self.seen >>= 1
            kept = np.flatnonzero(self.seen > 1)
        flat, sizes = _gathered(self.flat, self.ends[:-1], np.diff(self.ends), kept)
        if len(flat) > 8 * KNOWN_UNITS:
            return self._forget()
        names = list(self.numbers)
        self.numbers = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.flat, self.ends, self.seen = flat, np.concatenate([[0], np.cumsum(sizes)]), self.seen[kept] >> 1

    def numbered(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of the units, ids of all known units one after the other, their ends); only unseen units are encoded."""
        if len(self.numbers) > KNOWN_UNITS or len(self.flat) > 16 * KNOWN_UNITS:
            self._thin_out()
        found = np.fromiter(map(self.numbers.get, units, repeat(-1)), np.int64, len(units))
        fresh = np.flatnonzero(found < 0)
        if len(fresh):
            names, n = [units[k] for k in fresh.tolist()], len(self.numbers)
            made = [self.encode(names[k : k + AT_ONCE]) for k in range(0, len(names), AT_ONCE)]
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in made)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate([sizes for _, sizes in made]))])
            self.seen = np.append(self.seen, np.zeros(len(names), np.int32))
            found[fresh] = np.arange(n, n + len(names))
            self.numbers.update(zip(names, range(n, n + len(names))))
        self.seen[found] += 1
        return found, self.flat, self.ends

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, ids per unit)."""
        text = self.mark and self.mark.join([*units, ""])
        if not text or any(text.count(x) != (len(units) if x == self.mark else 0) for x in self.special):
            each = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
            return np.array([i for ids in each for i in ids], np.uint32), np.fromiter(map(len, each), np.int64, len(each))
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        is_mark = ids == self.tokenizer.token_to_id(self.mark)
        return ids[~is_mark], np.diff(np.flatnonzero(is_mark), prepend=-1) - 1


@lru_cache(maxsize=1)
def encoder_of(text: str) -> UnitEncoder:
    """A worker's encoder, kept from task to task."""
    return UnitEncoder(text)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the runs of flat that the codes name, their sizes)."""
    taken = sizes[codes]
    ends = np.cumsum(taken)
    # Where a run begins, less the places before it, plus a place's own number; a block has fewer than 2^31 ids.
    at = np.repeat((starts[codes] - (ends - taken)).astype(np.int32), taken)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at], taken


def encode_texts(encoder: UnitEncoder, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids u32, ids per document): each document's ids and the end id."""
    offsets, codes, dictionary = arrays.units(texts, encoder.signs)
    numbers, flat, ends = encoder.numbered(dictionary.to_pylist())
    # The end id is one unit more, after all known ones.
    flat, sizes = np.append(flat, np.uint32(end_id)), np.append(np.diff(ends), 1)
    codes = np.insert(numbers[codes], offsets[1:], len(sizes) - 1)
    ids, taken = _gathered(flat, ends, sizes, codes)
    last = offsets[1:] + np.arange(1, len(offsets))  # units up to each document's end, its end id included
    upto = np.concatenate([[0], np.cumsum(taken)])[last]
    return ids, np.diff(np.concatenate([[0], upto]))


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids by rank, control bytes, data bytes)."""
    counts = np.bincount(ids)
    found = np.flatnonzero(counts)
    ranked = found[np.lexsort((found, -counts[found]))].astype(np.uint32)
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    ranks = rank_of[ids]
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    quads[: len(ids)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return ranked, control.astype(np.uint8), ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]


#: Lengths of the four ranks of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def unpack(ranked: np.ndarray, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ids again: lengths by table lookup, then all bytes placed at once."""
    lengths = LENGTHS[control].reshape(-1)[:n]
    placed = np.zeros((n, 4), np.uint8)
    placed[np.arange(4) < lengths[:, None]] = data
    return ranked[placed.view("<u4").reshape(-1)]


def block(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> bytes:
    ranked, control, data = pack(ids)
    given = np.asarray(doc_ids.is_valid()).astype(np.uint8)
    keys = np.asarray(doc_ids.fill_null(0), dtype="<i8")
    head = HEAD.pack(MAGIC, len(keys), len(ids), len(ranked), len(data))
    return b"".join([head, keys.tobytes(), given.tobytes(), sizes.astype("<u4").tobytes(), ranked.astype("<u4").tobytes(),
                     control.tobytes(), data.tobytes()])


def blocks(content: bytes):
    """(doc_ids, sizes, ids) of each block of a file."""
    at = 0
    while at < len(content):
        magic, n_docs, n_ids, n_ranked, n_data = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        parts = []
        for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_ranked), ("u1", -(-n_ids // 4)), ("u1", n_data)):
            parts.append(np.frombuffer(content, kind, n, at))
            at += parts[-1].nbytes
        keys, given, sizes, ranked, control, data = parts
        yield pa.array(keys, mask=given == 0), sizes.astype(np.int64), unpack(ranked, control, data, n_ids)
        at += 1


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every whole text and write the files; file names ascend with doc_id.

    Null texts count as empty: such a document has its end id only.  Null doc_ids come first;
    rows that share a doc_id each keep their ids, in the order of the scan.  The table is
    split by (doc_id, row), so that one doc_id with many rows spreads over files.
    """
    spec = tokenizer_text(tokenizer_path)

    def run(batches):
        encoder = encoder_of(spec)
        for batch in arrays.joined(batches, limit=BLOCK_BYTES):
            ids, sizes = encode_texts(encoder, arrays.text_array(batch.column("text")), end_id)
            yield pa.RecordBatch.from_arrays([pa.array([block(batch.column("id"), ids, sizes)], pa.binary())], names=["block"])
        arrays.release()

    rows = arrays.text_rows(docs, id_column, text_column).withColumn("_row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("id", "_row").sortWithinPartitions("id", "_row").select("id", "text")
    made = dealt.mapInArrow(run, "block binary")
    made.select(F.col("block").cast("string").alias("value")).write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def _over_blocks(spark: SparkSession, path: str, fn, schema: str) -> DataFrame:
    """fn(doc_ids, sizes, ids) -> columns after (file, position), for each block of the files."""
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("file"), batch.column("content")):
                seen, before = 0, 0
                for keys, sizes, ids in blocks(content.as_py()):
                    n = len(sizes)
                    starts = before + np.cumsum(sizes) - sizes
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * n, pa.string()), pa.array(np.arange(seen, seen + n)), pa.array(starts), keys, pa.array(sizes),
                         *fn(sizes, ids)], names=["file", "position", "file_start", "doc_id", "n_tokens", *names])
                    seen, before = seen + n, before + len(ids)

    names = [part.split()[0] for part in schema.split(", ")]
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInArrow(run, f"file string, position long, file_start long, doc_id long, n_tokens long, {schema}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, file_start, doc_id, n_tokens, ids) of every document in the files."""
    return _over_blocks(spark, path, lambda sizes, ids: [arrays.lists(ids.astype(np.int32), np.concatenate([[0], np.cumsum(sizes)]))], "ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like read_tokens with ids_crc32, the CRC of the ids as little-endian u32, in place of the ids."""
    def digest(sizes, ids):
        raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(sizes) * 4
        return [pa.array([zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), sizes.tolist())], pa.int64())]

    return _over_blocks(spark, path, digest, "ids_crc32 long")


def with_starts(read: DataFrame) -> DataFrame:
    """start: the ids of all documents before, over all files.  One small row per file is summed up in order."""
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return read.join(offsets, "file").withColumn("start", F.col("_before") + F.col("file_start")).drop("_before")
