"""Token counts per document without token ids.

A pre-token here is a word with the white space before it: no piece of these tokenizers goes on
from another character into white space.  Tasks turn texts into per-document pre-token
frequencies: for each distinct pre-token of a chunk of documents its postings (document in the
chunk, frequency).  Pre-tokens are dealt by hash into buckets, one row per chunk and bucket, so
the shuffle moves a few large rows.  In a bucket the postings of all chunks meet their distinct
pre-tokens; the pieces of each are counted once, joined to the postings, and summed up per
document; sums go back by chunk.

There are as many buckets as input tasks, so a bucket's size does not grow with the table, and
a common pre-token has one entry per chunk.  Beyond ``TASKS`` input tasks there is a set of
buckets for each ``TASKS`` of them, which bounds the common ones' postings; a pre-token is then
counted once per set.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.llm.token_files import tokenizer_text

TASKS = 512
_DEALT = "bucket_set long, bucket long, chunk long, units binary, lengths binary, counts binary, docs binary, freqs binary"
_NAMES = [part.split()[0] for part in _DEALT.split(", ")]
_MOST_DOCS, _MOST_FREQ = 0xFFFF, 0xFF  # documents of a chunk, and occurrences that one posting holds


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _postings(n_buckets: int):
    def run(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for batch in arrays.joined(batches):
            for start in range(0, batch.num_rows, _MOST_DOCS):
                part = batch.slice(start, _MOST_DOCS)
                texts = arrays.text_array(part.column("text"))
                offsets, codes, dictionary = arrays.units(texts)
                chunk = (task << 32) + number
                number += 1
                # The chunk's documents: ids, whether given, bytes of text.
                ids = part.column("id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task // TASKS]), pa.array([chunk % n_buckets]), pa.array([chunk]), pa.array([None], pa.binary()),
                     pa.array([np.diff(arrays.utf8(texts)[1]).astype("<i8").tobytes()]), pa.array([np.asarray(ids.is_valid()).astype(np.uint8).tobytes()]),
                     pa.array([np.asarray(ids.fill_null(0)).astype("<i8").tobytes()]), pa.array([b""])], names=_NAMES)
                if not len(dictionary):
                    continue
                pairs, freqs = np.unique(codes * part.num_rows + arrays.spans_of(offsets), return_counts=True)
                copies = -(-freqs // _MOST_FREQ)
                times = np.full(int(copies.sum()), _MOST_FREQ)
                times[np.cumsum(copies) - 1] = freqs - (copies - 1) * _MOST_FREQ
                pairs = np.repeat(pairs, copies)
                at = np.searchsorted(pairs // part.num_rows, np.arange(len(dictionary) + 1))
                bucket = (arrays.hashes(dictionary) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                raw, ends = arrays.utf8(dictionary)
                sizes, counts = np.diff(ends)[order], np.diff(at)[order]
                letters = raw[_gathered(ends[:-1][order], sizes)]
                posted = _gathered(at[:-1][order], counts)
                docs, often = (pairs % part.num_rows)[posted].astype("<u2"), times[posted].astype(np.uint8)
                used = np.unique(bucket)
                cut = np.searchsorted(bucket[order], np.append(used, n_buckets))
                by_letter, by_posting = (np.concatenate([[0], np.cumsum(x)])[cut] for x in (sizes, counts))
                n = len(used)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task // TASKS)), pa.array(used), pa.array(np.full(n, chunk)), arrays.binaries(letters, by_letter),
                     arrays.binaries(sizes.astype("<u4"), 4 * cut), arrays.binaries(counts.astype("<u4"), 4 * cut),
                     arrays.binaries(docs, 2 * by_posting), arrays.binaries(often, by_posting)], names=_NAMES)

    return run


@lru_cache(maxsize=1)
def counter_of(text: str):
    """A worker's function from units to numbers of pieces, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def count(units: list[str]) -> np.ndarray:
        parts = (tokenizer.encode_batch_fast(units[k : k + 4096], add_special_tokens=False) for k in range(0, len(units), 4096))
        return np.fromiter((len(e) for part in parts for e in part), np.int64, len(units))

    return count


def _checked(text: str) -> str:
    pre = json.loads(text).get("pre_tokenizer") or {}
    kinds = {p["type"] for p in pre.get("pretokenizers", [pre] if pre else [])}
    if not kinds or not kinds <= {"Split", "ByteLevel", "Whitespace", "WhitespaceSplit", "BertPreTokenizer", "Punctuation", "Digits"}:
        raise ValueError("the tokenizer's pieces must end at white space")
    return text


_SUMS = "chunk long, docs binary, sums binary, ids binary, given binary, bytes binary"
_SUM_NAMES = [part.split()[0] for part in _SUMS.split(", ")]


def _joined_sums(text: str):
    def run(table: pa.Table) -> pa.Table:
        blobs = {c: table.column(c).to_pylist() for c in ("chunk", "units", "lengths", "counts", "docs", "freqs")}
        rows = [k for k, units in enumerate(blobs["units"]) if units is not None]
        lengths = [np.frombuffer(blobs["lengths"][k], "<u4").astype(np.int64) for k in rows]
        raw = np.frombuffer(b"".join(blobs["units"][k] for k in rows), np.uint8)
        codes, distinct = arrays.encode(arrays.strings(raw, np.concatenate([[0], np.cumsum(np.concatenate(lengths))]))) if rows else (None, None)
        pieces = counter_of(text)(distinct.to_pylist())[codes] if rows else None
        out, at = [], 0
        for k, sizes in zip(rows, lengths):
            own = pieces[at : at + len(sizes)]
            at += len(sizes)
            docs, freqs = np.frombuffer(blobs["docs"][k], "<u2"), np.frombuffer(blobs["freqs"][k], np.uint8).astype(np.int64)
            value = np.repeat(own, np.frombuffer(blobs["counts"][k], "<u4")) * freqs
            total = np.bincount(docs, weights=value).astype(np.int64)
            found = np.flatnonzero(total)
            out.append((blobs["chunk"][k], found.astype("<u2").tobytes(), total[found].astype("<i8").tobytes(), None, None, None))
        for k, units in enumerate(blobs["units"]):
            if units is None:
                out.append((blobs["chunk"][k], b"", b"", blobs["docs"][k], blobs["counts"][k], blobs["lengths"][k]))
        columns = list(zip(*out)) if out else [()] * 6
        return pa.table([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=_SUM_NAMES)

    return run


def _totals(table: pa.Table) -> pa.Table:
    """The documents of one chunk with their sums."""
    rows = {c: table.column(c).to_pylist() for c in _SUM_NAMES}
    head = next(k for k, ids in enumerate(rows["ids"]) if ids is not None)
    ids, given = np.frombuffer(rows["ids"][head], "<i8"), np.frombuffer(rows["given"][head], np.uint8)
    total = np.zeros(len(ids), np.int64)
    for docs, sums in zip(rows["docs"], rows["sums"]):
        total[np.frombuffer(docs, "<u2")] += np.frombuffer(sums, "<i8")
    return pa.table([pa.array(ids, mask=given == 0), pa.array(np.frombuffer(rows["bytes"][head], "<i8")), pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    Null texts count as empty: no bytes, no tokens.  Rows that share a doc_id, and rows without
    one, are counted each for themselves.  Special strings inside texts count as the tokenizer's
    default has it.
    """
    text = _checked(tokenizer_text(tokenizer_path))
    rows = arrays.text_rows(docs, id_column, text_column)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    n_buckets = max(4 * cores, min(2 * rows.rdd.getNumPartitions(), 2 * TASKS))
    dealt = rows.mapInArrow(_postings(n_buckets), _DEALT)
    sums = dealt.groupBy("bucket_set", "bucket").applyInArrow(_joined_sums(text), _SUMS)
    counted = sums.groupBy("chunk").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
