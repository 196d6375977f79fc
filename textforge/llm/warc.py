"""WARC archives: writing records, an index first, then coalesced byte-range reads.

Records are written by Spark's text writer with the two line breaks that end a WARC record as
its line separator, so files are plain uncompressed WARC 1.1 and appear at job commit.  A payload
that several pages share is stored once: the page with the smallest page_id has the response
record, the others revisit it.

``build_index`` walks the files' headers and skips payloads: one row per record with file,
offset, length, URL and digest, kept as a table beside the archives.  ``read_records`` takes any
selection of index rows, sorts them by file and offset, joins neighbours into one range, and
reads only those bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Record separators, the revisit profile of the WARC format, base32 digits of RFC 4648.
BREAK = "\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SMALL = 200_000  # rows of a broadcast list of revisits; larger ones are joined by a shuffle
GAP = 64 << 10
RANGE = 8 << 20
WINDOW = 16 << 10


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string's UTF-8 bytes: twenty bits become four digits."""
    digest = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def record_text(date: str) -> Column:
    """A record without its last two line breaks, from page_id, url, payload, digest, size, first."""
    revisit = F.col("first").isNotNull()
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    # Line breaks would end the header, so they are written as in a URL.
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "), F.col("size").cast("string"), F.lit(BREAK + BREAK))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(f"{BREAK}WARC-Record-ID: "), name,
        F.lit(f"{BREAK}WARC-Date: {date}{BREAK}"), _line("WARC-Target-URI", url), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))), _line("WARC-Profile", F.when(revisit, PROFILE)),
        F.lit(f"Content-Type: application/http; msgtype=response{BREAK}Content-Length: "), block.cast("string"), F.lit(BREAK + BREAK), http,
        F.when(revisit, "").otherwise(F.col("payload")))


def with_revisits(pages: DataFrame, least_bytes: int = 0, small: int = SMALL) -> DataFrame:
    """(page_id, url, payload, digest, size, first): first is the page that a revisit refers to.

    The smallest page_id of each payload is found by an aggregate of digests.  Payloads only
    move if the list of revisits is too long for a broadcast.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    keys = ["digest", "size"]
    firsts = rows.where(F.col("size") >= least_bytes).groupBy(*keys).agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("_last"), F.max(F.col("page_id").isNull()).alias("_unnamed")).where(
        F.col("first").isNotNull() & ((F.col("first") < F.col("_last")) | F.col("_unnamed"))).select(*keys, "first")
    if firsts.limit(small + 1).count() <= small:
        firsts = F.broadcast(firsts)
    later = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.lit(True)), F.col("first"))
    return rows.join(firsts, keys, "left").withColumn("first", later)


def write_warc(pages: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z", least_bytes: int = 0, records_per_file: int = 50_000) -> None:
    """Write a record per page (page_id, url, html) and the index in ``path``.

    A null html is an empty payload, a null url leaves its header out.  Rows that repeat a
    page_id and its payload are records of the same kind.  Rows without a page_id revisit the
    page that has one.  Other columns are ignored; an empty table gives no record.
    """
    made = with_revisits(pages, least_bytes).select(record_text(date).alias("value"))
    made.write.option("lineSep", END.decode()).option("maxRecordsPerFile", records_per_file).text(f"{path}/archive")
    build_index(pages.sparkSession, path).write.parquet(f"{path}/index")


def _opened(uri: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return system.open_input_file(name)


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")
_INDEX = "file string, offset long, length long, record_type string, url string, page_id long, payload_digest string, payload_bytes long, refers_to long"


def _fields(head: bytes) -> dict[bytes, bytes]:
    return {k.strip().lower(): v for k, v in _HEADER.findall(head)}


def _page(name: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", name or b"")
    return int(found[1]) if found else None


def _walk(file, size: int):
    """Index entries of one archive: reads each record's headers, seeks over its payload."""
    at, held, start = 0, b"", 0
    while at < size:
        need, end = WINDOW, -1
        while end < 0:
            if not start <= at < start + len(held) or start + len(held) < min(size, at + need):
                file.seek(at)
                held, start = file.read(min(max(need, WINDOW), size - at)), at
            end = held.find(END, at - start)
            second = held.find(END, end + 4) if end >= 0 else -1
            if second < 0:
                end = -1
                if start + len(held) >= size and start <= at:
                    raise ValueError(f"no record at byte {at}")
                need *= 2
        head, http = held[at - start : end], held[end + 4 : second]
        fields, inner = _fields(head), _fields(http)
        length = end + 4 - (at - start) + int(fields[b"content-length"])
        yield (at, length, fields[b"warc-type"].decode(), fields.get(b"warc-target-uri"), _page(fields[b"warc-record-id"]),
               fields[b"warc-payload-digest"].decode().removeprefix("sha1:"), int(inner[b"content-length"]), _page(fields.get(b"warc-refers-to")))
        at += length + len(END)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``."""
    def run(batches):
        for batch in batches:
            for uri, size in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist()):
                with _opened(uri) as file:
                    found = list(_walk(file, size))
                columns = list(zip(*found)) if found else [()] * 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(found), pa.string()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                     pa.array([None if u is None else u.decode() for u in columns[3]], pa.string()), pa.array(columns[4], pa.int64()),
                     pa.array(columns[5], pa.string()), pa.array(columns[6], pa.int64()), pa.array(columns[7], pa.int64())],
                    names=[part.split()[0] for part in _INDEX.split(", ")])

    files = spark.read.format("binaryFile").load(f"{path}/archive").select(F.col("path").alias("file"), F.col("length").alias("size"))
    return files.repartition("file").mapInArrow(run, _INDEX)


def _ranges(offsets: np.ndarray, lengths: np.ndarray):
    """Slices of sorted records that one read covers."""
    first = 0
    for k in range(1, len(offsets) + 1):
        if k == len(offsets) or offsets[k] > offsets[k - 1] + lengths[k - 1] + GAP or offsets[k] + lengths[k] - offsets[first] > RANGE:
            yield first, k
            first = k


def read_records(selected: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest) of selected index rows.

    The payload of a response is read and its digest computed; a revisit has the full payload's
    digest and size from its headers and a null payload.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]

    def run(batches):
        for batch in batches:
            files = batch.column("file").to_pylist()
            offsets, lengths = (np.asarray(batch.column(c)) for c in ("offset", "length"))
            cuts = [0, *(k for k in range(1, len(files)) if files[k] != files[k - 1]), len(files)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                with _opened(files[a]) as file:
                    for first, last in _ranges(offsets[a:b], lengths[a:b]):
                        first, last = a + first, a + last
                        base = int(offsets[first])
                        file.seek(base)
                        raw = file.read(int(offsets[last - 1] + lengths[last - 1]) - base)
                        payloads, sizes, digests = [], [], []
                        for k in range(first, last):
                            record = raw[int(offsets[k]) - base : int(offsets[k] + lengths[k]) - base]
                            head, _, block = record.partition(END)
                            http, _, body = block.partition(END)
                            if batch.column("record_type")[k].as_py() == "response":
                                payloads.append(body)
                                sizes.append(len(body))
                                digests.append(base64.b32encode(hashlib.sha1(body).digest()).decode())
                            else:
                                payloads.append(None)
                                sizes.append(int(_fields(http)[b"content-length"]))
                                digests.append(_fields(head)[b"warc-payload-digest"].decode().removeprefix("sha1:"))
                        part = batch.slice(first, last - first)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("page_id"), part.column("url"), part.column("record_type"), part.column("refers_to"),
                             pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=names)

    dealt = selected.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")
