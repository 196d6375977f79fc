"""Articles of files of any size: a finite transducer over the parts of a file.

Reading an extract in order needs two bits of state: whether the next line is a title to be
skipped, and whether a line break is pending that, with the next one, ends an article.  Tasks
read byte ranges of a file as Spark splits them, clean each line by itself, and cut the range
into segments.  A segment is evaluated for all four entry states: exit state, and articles
ended.  One small row per segment is then scanned in file order, which gives every segment its
true entry state and article number, and segments write their articles in parallel.  Only the
first and last piece of a segment meet those of its neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.functions import markup
from textforge.functions.sentences import mark_boundaries, strip
from textforge.sources.text import as_paths
from textforge.storage import materialize

SEGMENT_BYTES = 1 << 20
BROADCAST_SEGMENTS = 100_000

_SEGMENT = ("path string, start long, seg int, size long, raw long, open boolean, single boolean, header array<boolean>, keep array<boolean>, "
            "body array<string>, exits array<int>, cuts array<long>")
_ENTRY = "path string, start long, seg int, state int, first_no long, last boolean, unended boolean, dropped boolean"
_PIECE = "path string, article_no long, start long, seg int, n_lines long, text string, inner boolean, closed boolean"


def _records(spark: SparkSession, patterns: str | list[str], larger_than: int) -> DataFrame:
    return spark.read.text(as_paths(patterns), lineSep="\n").where(F.col("_metadata.file_size") > larger_than).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"),
        F.col("value"), (F.octet_length("value") + 1).cast("long").alias("raw"))


def extract_lines(spark: SparkSession, patterns: str | list[str], fragment_on_blank: bool, larger_than: int = -1) -> DataFrame:
    """Lines of the files above a size in scan order, each cleaned and cut into sentences by itself.

    ``raw`` counts the bytes of the record a line begins, its line feed included; ``open`` tells that the record would
    be an unended line if it were the file's last.
    """
    # A carriage return at the end belongs to the line feed, or ends the file's last line; others end lines of their own.
    pieces = F.split(F.regexp_replace("value", r"\r\z", ""), "\r")
    lines = _records(spark, patterns, larger_than).select(
        "path", "start", "size", "raw", (~F.col("value").endswith("\r")).alias("open"), F.posexplode(pieces).alias("_piece", "line"))
    header = F.contains("line", F.lit("<doc"))
    cleaned = markup.clean_markup(F.col("line"))
    body = F.array_join(F.transform(F.split(mark_boundaries(F.col("_cleaned")), "\n"), strip), "\n")
    keep = ~header & ~F.contains("line", F.lit("</doc>")) & (F.col("line") != "") & markup.keeps_line(F.col("line"))
    marked = lines.withColumn("header", header).withColumn("keep", keep).withColumn("_cleaned", F.when(F.col("keep"), cleaned).otherwise(""))
    if not fragment_on_blank:
        marked = marked.withColumn("keep", F.col("keep") & ~F.col("_cleaned").rlike(r"^[ \t\r]*\z"))
    return marked.select("path", "start", "size", F.when(F.col("_piece") == 0, F.col("raw")).otherwise(0).alias("raw"), "open",
                         (F.length("line") == 1).alias("single"), "header", "keep", F.when(F.col("keep"), body).otherwise("").alias("body"))


def article_file_lines(spark: SparkSession, patterns: str | list[str], larger_than: int = -1) -> DataFrame:
    """Lines of article files, which hold neither headers nor titles and end at line feeds only."""
    no, yes = F.lit(False), F.lit(True)
    return _records(spark, patterns, larger_than).select(
        "path", "start", "size", "raw", yes.alias("open"), no.alias("single"), no.alias("header"), yes.alias("keep"), F.col("value").alias("body"))


def output_lines(header: np.ndarray, keep: np.ndarray, body: pa.Array, skip: int) -> tuple[pa.Array, int]:
    """(output lines, exit skip flag) of a segment that is entered with the title flag ``skip``."""
    header, keep, body = header[skip:], keep[skip:], body[skip:]
    if not len(header):
        return pa.array([], pa.string()), 0
    at = np.arange(len(header))
    # Every second line of a run of header-like lines is a title.
    run = at - np.maximum.accumulate(np.where(header, -1, at)) - 1
    acted = header & (run % 2 == 0)
    title = np.concatenate([[False], acted[:-1]])
    out = acted | (~header & ~title & keep)
    return pc.list_flatten(pc.split_pattern(body.filter(pa.array(out)), "\n")), int(acted[-1])


def article_cuts(lines: pa.Array, pending: int) -> tuple[np.ndarray, int]:
    """(which lines end an article, exit pending flag): of a run of empty lines every second one, from the first that follows a pending break."""
    if not len(lines):
        return np.zeros(0, bool), pending
    at = np.arange(len(lines))
    full = np.asarray(pc.greater(pc.binary_length(lines), 0))
    before = np.maximum.accumulate(np.where(full, at, -1))
    # Places in a run count from 1; a run that opens the segment without a pending break starts one later.
    place = at - before - ((before < 0) & (pending == 0))
    cuts = ~full & (place % 2 == 1)
    return cuts, int(not cuts[-1])


def _evaluated(key: tuple, parts: list[pa.RecordBatch], seg: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    header, keep = (table.column(c).to_numpy() for c in ("header", "keep"))
    body = table.column("body").combine_chunks()
    exits, cuts = [], []
    for skip in (0, 1):
        lines, after = output_lines(header, keep, body, skip)
        for pending in (0, 1):
            cut, open_break = article_cuts(lines, pending)
            exits.append(2 * after + open_break)
            cuts.append(int(cut.sum()))
    path, start, size = key
    row = [path, start, seg, size, pc.sum(table.column("raw")).as_py(), table.column("open")[-1].as_py(),
           table.num_rows == 1 and table.column("single")[0].as_py(), header.tolist(), keep.tolist(), body.to_pylist(), exits, cuts]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _types(_SEGMENT))], names=_names(_SEGMENT))


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<boolean>": pa.list_(pa.bool_()),
          "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    return [_ARROW[c.split()[1]] for c in schema.split(", ")]


def _segments(limit: int):
    """Consecutive lines of one byte range as segments; a last line of one character is a segment of its own,
    because it is dropped if it turns out to end the file without a line break."""

    def closed(key, held, seg):
        last = held[-1]
        if last.column("single")[-1].as_py() and sum(p.num_rows for p in held) > 1:
            body = [*held[:-1], last.slice(0, last.num_rows - 1)]
            yield _evaluated(key, [p for p in body if p.num_rows], seg)
            yield _evaluated(key, [last.slice(last.num_rows - 1)], seg + 1)
        else:
            yield _evaluated(key, held, seg)

    def run(batches):
        key, held, size, seg = None, [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, paths = batch.column("start").to_numpy(), batch.column("path").dictionary_encode().indices.to_numpy()
            sizes = np.cumsum(np.asarray(pc.binary_length(batch.column("body")), np.int64))
            edges = np.flatnonzero(np.concatenate([[True], (starts[1:] != starts[:-1]) | (paths[1:] != paths[:-1]), [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                this = tuple(batch.column(c)[a].as_py() for c in ("path", "start", "size"))
                if this != key:
                    if held:
                        yield from closed(key, held, seg)
                    key, held, size, seg = this, [], 0, 0
                while a < b:
                    if size >= limit:
                        yield _evaluated(key, held, seg)
                        held, size, seg = [], 0, seg + 1
                    base = sizes[a - 1] if a else 0
                    stop = min(b, max(a + 1, int(np.searchsorted(sizes, base + limit - size, side="right"))))
                    held.append(batch.slice(a, stop - a))
                    size += int(sizes[stop - 1] - base) + stop - a
                    a = stop
        if held:
            yield from closed(key, held, seg)

    return run


def _scan(batches):
    """Entry state, article number and last-of-file flag of each segment, from rows sorted by file and place."""
    held, out = None, []
    path, state, number, total = None, 0, 0, 0

    def settled(row, last):
        nonlocal state, number
        unended = last and total - row["size"] in (1, -2) and row["open"]  # -2: the reader has taken a byte order mark away
        dropped = unended and row["single"] and state < 2
        out.append((row["path"], row["start"], row["seg"], state, number, last, unended, dropped))
        if not dropped:
            number, state = number + row["cuts"][state], row["exits"][state]

    def flushed():
        columns = list(zip(*out)) if out else [()] * 8
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _types(_ENTRY))], names=_names(_ENTRY))

    for batch in batches:
        for row in batch.to_pylist():
            if held is not None:
                settled(held, row["path"] != path)
            if row["path"] != path:
                path, state, number, total = row["path"], 0, 0, 0
            held, total = row, total + row["raw"]
        yield flushed()
    if held is not None:
        settled(held, True)
        yield flushed()


def _pieces(extract: bool):
    """The articles of a segment; an extract ends with one blank line more and closes its last line in any case."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                yield piece({name: batch.column(name)[at] for name in batch.schema.names})

    def piece(row):
        state, last = row["state"].as_py(), row["last"].as_py()
        lines = pa.array([], pa.string())
        if not row["dropped"].as_py():
            header, keep = (np.asarray(row[c].values.to_numpy(zero_copy_only=False), bool) for c in ("header", "keep"))
            lines, _ = output_lines(header, keep, row["body"].values, state // 2)
        if last and extract:
            lines = pa.concat_arrays([lines, pa.array([""])])
        cuts, _ = article_cuts(lines, state % 2)
        number = np.cumsum(cuts)
        n = int(number[-1]) + 1 if len(number) else 1
        counts = np.bincount(number[~cuts], minlength=n)
        grouped = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), lines.filter(pa.array(~cuts)))
        inner, closed = np.ones(n, bool), np.zeros(n, bool)
        inner[[0, -1]] = False
        closed[-1] = last and (extract or not row["unended"].as_py())
        columns = [*(pa.repeat(row["path"], n), pa.array(row["first_no"].as_py() + np.arange(n)), pa.repeat(row["start"], n), pa.repeat(row["seg"], n)),
                   pa.array(counts.astype(np.int64)), pc.binary_join(grouped, "\n"), pa.array(inner), pa.array(closed)]
        return pa.RecordBatch.from_arrays(columns, names=_names(_PIECE))

    return run


def _articles(lines: DataFrame, extract: bool, segment_bytes: int) -> DataFrame:
    segments = materialize(lines.mapInArrow(_segments(segment_bytes), _SEGMENT))
    small = segments.select("path", "start", "seg", "size", "raw", "open", "single", "exits", "cuts")
    entries = materialize(small.repartition("path").sortWithinPartitions("path", "start", "seg").mapInArrow(_scan, _ENTRY))
    # One row per segment: at SEGMENT_BYTES the bound is 100 GB of text; beyond it the segments are shuffled.
    side = F.broadcast(entries) if entries.count() <= BROADCAST_SEGMENTS else entries
    entered = segments.select("path", "start", "seg", "header", "keep", "body").join(side, ["path", "start", "seg"])
    pieces = materialize(entered.mapInArrow(_pieces(extract), _PIECE))
    whole = pieces.where("inner").select("path", "article_no", "text")
    met = pieces.where("NOT inner").groupBy("path", "article_no").agg(
        F.sort_array(F.collect_list(F.struct("start", "seg", "n_lines", "text"))).alias("_parts"), F.max("closed").alias("_closed"))
    full = F.filter("_parts", lambda p: p["n_lines"] > 0)
    text = F.concat(F.array_join(F.transform(full, lambda p: p["text"]), "\n"), F.when(F.col("_closed") & (F.size(full) > 0), "\n").otherwise(""))
    return whole.unionByName(met.select("path", "article_no", text.alias("text")))


def extract_articles(spark: SparkSession, patterns: str | list[str], fragment_on_blank: bool = True, larger_than: int = -1,
                     segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(path, article_no, text) of extract files above a size, cleaned and cut into articles as a sequential reader would.

    Files without any line have no row here.  Of compressed files the end of the last line is unknown: it counts as ended.
    """
    return _articles(extract_lines(spark, patterns, fragment_on_blank, larger_than), True, segment_bytes)


def file_articles(spark: SparkSession, patterns: str | list[str], larger_than: int = -1, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(path, article_no, text): article files above a size, cut at blank lines."""
    return _articles(article_file_lines(spark, patterns, larger_than), False, segment_bytes)
