"""Source divergence audit: how far the term frequencies of the sources of a language lie apart.

Frequencies come from a single-pass in-memory index.  A task collects block postings
(language, term, source -> occurrences, documents) until ``memory_rows`` of them are held, then
spills them as a term-sorted run, cut by hash shard into blocks.  A shard reads the blocks of all its
runs in the order of their first terms and heap-merges them into one posting list per term, a window
of terms at a time: what is held does not grow with the shard.  Terms in enough documents are kept.

Every pair of sources is compared over all kept terms, absent ones with count zero.  Written
f(a, b) for two shares' divergence and a0 for a share of count zero, a term adds

    f(a, b) = f(a, b0) + f(a0, b) - f(a0, b0) + correction,

and the correction is zero unless both sources hold the term.  The first two parts need only each
source's histogram of counts; the corrections are streamed over the posting lists, neighbours at
growing distance within a list, into partial sums per pair.  All of it is integer arithmetic.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class AuditSettings:
    least_docs: int = 10
    top: int = 10
    chunk_bytes: int = 2 << 20
    memory_rows: int = 1 << 20
    block_rows: int = 1 << 12
    merge_rows: int = 1 << 17
    pair_rows: int = 1 << 20


_LETTER = np.full(256, 32, np.uint8)
_LETTER[np.r_[97:123, 128:256]] = np.r_[97:123, 128:256]
_LETTER[65:91] = np.arange(97, 123)

_RUN = "shard int, lang string, term string, data binary"
_FREQ = "term_no long, lang string, term string, source string, n long, total long, head boolean"
#: 1000000000 as a product of two factors, so that a scaled count stays a long.
_FIRST, _SECOND = 32_000, 31_250


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary): runs of ASCII letters and characters beyond ASCII, only A-Z lower-cased."""
    raw, at = arrays.utf8(texts)
    return arrays.words(arrays.strings(_LETTER[raw], at))


def block_postings(part: pa.RecordBatch) -> pa.Table:
    """(lang, term, source, n, df) of some documents; a group's own entry has the empty term and counts of zero."""
    langs, lang_names = arrays.encode(part.column("lang"))
    sources, source_names = arrays.encode(part.column("source"))
    group = langs * max(len(source_names), 1) + sources
    offsets, codes, dictionary = terms(arrays.text_array(part.column("text")))
    width = max(len(dictionary), 1)
    pairs, often = np.unique(arrays.spans_of(offsets) * width + codes, return_counts=True)
    keys, at = np.unique(group[pairs // width] * width + pairs % width, return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, at.reshape(-1), often)
    df = np.bincount(at.reshape(-1), minlength=len(keys))
    seen = np.unique(group)
    of = np.concatenate([keys // width, seen])
    term = pa.concat_arrays([dictionary.take(pa.array(keys % width)), pa.array([""] * len(seen), pa.string())])
    zero = np.zeros(len(seen), np.int64)
    return pa.table([lang_names.take(pa.array(of // len(source_names))), term, source_names.take(pa.array(of % len(source_names))),
                     pa.array(np.concatenate([n, zero])), pa.array(np.concatenate([df, zero]))], names=["lang", "term", "source", "n", "df"])


def _added(held: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(held).group_by(["lang", "term", "source"], use_threads=False).aggregate([("n", "sum"), ("df", "sum")])
    return table.rename_columns(["lang", "term", "source", "n", "df"])


def _spilled(table: pa.Table, n_shards: int, block_rows: int):
    """The rows of one term-sorted run: a row for each block of a shard, with its first language and term."""
    lang_codes, lang_names = arrays.encode(table.column("lang").combine_chunks())
    mixed = arrays.byte_hashes(table.column("term").combine_chunks()) ^ arrays.byte_hashes(lang_names, 1)[lang_codes]
    shard = (mixed % np.uint64(n_shards)).astype(np.int32)
    table = table.append_column("shard", pa.array(shard)).sort_by([(c, "ascending") for c in ("shard", "lang", "term", "source")])
    shard = table.column("shard").to_numpy()
    table = table.drop_columns(["shard"]).combine_chunks()
    cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
    for a, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        for at in range(a, end, block_rows):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.slice(at, min(block_rows, end - at)))
            first = [pa.array([table.column(c)[at].as_py()], pa.string()) for c in ("lang", "term")]
            yield pa.RecordBatch.from_arrays([pa.array(shard[at : at + 1]), *first, pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["shard", "lang", "term", "data"])


def _runs(s: AuditSettings, n_shards: int):
    def run(batches):
        held = []
        for part in arrays.joined(batches, limit=s.chunk_bytes):
            held.append(block_postings(part))
            if sum(t.num_rows for t in held) > s.memory_rows:
                held = [_added(held)]
                if held[0].num_rows > s.memory_rows // 2:
                    yield from _spilled(held.pop(), n_shards, s.block_rows)
        if held:
            yield from _spilled(_added(held), n_shards, s.block_rows)
        arrays.release()

    return run


def merged_runs(runs: list[pa.Table]) -> pa.Table:
    """Runs sorted by (lang, term, source) as one table in (lang, term) order with a number per term, sources of a term added up."""
    heads, sizes, keys, first = [], [], [], 0
    for number, run in enumerate(runs):
        langs, terms_of = (run.column(c).combine_chunks() for c in ("lang", "term"))
        lang_codes, term_codes = arrays.encode(langs)[0], arrays.encode(terms_of)[0]
        starts = np.flatnonzero(np.concatenate([[True], (lang_codes[1:] != lang_codes[:-1]) | (term_codes[1:] != term_codes[:-1])]))
        at = pa.array(starts)
        keys.append(zip(langs.take(at).to_pylist(), terms_of.take(at).to_pylist(), repeat(number), range(len(starts))))
        heads.append(starts + first)
        sizes.append(np.diff(np.append(starts, run.num_rows)))
        first += run.num_rows
    order = list(heapq.merge(*keys))
    where = np.concatenate([[0], np.cumsum([len(h) for h in heads])])
    picked = np.fromiter((where[k[2]] + k[3] for k in order), np.int64, len(order))
    fresh = np.fromiter((i == 0 or k[:2] != order[i - 1][:2] for i, k in enumerate(order)), bool, len(order))
    begin, size = np.concatenate(heads)[picked], np.concatenate(sizes)[picked]
    ends = np.cumsum(size)
    table = pa.concat_tables(runs).take(pa.array(np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)))
    number = np.repeat(np.cumsum(fresh) - 1, size)
    source, names = arrays.encode(table.column("source").combine_chunks())
    key = number * len(names) + source
    by = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
    out = table.select(["lang", "term", "source"]).take(pa.array(by[cut]))
    n, df = (np.add.reduceat(table.column(c).to_numpy()[by], cut) for c in ("n", "df"))
    return out.append_column("n", pa.array(n)).append_column("df", pa.array(df)).append_column("number", pa.array(number[by[cut]]))


def _kept(merged: pa.Table, first_no: int, s: AuditSettings) -> pa.Table:
    """The kept posting lists of merged runs; numbers go on from ``first_no``."""
    number = merged.column("number").to_numpy()
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    total, df = (np.add.reduceat(merged.column(c).to_numpy(), first)[number] for c in ("n", "df"))
    group = np.asarray(pc.equal(merged.column("term"), ""))
    keep = np.flatnonzero((df >= s.least_docs) | group)
    head = np.zeros(len(number), bool)
    head[first] = True
    part = merged.take(pa.array(keep))
    return pa.table([pa.array(first_no + number[keep]), part.column("lang"), part.column("term"), part.column("source"),
                     part.column("n"), pa.array(total[keep]), pa.array(head[keep] & ~group[keep])],
                    names=[c.split()[0] for c in _FREQ.split(", ")])


def _before(block: pa.Table, key: tuple[str, str]) -> int:
    """How many rows of a sorted block come before a (language, term)."""
    lang, term = block.column("lang"), block.column("term")
    return bisect_left(range(block.num_rows), key, key=lambda i: (lang[i].as_py(), term[i].as_py()))


def _merge(s: AuditSettings):
    """The kept posting lists of shards, whose blocks come sorted by shard, first language and first term.

    No later block has a term before the first one of the block at hand, so all that is held of such terms is whole.
    """
    def run(batches):
        held, rows, shard, first_no, most = [], 0, None, 0, s.merge_rows
        for batch in batches:
            for number, lang, term, data in zip(*(batch.column(c) for c in ("shard", "lang", "term", "data"))):
                done = []
                if number.as_py() != shard:
                    done, held = held, []
                elif rows >= most:
                    key = (lang.as_py(), term.as_py())
                    cuts = [_before(t, key) for t in held]
                    done = [t.slice(0, n) for t, n in zip(held, cuts) if n]
                    held = [t.slice(n) for t, n in zip(held, cuts) if n < t.num_rows]
                    rows = sum(t.num_rows for t in held)
                    most = max(s.merge_rows, 2 * rows)
                if done:
                    merged = merged_runs(done)
                    yield from _kept(merged, first_no, s).to_batches()
                    first_no += merged.column("number")[-1].as_py() + 1
                if number.as_py() != shard:
                    shard = number.as_py()
                    rows, first_no, most = 0, shard << 32, s.merge_rows
                held.append(pa.ipc.open_stream(data.as_buffer()).read_all())
                rows += held[-1].num_rows
        if held:
            yield from _kept(merged_runs(held), first_no, s).to_batches()
        arrays.release()

    return run


def term_index(docs: DataFrame, s: AuditSettings = AuditSettings()) -> DataFrame:
    """(term_no, lang, term, source, n, total, head): a row for each kept term and source that holds it.

    ``n`` counts occurrences in the source, ``total`` in the language; ``head`` marks one row of each term.  Each (lang, source)
    that occurs has a row with the empty term besides.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*text)
    n_shards = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    blocks = rows.mapInArrow(_runs(s, n_shards), _RUN).repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", "lang", "term")
    return materialize(blocks.mapInArrow(_merge(s), _FREQ))


def share(count: str, volume: str, n_terms: str) -> str:
    """SQL of 1 + floor(1000000000 * (count + 2) / (volume + 2 * n_terms)) without a product beyond a long; null without terms."""
    whole, scaled = f"({volume} + 2 * {n_terms})", f"(({count} + 2) * {_FIRST}L)"
    return f"CASE WHEN {whole} > 0 THEN 1 + ({scaled} div {whole}) * {_SECOND}L + (({scaled} % {whole}) * {_SECOND}L) div {whole} END"


def apart(p: str, q: str) -> str:
    """SQL of floor((p - q) * (p - q) / (p + q))."""
    return f"(((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q})))"


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_corrections(list_of: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray):
    """(smaller group, larger group, correction) of all pairs within posting lists, which are sorted by list and group.

    Entries meet the next, the one after, and so on, so memory grows with the entries and not with their pairs.
    """
    alone = np.arange(len(list_of))
    step = 1
    while True:
        alone = alone[: np.searchsorted(alone, len(list_of) - step)]
        alone = alone[list_of[alone] == list_of[alone + step]]
        if not len(alone):
            return
        other = alone + step
        value = (_apart(p[alone], p[other]) - _apart(p[alone], zero[other]) - _apart(zero[alone], p[other]) + _apart(zero[alone], zero[other]))
        yield group[alone], group[other], value
        step += 1


def _pair_sums(s: AuditSettings):
    """Partial sums of the corrections per pair of groups, over term-sorted entries."""
    names = ["a", "b", "value"]

    def summed(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("value", "sum")])
        return table.rename_columns(names).cast(pa.schema([(c, pa.int64()) for c in names]))

    def whole_lists(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            numbers = held.column("term_no").to_numpy()
            cut = int(np.searchsorted(numbers, numbers[-1])) if len(numbers) else 0
            if cut:
                yield held.slice(0, cut)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield held

    def run(batches):
        held, rows = [], 0
        for part in whole_lists(batches):
            columns = (part.column(c).to_numpy() for c in ("term_no", "gid", "p", "zero"))
            for a, b, value in pair_corrections(*columns):
                held.append(pa.table([a, b, value], names=names))
                rows += len(a)
                if rows > s.pair_rows:
                    held = [summed(held)]
                    rows = held[0].num_rows
                    if rows > s.pair_rows // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from summed(held).to_batches()

    return run


def _pairs(groups: DataFrame, entries: DataFrame, s: AuditSettings) -> DataFrame:
    """(a, b, value): group ids a < b of a language and their divergence over all kept terms."""
    sorted_lists = entries.select("term_no", "gid", "p", "zero").repartition("term_no").sortWithinPartitions("term_no", "gid")
    corrections = sorted_lists.mapInArrow(_pair_sums(s), "a long, b long, value long").groupBy("a", "b").agg(F.sum("value").alias("correction"))
    # How many terms a group holds how often; those it lacks are the rest of the kept ones.
    held = entries.groupBy("lang", F.col("gid").alias("a"), "p").agg(F.count(F.lit(1)).alias("terms"))
    lacks = groups.join(entries.groupBy("gid").agg(F.count(F.lit(1)).alias("_held")), "gid", "left").select(
        "lang", F.col("gid").alias("a"), F.col("zero").alias("p"), (F.col("n_terms") - F.coalesce("_held", F.lit(0))).alias("terms"))
    counts = held.unionByName(lacks).where("terms > 0")
    others = groups.select("lang", F.col("gid").alias("b"), F.col("zero").alias("zero_b"))
    against_none = counts.join(others, "lang").where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum(F.expr("terms * " + apart("p", "zero_b"))).alias("sides"))
    both = groups.select("lang", "n_terms", F.col("gid").alias("a"), F.col("zero").alias("zero_a")).join(others, "lang").where("a < b")
    value = F.coalesce("sides", F.lit(0)) - F.coalesce(F.expr("n_terms * " + apart("zero_a", "zero_b")), F.lit(0)) + F.coalesce("correction", F.lit(0))
    return both.join(against_none, ["a", "b"], "left").join(corrections, ["a", "b"], "left").select("a", "b", value.alias("value"))


def audit(docs: DataFrame, s: AuditSettings = AuditSettings()) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's divergence from the others of its language, and its own terms.

    Part ``pair`` has a row for each other source of the language, over all kept terms, zero without any.  Part ``term`` has the
    terms that the source holds at a larger share than the language, the ``top`` that add most.  Ranks go by value, then by the
    item's bytes.  Null texts, languages and sources are empty strings; a source without terms is a source; other columns
    are left behind.  Repeated rows count each.  A language with one source has no pair.  An empty table gives an empty result.
    """
    index = term_index(docs, s)
    real = index.where("term <> ''")
    per_source = index.groupBy("lang", "source").agg(F.sum("n").alias("volume"))
    per_lang = index.groupBy("lang").agg(F.sum("n").alias("lang_volume"), F.count_if("head").alias("n_terms"))
    groups = materialize(per_source.join(per_lang, "lang").withColumn("gid", F.monotonically_increasing_id()).withColumn(
        "zero", F.expr(share("0L", "volume", "n_terms"))))
    entries = materialize(real.join(groups, ["lang", "source"]).select(
        "term_no", "lang", "source", "term", "gid", "zero", F.expr(share("n", "volume", "n_terms")).alias("p"),
        F.expr(share("total", "lang_volume", "n_terms")).alias("q")))
    pairs = materialize(_pairs(groups, entries, s))
    named = groups.select(F.col("gid").alias("a"), "lang", "source")
    other = groups.select(F.col("gid").alias("b"), F.col("source").alias("item"))
    mirrored = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    by_pair = mirrored.join(named, "a").join(other, "b").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    by_term = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return by_pair.withColumn("rank", rank).unionByName(by_term.withColumn("rank", rank).where(F.col("rank") <= s.top))
