"""Near-duplicate documents by a signature-coordinate inverted join.

Each document's set of five-word shingles gets a MinHash signature.  A document is posted
under each of its (coordinate, value) pairs; pairs of documents that collide in at least
``matches`` coordinates are confirmed on the full shingle sets.

* Prefix merging: values held by one document cannot collide.  Of its c colliding values a
  document is posted only under its c - matches + 1 rarest, because two documents with
  enough collisions share a value there.  Documents with c < matches leave the search.
* Skip merging: only components are wanted, so a pair whose ends are in one component
  already is skipped.  Rounds of one pivot per posting join large groups of copies in
  linear work; a last pass then takes every pair across components, so no link is lost.

Equal shingle sets are one node from the start.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays
from textforge.storage import materialize


@dataclass(frozen=True)
class NearDupSettings:
    """A pair of similarity 0.85 misses 40 of 64 coordinates with probability 2e-6, and 905 of
    1,024 sketch bits with probability 1e-6; more similar pairs miss them less often."""

    shingle: int = 5
    percent: int = 85
    coordinates: int = 64
    matches: int = 40
    pivot_rounds: int = 2
    sketch_bits: int = 1024
    sketch_matches: int = 905
    seed: int = 7


CHUNK = 1 << 20  # bytes of text whose shingles a task holds; they take some ten times as much
_SIGNED = "id long, n_shingles long, set_hi long, set_lo long, keys array<long>"


def shingle_sets(texts: pa.Array, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): each document's distinct shingles as sorted 64-bit hashes."""
    offsets, codes, dictionary = arrays.words(texts, lower=True)
    hashed = arrays.hashes(dictionary, seed)[codes] if len(codes) else np.empty(0, np.uint64)
    n = np.diff(offsets)
    counts = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    owner = arrays.spans_of(ends)
    first = offsets[owner] + np.arange(ends[-1]) - ends[owner]
    taken = np.minimum(n, width)[owner]
    value = np.full(len(first), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(width):
        at = np.minimum(first + k, max(len(hashed) - 1, 0))
        step = arrays.mix(value * np.uint64(0x2545F4914F6CDD1D) + hashed[at]) if len(first) else value
        value = np.where(k < taken, step, value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    sizes = np.bincount(owner[fresh], minlength=len(n)) if len(n) else np.empty(0, np.int64)
    return value[fresh], np.concatenate([[0], np.cumsum(sizes)])


def _sign(s: NearDupSettings):
    salts = arrays.mix(np.arange(1, s.coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s.seed))

    def run(batches):
        for batch in arrays.chunks(batches, limit=CHUNK):
            values, offsets = shingle_sets(arrays.text_array(batch.column("text")), s.shingle, s.seed)
            sizes = np.diff(offsets)
            some = sizes > 0
            starts = offsets[:-1][some]
            keys = np.zeros((some.sum(), s.coordinates), np.uint64)
            hi, lo = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            if len(starts):
                for c, salt in enumerate(salts):
                    low = np.minimum.reduceat((values ^ salt) * np.uint64(0xD6E8FEB86659FD93 | 1), starts)
                    keys[:, c] = arrays.mix(low + salt)
                hi[some] = np.add.reduceat(arrays.mix(values), starts)
                lo[some] = np.bitwise_xor.reduceat(arrays.mix(values + np.uint64(s.seed + 1)), starts)
            key_ends = np.concatenate([[0], np.cumsum(np.where(some, s.coordinates, 0))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes.astype(np.int64)), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
                 arrays.lists(keys.reshape(-1).view(np.int64), key_ends)],
                names=["id", "n_shingles", "set_hi", "set_lo", "keys"])
        arrays.release()

    return run


def _full_sets(s: NearDupSettings):
    salts = arrays.mix(np.arange(1, s.sketch_bits + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(s.seed))

    def run(batches):
        for batch in arrays.chunks(batches, limit=CHUNK):
            values, offsets = shingle_sets(arrays.text_array(batch.column("text")), s.shingle, s.seed)
            n = batch.num_rows
            bits = np.zeros((n, s.sketch_bits), np.uint8)
            some = np.diff(offsets) > 0
            if some.any():
                for c, salt in enumerate(salts):
                    low = np.minimum.reduceat((values ^ salt) * np.uint64(0xD6E8FEB86659FD93), offsets[:-1][some])
                    bits[some, c] = arrays.mix(low) & np.uint64(1)
            packed = np.packbits(bits, axis=1).view(np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), arrays.lists(values.view(np.int64), offsets),
                 arrays.lists(packed, np.arange(n + 1) * (s.sketch_bits // 64))], names=["id", "shingles", "bits"])
        arrays.release()

    return run


def connected_labels(edges: DataFrame) -> DataFrame:
    """(node, label): for each end of an edge (a, b), the smallest node that it reaches.

    Smallest neighbouring label, then a jump to the label's own label, until nothing changes;
    every step is a join and a minimum, and its result a table in the shared folder.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_low"))
        stepped = labels.join(around, "node").select("node", F.col("label").alias("_old"), F.least("label", "_low").alias("label"))
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("_top"))
        found = materialize(stepped.join(above, "label", "left").select(
            "node", "_old", F.least("label", F.coalesce("_top", "label")).alias("label")))
        moved = found.where("label <> _old").limit(1).count()
        labels = found.select("node", "label")
        if not moved:
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, s: NearDupSettings) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full shingle sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_sa", "_sb"))
    kept = both.select("a", "b", shared.alias("_i"), (F.size("_sa") + F.size("_sb")).alias("_n"))
    return kept.where(100 * F.col("_i") >= s.percent * (F.col("_n") - F.col("_i"))).select("a", "b")


def _close(s: NearDupSettings):
    """Column test of two candidates: fitting set sizes, enough colliding coordinates, alike sketches."""
    sizes = (100 * F.col("n_a") >= s.percent * F.col("n_b")) & (100 * F.col("n_b") >= s.percent * F.col("n_a"))
    differing = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return sizes & (F.size(F.array_intersect("keys_a", "keys_b")) >= s.matches) & (differing <= s.sketch_bits - s.sketch_matches)


def candidates(classes: DataFrame, s: NearDupSettings) -> DataFrame:
    """(id, n, keys, prefix) of the nodes that collide often enough to have a partner."""
    posted = classes.select("id", F.explode("keys").alias("key"))
    lengths = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n_key")).where("n_key > 1")
    met = posted.join(lengths, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n_key", "key"))).alias("_met"))
    ranked = met.where(F.size("_met") >= s.matches).select(
        "id", F.transform(F.slice("_met", F.lit(1), F.size("_met") - s.matches + 1), lambda x: x.key).alias("prefix"))
    return ranked.join(classes, "id").select("id", F.col("n_shingles").alias("n"), "keys", "prefix")


def _links(cands: DataFrame, sets: DataFrame, s: NearDupSettings) -> DataFrame:
    """(a, b) edges whose components are those of all links."""
    posts = materialize(cands.select("id", F.explode("prefix").alias("key")))
    facts = materialize(cands.join(sets.select("id", "bits"), "id"))
    edges = labels = None

    def side(name: str) -> DataFrame:
        return facts.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "keys", "bits", "prefix")])

    def labelled() -> DataFrame:
        if labels is None:
            return posts.withColumn("label", F.col("id"))
        return posts.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))

    for turn in range(s.pivot_rounds):
        now = labelled()
        # The first pivot is the smallest id, later ones differ by posting and turn.
        order = F.col("id") if turn == 0 else F.xxhash64("id", "key", F.lit(turn))
        pivots = now.groupBy("key").agg(F.min(F.struct(order.alias("_o"), "id", "label")).alias("_p"))
        crossing = now.join(pivots, "key").where("label <> _p.label").select(
            F.least("id", "_p.id").alias("a"), F.greatest("id", "_p.id").alias("b")).distinct()
        near = crossing.join(side("a"), "a").join(side("b"), "b").where(_close(s)).select("a", "b").distinct()
        found = materialize(_confirmed(near, sets, s).distinct())
        if not found.limit(1).count():
            break
        edges = found if edges is None else edges.union(found)
        labels = connected_labels(edges)
    now = materialize(labelled())
    split = now.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("key")
    open_posts = now.join(split, "key")
    # Posts of a key's most common label are met by the others only; posts of one label never meet.
    most = open_posts.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("_main"))
    open_posts = materialize(open_posts.join(most, "key"))
    one = open_posts.where("label <> _main").select("key", F.col("id").alias("a"), F.col("label").alias("_la")).join(side("a"), "a")
    two = open_posts.select("key", F.col("id").alias("b"), F.col("label").alias("_lb"), (F.col("label") == F.col("_main")).alias("_m")).join(side("b"), "b")
    # A pair is met once, at the first key that both prefixes hold, and never from both sides.
    meets = ((one.key == two.key) & (F.col("_la") != F.col("_lb")) & (F.col("_m") | (F.col("a") < F.col("b")))
             & _close(s) & (one.key == F.get(F.array_intersect("prefix_a", "prefix_b"), F.lit(0))))
    near = materialize(one.join(two, meets).select("a", "b").distinct())
    last = materialize(_confirmed(near, sets, s).distinct())
    return last if edges is None else edges.union(last)


def near_duplicates(docs: DataFrame, s: NearDupSettings = NearDupSettings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Words lie between white space bytes, A-Z lower-cased; with fewer words than a shingle the
    whole sequence is one shingle.  Null or empty texts have no shingles and link with nothing.
    Rows that share an id are one node.  A null id takes no part in links; its component is
    null and it is kept.  An empty table gives an empty result.
    """
    rows = arrays.text_rows(docs, id_column, text_column)
    signed = materialize(rows.mapInArrow(_sign(s), _SIGNED))
    named = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = materialize(named.groupBy("n_shingles", "set_hi", "set_lo").agg(F.min("id").alias("id"), F.first("keys").alias("keys")))
    cands = materialize(candidates(classes, s))
    wanted = cands.select("id").distinct()
    sets = materialize(rows.where("id IS NOT NULL").join(wanted, "id", "left_semi").mapInArrow(
        _full_sets(s), "id long, shingles array<long>, bits array<long>"))
    edges = _links(cands, sets, s)
    nodes = classes.select("n_shingles", "set_hi", "set_lo", F.col("id").alias("node"))
    repeated = named.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id")
    if repeated.limit(1).count():
        of_id = named.join(repeated, "id").join(nodes, ["n_shingles", "set_hi", "set_lo"]).select("id", "node").distinct()
        firsts = of_id.groupBy("id").agg(F.min("node").alias("_first"))
        edges = edges.union(of_id.join(firsts, "id").where("node <> _first").select("_first", "node"))
    labels = connected_labels(edges)
    heads = nodes.join(labels, "node", "left").select("n_shingles", "set_hi", "set_lo", F.coalesce("label", "node").alias("_head"))
    # Texts without words and rows without an id are left out of this join.
    out = named.select("id", "n_shingles", "set_hi", "set_lo").join(heads, ["n_shingles", "set_hi", "set_lo"]).select(
        "id", "n_shingles", F.col("_head").alias("_c"))
    alone = signed.where("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("_c"))
    return out.union(alone).select(F.col("id").alias("doc_id"), "n_shingles", F.col("_c").alias("component_id"),
                                   F.coalesce(F.col("id") == F.col("_c"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, s: NearDupSettings = NearDupSettings(), small: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose document stays, with all their columns.

    Of each group of near duplicates the smallest doc_id stays; of rows that repeat a doc_id and
    its text, one.  The list of dropped ids is broadcast if it is short, else joined by a shuffle.
    """
    dropped = materialize(near_duplicates(docs.select("doc_id", "text"), s).where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct())
    repeated = materialize(docs.groupBy(F.col("doc_id").alias("_repeated")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _repeated IS NOT NULL").select("_repeated"))
    dropped_side = F.broadcast(dropped) if dropped.count() <= small else dropped
    kept = docs.join(dropped_side, docs["doc_id"] == dropped["_dropped"], "left_anti")
    n = repeated.count()
    if not n:
        return kept
    once = F.broadcast(repeated) if n <= small else repeated
    single = kept.join(once, kept["doc_id"] == repeated["_repeated"], "left_anti")
    return single.union(kept.join(once, kept["doc_id"] == repeated["_repeated"], "left_semi").dropDuplicates(["doc_id", "text"]))
