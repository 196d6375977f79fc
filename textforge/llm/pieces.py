"""N-best segmentation into the pieces of a SentencePiece model, and exact decoding.

Texts are cut into units that no piece crosses (a run of spaces with the word behind it, or a
line feed).  A worker builds the piece lattice of each unit it does not remember: all new units
of a chunk together, level by level in a trie, forward Viterbi by end position.  The forward
scores are exact heuristics for a backward A* search, which yields a unit's segmentations best first.

A document's score is the sum of its units' scores, so its N best segmentations change only
units with the smallest loss to their second best; that loss is found for all units at once
from forward and backward scores, and A* runs for those few units, once while remembered.

Scores: a unigram model's own; a BPE model has ranks only, which become -ln(rank + 1).
Characters outside the vocabulary are written in byte pieces at a penalty.  A literal U+2581
is written in bytes, too, so decoding gives every text back exactly.
"""

from __future__ import annotations

import heapq
import os
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm import arrays

SPACE = "▁"  # fixed value: how pieces write a space
_LITERAL = 0x1FFFFF  # stands for a literal U+2581 of the text
_PENALTY = 10.0
MAX_MODEL = 64 << 20
CHUNK = 1 << 19  # of text; a lattice takes some hundred times as much
KNOWN_UNITS = 250_000  # units that a worker remembers between chunks


def model_bytes(path: str) -> bytes:
    if os.path.getsize(path) > MAX_MODEL:
        raise ValueError(f"{path} is larger than {MAX_MODEL} bytes")
    with open(path, "rb") as f:
        return f.read()


class PieceTable:
    """Pieces, scores and trie of a model with byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        pieces, raw = {i: sp.id_to_piece(i) for i in plain}, {i: sp.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in pieces.values()):
            raise ValueError("a piece goes on from a word into white space")
        by_rank = all(float(x).is_integer() and x <= 0 for x in raw.values())
        order = sorted(plain, key=lambda i: (-raw[i], i))
        self.score = np.full(n, -np.inf)
        for rank, i in enumerate(order):
            self.score[i] = -np.log(rank + 1.0) if by_rank else raw[i]
        self.unknown = float(self.score[plain].min()) - _PENALTY
        self.byte_ids = np.full(256, -1, np.int64)
        texts: list[bytes] = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], texts[i] = i, bytes([value])
        for i, p in pieces.items():
            texts[i] = p.replace(SPACE, " ").encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.line_feed_alone = not any("\n" in p for p in pieces.values())
        edges, ends, nodes = {}, {}, 1
        for i, p in pieces.items():
            node = 0
            for c in p:
                key = node << 21 | ord(c)
                if key not in edges:
                    edges[key] = nodes
                    nodes += 1
                node = edges[key]
            ends[node] = i
        keys = np.array(sorted(edges), np.int64)
        self.keys, self.next = keys, np.array([edges[k] for k in keys.tolist()], np.int64)
        self.piece_at = np.full(nodes, -1, np.int64)
        self.piece_at[list(ends)] = list(ends.values())


@lru_cache(maxsize=1)
def table_of(model: bytes) -> PieceTable:
    return PieceTable(model)


def space_units(texts: pa.Array, line_feed_alone: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, dictionary): texts, with the dummy space before, cut into units."""
    lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ")
    raw, ends = arrays.utf8(pc.binary_join_element_wise(lead, texts, ""))
    begins = np.zeros(len(raw), bool)
    begins[1:] = (raw[1:] == 32) & (raw[:-1] != 32)
    if line_feed_alone:
        begins[1:] |= (raw[1:] == 10) | (raw[:-1] == 10)
    begins[ends[:-1][np.diff(ends) > 0]] = True
    starts = np.flatnonzero(begins)
    codes, dictionary = arrays.encode(arrays.strings(raw, np.append(starts, len(raw))))
    return np.searchsorted(starts, ends), codes, dictionary


class Lattice:
    """The lattices of many units.  Boundary k of unit u has number first[u] + k."""

    def __init__(self, table: PieceTable, units: list[str]):
        self.table = table
        self.text = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        marks = self.text == ord(SPACE)
        self.text[self.text == 32] = ord(SPACE)
        self.text[marks] = _LITERAL
        self.sizes = np.fromiter(map(len, units), np.int64, len(units))
        at = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(units)), self.sizes)
        self.first = at + np.arange(len(units))
        start, node = np.arange(len(self.text)), np.zeros(len(self.text), np.int64)
        limit = (at + self.sizes)[owner]
        found, length = [], 0
        single = np.zeros(len(self.text), bool)
        while len(start):
            key = node << 21 | self.text[start + length]
            slot = np.minimum(np.searchsorted(table.keys, key), len(table.keys) - 1)
            met = table.keys[slot] == key
            start, node = start[met], table.next[slot[met]]
            length += 1
            piece = table.piece_at[node]
            full = piece >= 0
            found.append((start[full], np.full(full.sum(), length), piece[full]))
            if length == 1:
                single[start[full]] = True
            more = start + length < limit[start]
            start, node = start[more], node[more]
        lone = np.flatnonzero(~single)
        found.append((lone, np.ones(len(lone), np.int64), np.full(len(lone), -1)))
        begin, size, piece = (np.concatenate(x) for x in zip(*found))
        unit = owner[begin]
        self.left, self.right = begin + unit, begin + unit + size
        self.piece, self.unit = piece, unit
        self.cost = np.where(piece >= 0, table.score[piece], table.unknown)
        self._forward(at)

    def _sweep(self, level: np.ndarray, target: np.ndarray, source: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Best score of each target boundary, level by level; returns the winning edge of each."""
        bits = len(scores).bit_length()
        if len(level) and int(level.max()).bit_length() + 2 * bits < 63:
            order = np.argsort((level << bits | target) << bits | source)  # an edge's key is its own
        else:
            order = np.lexsort((source, target, level))
        level, target, source, cost = level[order], target[order], source[order], self.cost[order]
        won = np.full(len(scores), -1, np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]])) if len(level) else np.empty(0, np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(level)]):
            total = scores[source[a:b]] + cost[a:b]
            goal = target[a:b]
            heads = np.flatnonzero(np.concatenate([[True], goal[1:] != goal[:-1]]))
            best = np.maximum.reduceat(total, heads)
            at = np.where(total == np.repeat(best, np.diff(np.append(heads, b - a))), np.arange(b - a), b - a)
            scores[goal[heads]] = best
            won[goal[heads]] = order[a + np.minimum.reduceat(at, heads)]
        return won

    def _forward(self, at: np.ndarray) -> None:
        n, ends = len(self.sizes), self.first + self.sizes
        self.alpha = np.full(len(self.text) + n, -np.inf)
        self.alpha[self.first] = 0.0
        base = self.first[self.unit]
        won = self._sweep(self.right - base, self.right, self.left, self.alpha)
        self.best = self.alpha[ends]
        beta = np.full(len(self.alpha), -np.inf)
        beta[ends] = 0.0
        self._sweep(ends[self.unit] - self.left, self.left, self.right, beta)
        on_path = np.zeros(len(self.piece), bool)
        here = ends[self.sizes > 0]
        stop = self.first[self.sizes > 0]
        while len(here):
            edge = won[here]
            on_path[edge] = True
            here = self.left[edge]
            more = here > stop
            here, stop = here[more], stop[more]
        path = np.flatnonzero(on_path)
        self.path = path[np.argsort(self.left[path])]
        through = np.where(on_path, -np.inf, self.alpha[self.left] + self.cost + beta[self.right])
        second = np.full(n, -np.inf)
        np.maximum.at(second, self.unit, through)
        self.loss = self.best - second  # of the second best segmentation, infinite if there is none
        self.by_unit = np.argsort(self.unit, kind="stable")
        self.unit_at = np.searchsorted(self.unit[self.by_unit], np.arange(n + 1))

    def ids(self, edges) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per edge) of edges in order; unknown characters become byte pieces."""
        edges = np.asarray(edges, np.int64)
        piece = self.piece[edges]
        if (piece >= 0).all():
            return piece, np.ones(len(piece), np.int64)
        counts = np.ones(len(piece), np.int64)
        lone = np.flatnonzero(piece < 0)
        chars = self.text[self.left[edges[lone]] - self.unit[edges[lone]]]
        spelt = [self.table.byte_ids[list((SPACE if c == _LITERAL else chr(c)).encode())] for c in chars.tolist()]
        counts[lone] = [len(x) for x in spelt]
        ids = np.repeat(piece, counts)
        ids[ids < 0] = np.concatenate(spelt)
        return ids, counts

    def n_best(self, unit: int, n: int) -> list[tuple[float, list[int]]]:
        """(score, ids) of the unit's n best segmentations: backward A* over its lattice.

        A state is a suffix of a segmentation; its priority is the suffix's score plus the
        forward score of where it begins, which is exactly what the rest can gain at best.
        """
        into: dict[int, list[int]] = {}
        for e in self.by_unit[self.unit_at[unit] : self.unit_at[unit + 1]].tolist():
            into.setdefault(int(self.right[e]), []).append(e)
        begin, end = int(self.first[unit]), int(self.first[unit] + self.sizes[unit])
        heap, count, out = [(-float(self.best[unit]), 0, end, 0.0, None)], 1, []
        while heap and len(out) < n:
            priority, _, here, score, path = heapq.heappop(heap)
            if here == begin:
                edges = []
                while path:
                    edge, path = path
                    edges.append(edge)
                out.append((-priority, self.ids(edges)[0].tolist()))
                continue
            for e in into.get(here, ()):
                gained = score + float(self.cost[e])
                heapq.heappush(heap, (-(gained + float(self.alpha[self.left[e]])), count, int(self.left[e]), gained, (e, path)))
                count += 1
        return out


class KnownUnits:
    """What a worker remembers of units: ids, score and loss of the best segmentation, and the best n once they are asked for."""

    def __init__(self, table: PieceTable):
        self.table = table
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64)
        self.best, self.loss, self.seen = np.empty(0), np.empty(0), np.empty(0, np.int32)
        self.top: dict[int, list[tuple[float, list[int]]]] = {}

    def _thin_out(self) -> None:
        """Forget the units seen least, half at least."""
        kept = np.flatnonzero(self.seen > 1)
        while len(kept) > KNOWN_UNITS // 2:
            self.seen >>= 1
            kept = np.flatnonzero(self.seen > 1)
        flat, names, top = self.ids(kept)[0], list(self.numbers), self.top
        if len(flat) > 8 * KNOWN_UNITS:
            return self._forget()
        self.numbers = {names[k]: n for n, k in enumerate(kept.tolist())}
        self.top = {n: top[k] for n, k in enumerate(kept.tolist()) if k in top}
        self.flat, self.sizes = flat, self.sizes[kept]
        self.best, self.loss, self.seen = self.best[kept], self.loss[kept], self.seen[kept] >> 1

    def numbered(self, units: list[str]) -> np.ndarray:
        """The numbers of distinct units; only unseen ones get a lattice."""
        if len(self.numbers) > KNOWN_UNITS or len(self.flat) > 16 * KNOWN_UNITS:
            self._thin_out()
        found = np.fromiter(map(self.numbers.get, units, repeat(-1)), np.int64, len(units))
        fresh = np.flatnonzero(found < 0)
        if len(fresh):
            names, n = [units[k] for k in fresh.tolist()], len(self.numbers)
            lattice = Lattice(self.table, names)
            ids, per_edge = lattice.ids(lattice.path)
            sizes = np.bincount(lattice.unit[lattice.path], weights=per_edge, minlength=len(names)).astype(np.int64)
            self.flat, self.sizes = np.append(self.flat, ids.astype(np.int32)), np.append(self.sizes, sizes)
            self.best, self.loss = np.append(self.best, lattice.best), np.append(self.loss, lattice.loss)
            self.seen = np.append(self.seen, np.zeros(len(names), np.int32))
            found[fresh] = np.arange(n, n + len(names))
            self.numbers.update(zip(names, range(n, n + len(names))))
        self.seen[found] += 1
        return found

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the best segmentations one after the other, ends of each)."""
        starts, taken = (np.cumsum(self.sizes) - self.sizes)[numbers], self.sizes[numbers]
        ends = np.cumsum(taken)
        return self.flat[np.repeat(starts - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)], ends

    def search(self, numbers: np.ndarray, names: list[str], n: int) -> None:
        """Find the n best segmentations of units, unless they are known."""
        left = {k: name for k, name in zip(numbers.tolist(), names) if k not in self.top}
        if left:
            lattice = Lattice(self.table, list(left.values()))
            for u, k in enumerate(left):
                self.top[k] = lattice.n_best(u, n)


_ALTERNATIVE = pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])))])
_ENCODED = ("doc_id long, ids array<int>, score double, alternatives array<struct<score double, edits array<struct<start int, length int, ids array<int>>>>>, "
            "text_crc32 long")


def _nearest(loss: np.ndarray, n: int) -> np.ndarray:
    """Places of the n - 1 units of a document with the smallest loss, in ascending order."""
    if n < 2:
        return np.empty(0, np.int64)
    near = np.sort(np.argpartition(loss, n - 2)[: n - 1]) if len(loss) > n - 1 else np.arange(len(loss))
    return near[np.isfinite(loss[near])]


def _alternatives(known: KnownUnits, near: np.ndarray, numbers: np.ndarray, token_at: np.ndarray, best: float, n: int) -> list:
    """The 2nd to n-th best segmentations of a document, as edits of the best, in its units ``near``."""
    states: list = [(0.0, ())]
    for place in near.tolist():
        found = known.top[int(numbers[place])]
        choices = [(found[0][0] - score, k) for k, (score, _) in enumerate(found)]
        states = heapq.nsmallest(n, ((lost + more, (*chosen, (place, k)) if k else chosen) for lost, chosen in states for more, k in choices))
    out = []
    for lost, chosen in states[1:]:
        edits = []
        for place, k in chosen:
            found = known.top[int(numbers[place])]
            edits.append({"start": int(token_at[place]), "length": len(found[0][1]), "ids": found[k][1]})
        out.append({"score": best - lost, "edits": edits})
    return out


@lru_cache(maxsize=1)
def known_units(model: bytes, n: int) -> KnownUnits:
    """A worker's memory, kept from task to task."""
    return KnownUnits(table_of(model))


def _encoded(model: bytes, n: int, with_text: bool = False):
    def run(batches):
        known = known_units(model, n)
        for batch in arrays.joined(batches, limit=CHUNK):
            texts = arrays.text_array(batch.column("text"))
            offsets, codes, dictionary = space_units(texts, known.table.line_feed_alone)
            names = dictionary.to_pylist()
            numbers = known.numbered(names)[codes]
            ids, ends = known.ids(numbers)
            taken = known.sizes[numbers]
            upto = np.concatenate([[0], ends])[offsets]
            scores = np.bincount(arrays.spans_of(offsets), weights=known.best[numbers], minlength=len(texts)).astype(float)
            loss, spans = known.loss[numbers], list(zip(offsets.tolist(), offsets[1:].tolist()))
            near = [_nearest(loss[a:b], n) for a, b in spans]
            asked = np.concatenate([np.empty(0, np.int64), *(a + x for (a, _), x in zip(spans, near))])
            known.search(numbers[asked], [names[k] for k in codes[asked].tolist()], n)
            other = [_alternatives(known, near[k], numbers[a:b], ends[a:b] - taken[a:b] - upto[k], float(scores[k]), n) for k, (a, b) in enumerate(spans)]
            raw, at = arrays.utf8(texts)
            view = memoryview(raw.tobytes())
            crc = [zlib.crc32(view[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            columns = [batch.column("id"), arrays.lists(ids, upto), pa.array(scores), pa.array(other, pa.list_(_ALTERNATIVE)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *[texts] * with_text], names=["doc_id", "ids", "score", "alternatives", "text_crc32", *["text"] * with_text])
        arrays.release()

    return run


def encode(docs: DataFrame, model_path: str, n: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, score, alternatives, text_crc32) of every row.

    ids is the best segmentation; alternatives has the next n - 1 at most, as edits (start,
    length, ids) of it, with their scores.  Equal scores: the longer first piece from the right
    wins.  Null and empty texts have no ids and score 0; rows that share a doc_id, or have none,
    are encoded each.
    """
    return arrays.text_rows(docs, id_column, text_column).mapInArrow(_encoded(model_bytes(model_path), n), _ENCODED)


def decoded_bytes(table: PieceTable, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts; the dummy space of each is left out."""
    lengths = table.lengths[ids]
    ends = np.cumsum(lengths)
    raw = table.bytes[np.repeat(table.starts[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
    at = np.concatenate([[0], ends])[offsets]
    full = np.diff(at) > 0
    keep = np.ones(len(raw), bool)
    keep[at[:-1][full]] = False
    return raw[keep], np.concatenate([[0], np.cumsum(np.diff(at) - full)])


def _decoded(model: bytes, names: list[str]):
    def run(batches):
        table = table_of(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                ids = pc.fill_null(part.column("ids"), [])
                lengths = np.asarray(pc.list_value_length(ids), dtype=np.int64)
                raw, at = decoded_bytes(table, np.asarray(ids.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)]))
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in names), arrays.strings(raw, at)], names=[*names, "text"])

    return run


def decode(encoded: DataFrame, model_path: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns and the text of each row's ids; null ids count as none."""
    fields = [f for f in encoded.schema.fields if f.name in columns]
    names = [f.name for f in fields]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), "text string"])
    return encoded.select(*dict.fromkeys([*names, "ids"])).mapInArrow(_decoded(model_bytes(model_path), names), schema)


def encode_and_decode(docs: DataFrame, model_path: str, n: int = 3) -> DataFrame:
    """The columns of encode() and the text that its ids decode to.

    One worker of a task does both: with a worker for each, twice as many stay alive in an
    executor for all later stages.
    """
    model = model_bytes(model_path)
    into, back = _encoded(model, n), _decoded(model, ["doc_id", "ids", "score", "alternatives", "text_crc32"])
    return arrays.text_rows(docs).mapInArrow(lambda batches: back(into(batches)), f"{_ENCODED}, text string")


def segmentations(ids: np.ndarray, alternatives: list) -> list[np.ndarray]:
    """The ids of a row's best segmentation and of all its alternatives."""
    out = [ids]
    for other in alternatives:
        parts, at = [], 0
        for edit in sorted(other["edits"], key=lambda e: e["start"]):
            parts += [ids[at : edit["start"]], np.array(edit["ids"], np.int64)]
            at = edit["start"] + edit["length"]
        out.append(np.concatenate([*parts, ids[at:]]))
    return out


def _all_same(table: PieceTable, batch: pa.RecordBatch) -> list[bool]:
    """Whether every segmentation of a row decodes to the row's text, byte for byte."""
    lists = batch.column("ids")
    flat, ends = np.asarray(lists.flatten()).astype(np.int64), np.cumsum(np.asarray(lists.value_lengths(), dtype=np.int64)).tolist()
    made = [segmentations(flat[a:b], other) for a, b, other in zip([0, *ends], ends, batch.column("alternatives").to_pylist())]
    parts = [x for row in made for x in row]
    raw, at = decoded_bytes(table, np.concatenate([np.empty(0, np.int64), *parts]), np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)]))
    want, want_at = arrays.utf8(batch.column("text"))
    raw, want, at = raw.tobytes(), want.tobytes(), iter(zip(at.tolist(), at.tolist()[1:]))
    return [all([raw[a:b] == want[c:d] for _ in row for a, b in [next(at)]]) for row, c, d in zip(made, want_at.tolist(), want_at.tolist()[1:])]


def _checked(model: bytes, n: int):
    """The columns of encode() and ``same``, in one worker."""
    encoded, names = _encoded(model, n, with_text=True), ["doc_id", "ids", "score", "alternatives"]

    def run(batches):
        for batch in encoded(batches):
            same = [x for at in range(0, batch.num_rows, 2048) for x in _all_same(table_of(model), batch.slice(at, 2048))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(same, pa.bool_())], names=[*names, "same"])

    return run


def encode_and_check(docs: DataFrame, model_path: str, n: int = 3) -> DataFrame:
    """(doc_id, ids, score, alternatives, same): encode(), and whether all n best segmentations decode to the whole text."""
    schema = _ENCODED.replace("text_crc32 long", "same boolean")
    return arrays.text_rows(docs).mapInArrow(_checked(model_bytes(model_path), n), schema)


def encoded_and_checked(docs: DataFrame, model_path: str, n: int = 3) -> DataFrame:
    """(doc_id, ids, n_tokens, score, alternatives, same): same says that decoding each segmentation gave the text back."""
    return encode_and_check(docs, model_path, n).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "score", "alternatives", "same")


def round_trip(docs: DataFrame, model_path: str, n: int = 3) -> DataFrame:
    """(doc_id, n_tokens, score, runner_up, n_best, same): each text encoded, all its n best segmentations decoded and compared."""
    return encode_and_check(docs, model_path, n).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "score", F.get("alternatives", F.lit(0)).getField("score").alias("runner_up"),
        (F.size("alternatives") + 1).alias("n_best"), "same")
