import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from textforge.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table():
    return pieces.PieceTable(pieces.model_bytes(MODEL))


def segmentations(table, unit):
    """Every segmentation of a short unit, best first: (score, ids)."""
    text = unit.replace(" ", pieces.SPACE)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    known = {sp.id_to_piece(i): i for i in np.flatnonzero(np.isfinite(table.score)).tolist()}

    def rest(at):
        if at == len(text):
            yield 0.0, []
        for end in range(at + 1, len(text) + 1):
            piece = known.get(text[at:end])
            if piece is None and end > at + 1:
                continue
            head = (table.score[piece], [piece]) if piece is not None else (table.unknown, table.byte_ids[list(text[at:end].encode())].tolist())
            for score, ids in rest(end):
                yield head[0] + score, head[1] + ids

    return sorted(rest(0), key=lambda x: -x[0])


def test_units_equal_brute_force(table):
    units = [" the", " thea", "a", " x", "漢é", " walking", "\n", "  ab", " \U0001f600b", "ing.", "\t"]
    lattice = pieces.Lattice(table, units)
    flat, per_edge = lattice.ids(lattice.path)
    for u, unit in enumerate(units):
        want = segmentations(table, unit)
        got = lattice.n_best(u, 6)
        assert np.allclose([s for s, _ in got], [s for s, _ in want[:6]])
        assert sorted(map(tuple, (i for _, i in got)))[:1] and all(any(np.isclose(s, w) and i == x for w, x in want) for s, i in got)
        assert np.isclose(lattice.best[u], want[0][0])
        assert np.isclose(lattice.loss[u], want[0][0] - want[1][0]) if len(want) > 1 else np.isinf(lattice.loss[u])


def test_documents_equal_the_library_as_a_unigram_model(spark, table):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(pieces.model_bytes(MODEL))
    proto.trainer_spec.model_type = 1
    for i, p in enumerate(proto.pieces):
        if np.isfinite(table.score[i]):
            p.score = float(table.score[i])
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    draw = random.Random(5)
    words = "the of walking thereof unbelievable extraordinary antidisestablishment xq zebra 12345 don't".split()
    texts = [" ".join(draw.choices(words, k=draw.randrange(1, 9))) for _ in range(40)]
    got = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL, n=4).collect()
    for r in got:
        def value(ids):
            return sum(table.score[i] for i in ids)

        want = [value(ids) for ids in sp.nbest_encode(texts[r.doc_id], nbest_size=4)]
        mine = [r.score, *(a.score for a in r.alternatives)]
        assert np.allclose(mine, want[: len(mine)], atol=1e-3) and len(mine) == len(want)
        assert np.isclose(value(r.ids), r.score)
        for a in r.alternatives:
            ids = list(r.ids)
            for e in sorted(a.edits, key=lambda e: -e.start):
                ids[e.start : e.start + e.length] = e.ids
            assert np.isclose(value(ids), a.score) and ids != r.ids and sp.decode(ids) == texts[r.doc_id]


def test_round_trip_of_hard_texts(spark):
    texts = [None, "", " ", "a", "  lead and   trail  ", "\n\n x \r\n\t", "▁ literal ▁▁x", "漢字 かな \U0001f600é́", "q\x00r", "nowhitespace" * 9000, "word " * 40_000, "  \xa0"]
    df = spark.createDataFrame([(None if k == 3 else k // 2, t, 1, [2]) for k, t in enumerate(texts)], "doc_id long, text string, score int, ids array<int>")
    assert all(r.same for r in pieces.round_trip(df, MODEL).collect())
    back = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((None if k == 3 else k // 2, t or "")) for k, t in enumerate(texts))
    assert pieces.round_trip(df.limit(0), MODEL).collect() == []


def test_query(spark):
    rows = queries.op4(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.same and r.n_tokens > 0 and r.runner_up <= r.score and r.n_best == 3 for r in rows)


def test_units_are_remembered_between_chunks(table, monkeypatch):
    import pyarrow as pa

    model, draw, built, plain = pieces.model_bytes(MODEL), random.Random(7), [], pieces.Lattice
    words = "the of walking 漢é ▁x unbelievable xq zebra don't \U0001f600b".split() + [f"w{k}" for k in range(60)]
    texts = ["", *("  ".join(draw.choices(words, k=draw.randrange(1, 30))) for _ in range(60))]
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array([t])], names=["id", "text"]) for k, t in enumerate(texts)]

    def rows(chunk, known):
        monkeypatch.setattr(pieces, "CHUNK", chunk)
        monkeypatch.setattr(pieces, "KNOWN_UNITS", known)
        pieces.known_units.cache_clear()
        return [r for b in pieces._encoded(model, 3)(iter(batches)) for r in b.to_pylist()]

    want = rows(1 << 20, 10_000)
    assert rows(1, 20) == want
    monkeypatch.setattr(pieces, "Lattice", lambda t, units: built.extend(units) or plain(t, units))
    assert rows(1, 10_000) == want
    # A unit has one lattice for its best segmentation and one more if its n best are asked for.
    assert all(built.count(u) <= 2 for u in set(built))


def test_one_worker_of_a_task_encodes_and_decodes(spark):
    texts = [None, "", " a  b", "The cat\n\nsat", "漢字 😀é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for made in (pieces.round_trip(df, MODEL), pieces.encoded_and_checked(df, MODEL)):
        assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert sorted(r.doc_id for r in made.collect() if r.same) == list(range(len(texts)))
    apart = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, MODEL), MODEL).collect()}
    assert apart == {r.doc_id: r.text for r in pieces.encode_and_decode(df, MODEL).collect()} == {k: t or "" for k, t in enumerate(texts)}


def test_every_segmentation_is_decoded_and_compared(spark):
    df = spark.createDataFrame([(1, "hello world again"), (2, ""), (3, "▁漢 \n x"), (None, None)], "doc_id long, text string")
    batch = pa.RecordBatch.from_pylist([{"id": r.doc_id, "text": r.text or ""} for r in df.collect()], pa.schema([("id", pa.int64()), ("text", pa.string())]))
    table = pieces.table_of(pieces.model_bytes(MODEL))
    made = next(pieces._encoded(pieces.model_bytes(MODEL), 3, True)(iter([batch])))
    assert pieces._all_same(table, made) == [True] * 4 and all(r.same for r in pieces.round_trip(df, MODEL).collect())
    rows = made.to_pylist()
    found = pieces.segmentations(np.array(rows[0]["ids"]), rows[0]["alternatives"])
    assert len({tuple(x.tolist()) for x in found}) == 3
    # An alternative that reads otherwise is seen, though the best segmentation gives the text back.
    rows[0]["alternatives"][1]["edits"][0]["ids"] = rows[0]["alternatives"][1]["edits"][0]["ids"][:-1]
    assert pieces._all_same(table, pa.RecordBatch.from_pylist(rows, made.schema)) == [False, True, True, True]
