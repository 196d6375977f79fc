import random

import numpy as np
import pytest

from textforge.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id long, covered double, _hit long"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_bit_parallel_subsequences():
    draw = random.Random(1)
    for _ in range(200):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, n))] for n in (60, 90))
        masks = np.array([[sum(1 << i for i, x in enumerate(a) if x == y) for y in b]], np.uint64)
        assert dc.common_subsequences(masks, np.array([len(a)]))[0] == longest(a, b)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    common = [f"c{k}" for k in range(25)]
    rare = [f"r{k}" for k in range(1500)]

    def prose(n):
        return [draw.choice(common) if draw.random() < 0.5 else draw.choice(rare) for _ in range(n)]

    items = [(k, prose(draw.randrange(15, 55))) for k in range(30)] + [(30, prose(150))]
    rows, leaks = [], set()
    for k in range(700):
        text = prose(draw.randrange(30, 400))
        if k % 10 == 0:
            item, words = items[draw.randrange(len(items))]
            words = list(words)
            if k % 20 == 0:  # one word in eight is another
                for at in range(3, len(words), 8):
                    words[at] = "zz" + words[at]
            at = draw.randrange(len(text))
            text[at:at] = words
            leaks.add((k, item))
        rows.append((k, " ".join(text)))
    return rows, [(i, " ".join(w).capitalize() + ".") for i, w in items], leaks


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, 0.0, 1) for r in rows], DOCS)


def test_leaks_are_found_and_clean_documents_stay(spark, corpus):
    rows, items, leaks = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(frame(spark, rows), bench).collect()}
    assert found == leaks
    blocks = dc.contaminated(frame(spark, rows), bench, dc.LatentSettings(item_block=7))
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == leaks
    for small in (0, 1000):
        kept = dc.drop_contaminated(frame(spark, rows), bench, small=small)
        assert kept.columns == DOCS.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
        assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - {d for d, _ in leaks}


def test_edges(spark, corpus):
    rows, items, _ = corpus
    item = items[3][1]
    odd = rows[:40] + [(None, item), (9000, None), (9001, ""), (9002, item), (9002, item), (9003, "r1 c2 " * 60_000 + item), (9004, item.upper())]
    bench = spark.createDataFrame(items + [(50, None), (51, ""), (52, "too short"), (None, item), items[3]], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(frame(spark, odd), bench).collect()}
    assert {(None, 3), (9002, 3), (9003, 3), (9004, 3)} <= found and not {d for d, _ in found} & {9000, 9001}
    assert dc.contaminated(frame(spark, []), bench).collect() == []
    assert dc.contaminated(frame(spark, odd), bench.limit(0)).collect() == []
    assert dc.drop_contaminated(frame(spark, []), bench).collect() == []


def test_tasks_give_memory_back(monkeypatch):
    import pyarrow as pa

    released, s = [], dc.LatentSettings()
    monkeypatch.setattr(dc.arrays, "release", lambda: released.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["some words of a passage", ""]})
    assert list(dc._frequencies(s)([batch])) and released == [1]
    assert list(dc._sketch(np.ones(s.terms), s)([batch])) and released == [1, 1]


def test_search_holds_a_small_part_of_its_words(corpus, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    rows, items, leaks = corpus
    s, draw = dc.LatentSettings(), np.random.default_rng(2)
    latent = draw.standard_normal((s.terms, s.rank))
    packed = dc._item_passages([i for i, _ in items], pa.array([t for _, t in items]), latent, s)
    rows = [(0, ""), *((k + 1, t) for k, t in rows), (9000, ""), (9001, " ".join(t for _, t in rows[:40]))]

    def found(copies):
        batch = pa.RecordBatch.from_pydict({"id": [k for k, _ in rows] * copies, "text": [t for _, t in rows] * copies})
        made = [r for part in dc._search(packed, latent, s)([batch]) for r in part.to_pylist()]
        return sorted((r["doc_id"], r["item_id"], r["word_start"], r["word_end"], round(r["cosine"], 4)) for r in made)

    want = found(1)
    assert {(d - 1, i) for d, i, *_ in want if d < 9000} >= {x for x in leaks if x[0] % 20}
    for words in (1, 500, 1 << 30):
        monkeypatch.setattr(dc, "PART_WORDS", words)
        assert found(1) == want
    monkeypatch.undo()
    tracemalloc.start()
    assert found(5) == sorted(want * 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20, peak
