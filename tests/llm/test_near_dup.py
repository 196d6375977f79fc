import random

from brute import components

from textforge.llm import near_dup
from textforge.llm.near_dup import near_duplicates

SCHEMA = "doc_id long, text string, label string, keys string, component_id long"


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=str)


def test_groups_of_near_copies_equal_brute_force(spark):
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(4):
        base = draw.choices(vocabulary, k=120)
        for copy in range(14):
            text = list(base)
            for _ in range(draw.randrange(0, 5)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    passage = " ".join(draw.choices(vocabulary, k=60))
    rows += [(len(rows) + k, passage + " " + " ".join(draw.choices(vocabulary, k=50))) for k in range(20)]
    assert run(spark, rows) == sorted(components(rows), key=str)


def test_edges_of_the_input(spark):
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\ttwo"), (6, "one two three four five"), (7, "ONE two three four five "),
            (None, "one two"), (8, long), (9, long + " end"), (10, "a b c d e f"), (10, "a b c d e f"), (11, "q r s"), (10, "q r s"),
            (12, "éa É b c d e"), (13, "éa é b c d e")]
    assert run(spark, rows) == sorted(components(rows), key=str)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_signing_holds_a_small_part_of_a_batch():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(4)
    texts = [" ".join(map(str, draw.integers(0, 9000, 1000))) for _ in range(1700)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    rows = sum(part.num_rows for part in near_dup._sign(near_dup.NearDupSettings())([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 60 << 20, peak


def test_a_chunk_takes_little_memory_and_both_passes_give_it_back(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(5)
    texts = [" ".join(map(str, draw.integers(0, 9000, 1000))) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    released = []
    monkeypatch.setattr(near_dup.arrays, "release", lambda: released.append(1))
    for k, task in enumerate((near_dup._sign, near_dup._full_sets), 1):
        tracemalloc.start()
        rows = sum(part.num_rows for part in task(near_dup.NearDupSettings())([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(texts) and peak < 28 << 20 and len(released) == k, peak
