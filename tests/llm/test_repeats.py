import hashlib
import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textforge.llm import repeats
from textforge.llm.queries import ORACLES, QUERIES
from textforge.llm.repeats import RepeatSettings, without_repeats

SCHEMA = "doc_id long, text string, block long, run int, mini string, id string"


def brute(rows, window=35):
    """(doc_id, n_words, n_removed, kept) by counting every window."""
    docs = [(d, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for d, t in rows]
    seen = {}
    for _, words in docs:
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for d, words in docs:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((d, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=str)


def run(spark, rows, s=RepeatSettings(), parts=3):
    df = spark.createDataFrame([(d, t, 1, 2, "x", "y") for d, t in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in without_repeats(df, s).collect()), key=str)


def passages(seed, n_docs, shared, vocabulary=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ä", "wörd", "\x1cx", "0"]
    common = [[draw.choice(words) for _ in range(draw.randint(30, 70))] for _ in range(shared)]
    rows = []
    for d in range(n_docs):
        text = []
        for _ in range(draw.randint(0, 4)):
            text += [draw.choice(words) for _ in range(draw.randint(0, 60))]
            if draw.random() < 0.5:
                text += draw.choice(common)
        rows.append((d, draw.choice([" ", "\n", "\t \r"]).join(text)))
    return rows


def test_equals_brute_force(spark):
    rows = passages(1, 120, 6)
    want = brute(rows)
    assert any(r[2] for r in want) and any(not r[2] for r in want)
    assert run(spark, rows) == want
    # Split minimisers and small blocks give the same.
    assert run(spark, rows, RepeatSettings(hot_runs=3, block_bytes=2000)) == want
    assert run(spark, rows, RepeatSettings(hot_runs=1, block_bytes=500, bucket_bytes=100), 7) == want


def test_periodic_texts_and_short_windows(spark):
    rows = [(1, "a " * 40), (2, "a b " * 30), (3, "x y z " * 11 + "x y"), (4, " ".join(map(str, range(80)))), (5, "a"), (6, "q r s t"), (7, "s t u")]
    for window in (35, 2, 1):
        for hot in (1, 200):
            assert run(spark, rows, RepeatSettings(window=window, hot_runs=hot)) == brute(rows, window)


def test_edges(spark):
    same = " ".join(f"k{i}" for i in range(40))
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, same), (5, same), (None, same + " tail"), (6, same.upper()),
            (7, "head " + same.replace(" ", "\x0b \x0c", 20)), (8, "z" * 100_000 + " " + same), (9, " ".join(f"u{i}" for i in range(200_000)))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_one_common_passage_in_all_rows(spark):
    common = " ".join(f"c{i}" for i in range(50))
    rows = [(i, f"a{i} b{i} {common} d{i} e{i}") for i in range(600)]
    assert run(spark, rows, RepeatSettings(block_bytes=4000, hot_runs=20)) == sorted([(i, 54, 50, f"a{i} b{i} d{i} e{i}") for i in range(600)], key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80), st.integers(1, 9))
def test_window_ranks_order_windows(codes, window):
    codes = np.array(codes)
    ranks = np.unique(repeats.window_ranks(codes, window), return_inverse=True)[1]
    keys = [tuple(codes[k:k + window]) for k in range(len(codes) - window + 1)]
    order = {key: k for k, key in enumerate(sorted(set(keys)))}
    if keys:
        assert ranks.tolist() == [order[k] for k in keys]


def test_digest_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_repeated_passages"](spark, "/root/testdata/sf0.001").collect()}
    con = duckdb.connect()
    rows = con.execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    want = brute(rows)
    assert len(got) == len(want) and any(r[2] for r in want)
    for doc_id, n_words, n_removed, kept in want:
        assert tuple(got[doc_id]) == (doc_id, n_words, n_removed, hashlib.sha256(kept.encode()).hexdigest())
    assert "op12_repeated_passages" in ORACLES
