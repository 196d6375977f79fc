import numpy as np

from textforge.llm.topk import exact_top_k, integer_vectors

SCHEMA = "vec_id long, embedding array<double>, v string, dims int, score long"


def brute(rows, k=5):
    import math
    vs = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            vs.setdefault((i, tuple(math.floor(256 * x) for x in e)), None)
    out = []
    for i, q in vs:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in vs if j != i and len(c) == len(q))[:k]
            out += [(i, r, j, -x) for r, (x, j) in enumerate(s, 1)]
    return sorted(out)


def run(spark, rows, **blocks):
    df = integer_vectors(spark.createDataFrame([(i, e, "v", 1, 2) for i, e in rows], SCHEMA))
    return sorted(tuple(r) for r in exact_top_k(df, df.where("vec_id % 50 = 0"), 5, **blocks).collect())


def test_equals_brute_force_with_ties(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=20).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one common vector
    assert run(spark, rows, query_block=3, candidate_block=64) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]), (6, [0.5, 0.5]), (6, [0.5, 0.5]), (50, [1.0, 2.0]),
            (None, [1.0, 1.0]), (100, [0.1, 0.2, 0.3]), (7, [0.1, 0.2, 0.3]), (150, [3.0]), (8, [1e9, 1e9]), (9, [-1e9, 1e10])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
