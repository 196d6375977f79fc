import hashlib
import math

import numpy as np
import pytest

from textforge.llm import centroids
from textforge.llm.centroids import ClusterSettings, assign, cluster_vectors, clustered, integer_vectors, squared_all

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int, block long"


def brute(rows, s=ClusterSettings()):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) by plain rounds on Python integers."""
    vs = [(i, [math.floor(s.scale * x) for x in e]) for i, e in rows if e is not None and len(e) == s.dims and all(x is not None and math.isfinite(x) for x in e)]
    key = [("~" if i is None else hashlib.sha256(f"{s.salt}:{i}".encode()).hexdigest(), v) for i, v in vs]
    cs = [v for _, v in sorted(key)[:s.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(s.rounds):
        of = [nearest(v)[1] for _, v in vs]
        for j in range(len(cs)):
            own = [v for (_, v), c in zip(vs, of) if c == j]
            if own:
                cs[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in vs]
    total = {}
    for _, c, d in found:
        total[c] = total.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, c, d, total[c], sum(total.values()), digest[c]) for i, c, d in found), key=str)


def run(spark, rows, s=ClusterSettings(), parts=3):
    df = spark.createDataFrame([(i, e, "x", 1, 2) for i, e in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in clustered(df, s).collect()), key=str)


def points(seed, n, dims, groups=6, spread=0.3):
    draw = np.random.default_rng(seed)
    at = draw.normal(size=(groups, dims))
    return [(i, (at[i % groups] + spread * draw.normal(size=dims)).tolist()) for i in range(n)]


def test_equals_plain_rounds(spark):
    rows = points(1, 300, 64)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("k,rounds", [(1, 3), (5, 0), (5, 1), (12, 12), (40, 4)])
def test_other_settings(spark, k, rounds):
    s = ClusterSettings(clusters=k, rounds=rounds, dims=3, scale=16.0, salt="s", block_rows=7)
    rows = points(k, 90, 3, spread=0.8)
    assert run(spark, rows, s) == brute(rows, s)


def test_ties_repeats_and_odd_rows(spark):
    s = ClusterSettings(clusters=4, rounds=5, dims=2, scale=1.0)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 5.0]), (None, [1.0, 1.0]), (4, None), (5, []), (6, [1.0]),
            (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [-0.5, -7.25]), (12, [1e7, -1e7]), (13, [1.0, 0.0])]
    assert run(spark, rows, s) == brute(rows, s)
    few = [(1, [0.0, 1.0]), (2, [0.0, 1.0])]
    assert run(spark, few, s) == brute(few, s)
    assert run(spark, [], s) == []
    same = [(i, [1.0, 1.0]) for i in range(30)]
    assert run(spark, same, s) == brute(same, s)


def test_components_beyond_the_exact_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e30, 0.0])], ClusterSettings(dims=2, clusters=2))


def test_bounds_spare_evaluations_and_history_is_tighter_than_sums(spark):
    s = ClusterSettings(clusters=6, rounds=8, dims=8)
    df = spark.createDataFrame(points(3, 2000, 8, spread=0.25), "vec_id long, embedding array<double>")
    _, _, checked = cluster_vectors(integer_vectors(df, s), s)
    assert sum(checked) < 0.6 * 2000 * len(checked)
    # A centroid that goes away and comes back leaves its old distances as they were.
    v, c = np.array([[0, 0], [10, 0]]), np.array([[[1, 0], [9, 0]], [[1, 40], [9, 40]], [[1, 0], [9, 0]]])
    dist = squared_all(v, c[0])
    cluster, _, _, n = assign(v, np.array([0, 1], np.int16), dist, np.zeros((2, 2), np.int16), c)
    assert n == 0 and cluster.tolist() == [0, 1]


def test_exact_beyond_doubles():
    draw = np.random.default_rng(2)
    v, c = draw.integers(-(1 << 27), 1 << 27, (50, 64)), draw.integers(-(1 << 27), 1 << 27, (4, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert squared_all(v, c).tolist() == want
    assert squared_all(v >> 10, c >> 10).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c >> 10] for x in v >> 10]
    assert centroids._LARGEST == 1 << 27
