"""Hard negatives and clusters against plain loops."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import centroids, hard_negatives

ROWS = "id long, label string, vector array<long>"


def plain_negatives(rows, every, k=5, percent=80):
    """(anchor, positive, rank, negative, scores) of rows (id, label, vector)."""
    out = []
    late = lambda i: (i is None, i or 0)
    for a, (i, label, v) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other, b)
                  for b, (j, other, w) in enumerate(rows) if b != a and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], late(s[1])))
        for p, j, _, _ in [s for s in scored if s[2] == label][:k]:
            fit = [s for s in scored if s[2] != label and percent * p <= 100 * s[0] <= 100 * p][:k]
            out += [(i, j, rank, s[1], p, s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, every, **sizes):
    frame = spark.createDataFrame(rows, ROWS)
    out = hard_negatives.mine(frame, F.col("id") % every == 0, **sizes)
    return sorted((tuple(r) for r in out.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_negatives_equal_all_scores(spark, spread):
    rng = np.random.default_rng(int(100 * spread))
    middle = rng.standard_normal((6, 12))
    rows = []
    for i in range(700):
        v = middle[i % 6] + spread * rng.standard_normal(12)
        rows.append((int(i), f"l{i % 4}", [int(x) for x in np.floor(40 * v * (1 + i % 3))]))
    got = mined(spark, rows, 20, block=16, chunk=150, bucket=32)
    assert got == plain_negatives(rows, 20) and got


def test_few_values_and_many_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), "ab"[i % 2], [int(x) for x in rng.integers(0, 2, 4)]) for i in range(200)]
    rows += [(300, "a", [0, 0, 0, 0]), (301, "b", [0, 0, 0, 0]), (302, "c", [1, 1, 1, 1]), (303, "a", [-5, 0, 0, 0])]
    assert mined(spark, rows, 3, block=8, chunk=64, bucket=16) == plain_negatives(rows, 3)


def test_odd_vectors(spark):
    rows = [
        (0, "a", [3, 4]), (0, "a", [3, 4]), (1, "a", [3, 3]), (2, "b", [3, 4]), (3, "b", [3, 3]), (4, "b", [1, 1]),
        (None, "a", [4, 4]), (None, "b", [3, 3]), (5, None, [9, 9]), (6, "b", None), (7, "b", [1, None]),
        (10, "b", []), (20, "a", []), (30, "a", []), (40, "b", [1, 2, 3]),
    ]
    whole = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    assert mined(spark, rows, 10) == plain_negatives(whole, 10)
    assert mined(spark, [], 10) == []
    big = [(0, "a", [1 << 40, 0]), (1, "a", [1 << 40, 1]), (2, "b", [1 << 40, 2])]
    with pytest.raises(Exception, match="too large"):
        mined(spark, big, 10)
    fits = [(i, "ab"[i % 2], [(1 << 30) + i, -i]) for i in range(12)]
    assert mined(spark, fits, 5) == plain_negatives(fits, 5)


def test_pruning_never_drops_a_row_that_reaches():
    rng = np.random.default_rng(8)
    for dim in (2, 8, 64):
        x = np.floor(100 * rng.standard_normal((500, dim)) * rng.uniform(0.1, 3, (500, 1)))
        (bucket,) = hard_negatives.buckets(x, *(np.arange(500),) * 3, size=500)
        for anchor in x[:60]:
            scores = bucket.vectors @ anchor
            for least in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
                kept = bucket.candidates(anchor, np.sqrt(anchor @ anchor), least)
                assert kept is None or set(np.flatnonzero(scores >= least)) <= set(kept)
        pruned = bucket.candidates(anchor, np.sqrt(anchor @ anchor), (anchor @ anchor))
        assert pruned is not None and len(pruned) < 500


# clusters


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centres = [v for i, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    square = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min(range(len(centres)), key=lambda j: (square(v, centres[j]), j))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(i, nearest(v)) for i, v in kept]
    far = [square(v, centres[j]) for (_, v), (_, j) in zip(kept, out)]
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((
        (i, j, d, sum(x for x, (_, a) in zip(far, out) if a == j), sum(far), name(centres[j]))
        for (i, j), d in zip(out, far)), key=repr)


def clustered(spark, rows, dim, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance int")
    out = centroids.cluster_vectors(frame, dim=dim, **options).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.0, 0.02, 1.0])
def test_clusters_equal_plain_rounds(spark, spread):
    rng = np.random.default_rng(int(1000 * spread) + 1)
    middle = rng.standard_normal((5, 6))
    rows = [(int(i), [float(x) for x in middle[i % 5] + spread * rng.standard_normal(6)]) for i in range(400)]
    assert clustered(spark, [r + ("x", 1) for r in rows], 6) == plain_clusters(rows)


def test_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i % 60), [float(x) for x in rng.integers(0, 2, 3)]) for i in range(150)]
    rows += [(None, [0.5, 0.25, -0.125]), (None, [9.0, -9.0, 0.0]), (70, [1e-9, -1e-9, 0.0])]
    odd = [(80, None), (81, [1.0, 2.0]), (82, [1.0, None, 0.0]), (83, [float("nan"), 0.0, 0.0]),
           (84, [float("inf"), 0.0, 0.0]), (85, [])]
    got = clustered(spark, [r + ("x", 1) for r in rows + odd], 3)
    assert got == plain_clusters(rows)
    assert clustered(spark, [r + ("x", 1) for r in odd], 3) == []
    assert clustered(spark, [(1, [0.5, 0.5], "x", 1)], 2) == plain_clusters([(1, [0.5, 0.5])])
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [1e30], "x", 1)], 1)


def test_only_expired_gaps_are_compared_again(spark):
    """Two far groups: after the first rounds no gap expires, so later runs are empty."""
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(100 * (i % 2) + x) for x in rng.random(2)], "x", 1) for i in range(300)]
    sizes, push = [], centroids.Heaps.push

    def counted(self, frame):
        run = push(self, frame)
        sizes.append(run.count())
        return run

    centroids.Heaps.push = counted
    try:
        clustered(spark, rows, 2, k=2)
    finally:
        centroids.Heaps.push = push
    assert sizes[0] == 300 and sum(sizes[3:]) < 300
