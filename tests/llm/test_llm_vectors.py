"""Centroid clustering and hard negatives against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millpulse.llm import bisector, negatives

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, row int, _rank string"


def frame(spark, rows):
    """(vec_id, vector, label) rows with columns whose names an operator might use itself."""
    return spark.createDataFrame([(i, v, label, "cluster", 7, "rank") for i, v, label in rows], SCHEMA)


def sound(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def whole(vector, scale=256):
    return [math.floor(scale * x) for x in vector]


# ---- clustering -------------------------------------------------------------------------------

def clustered(rows, k, dims, rounds):
    points = [(i, whole(v)) for i, v, _ in rows if sound(v) and len(v) == dims]
    start = sorted(points, key=lambda p: (hashlib.sha256(f"2:{'' if p[0] is None else p[0]}".encode()).hexdigest(), np.array(p[1], "<i4").tobytes()))
    centroids = [p for _, p in start[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, p in points:
            groups.setdefault(nearest(p)[1], []).append(p)
        for n, members in groups.items():
            centroids[n] = [sum(xs) // len(members) for xs in zip(*members)]
    placed = [(i, *nearest(p)) for i, p in points]
    total = sum(d for _, d, _ in placed)
    of = {n: sum(d for _, d, m in placed if m == n) for _, _, n in placed}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, of[n], total, prints[n]) for i, d, n in placed), key=repr)


def vectors(seed, n, dims, spread=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(n)]


ODD = [None, [], [0.5] * 3, [math.nan] * 4, [math.inf] * 4, [None, 1.0, 1.0, 1.0]]


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_clusters_match_a_plain_version(spark, k):
    rows = [(i, v, 0) for i, v in enumerate(vectors(1, 300, 4))]
    # A grid of small whole numbers, so that many vectors lie on bisectors; one vector that a third of the rows share.
    rng = random.Random(2)
    rows += [(1_000 + i, [rng.randrange(-2, 3) / 256 for _ in range(4)], 0) for i in range(300)]
    rows += [(2_000 + i, [0.25, -0.25, 0.0, 1.0], 0) for i in range(300)]
    rows += [(5, [9.0] * 4, 0), (5, rows[5][1], 0), (None, [1.0] * 4, 0)] + [(3_000 + i, v, 0) for i, v in enumerate(ODD)]
    got = bisector.cluster(frame(spark, rows).repartition(7), clusters=k, dims=4, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == clustered(rows, k, 4, 3)


def test_the_tournament_finds_the_smallest_of_the_nearest():
    rng = np.random.default_rng(0)
    for k in range(1, 12):
        centroids = rng.integers(-3, 4, (k, 3))
        points = rng.integers(-4, 5, (500, 3))
        distance = ((points[:, None] - centroids[None]) ** 2).sum(2)
        assert (bisector.Bisectors.of(centroids).nearest(points) == distance.argmin(1)).all()
        far = 2**20  # beyond what doubles are used for
        assert (bisector.Bisectors.of(centroids * far).nearest(points * far) == distance.argmin(1)).all()


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(3, 3, 4))]
    got = bisector.cluster(frame(spark, rows), clusters=5, dims=4, rounds=2)
    assert sorted(map(tuple, got.collect()), key=repr) == clustered(rows, 5, 4, 2)
    empty = bisector.cluster(frame(spark, []), dims=4)
    assert empty.count() == 0 and empty.columns == got.columns
    with pytest.raises(Exception, match="beyond"):
        bisector.cluster(frame(spark, [(1, [1e30] * 4, 0)]), dims=4)


# ---- hard negatives ---------------------------------------------------------------------------

def mined(rows, anchor, n_positives=5, k=10, low=30, high=90):
    held = [(i, whole(v), label) for i, v, label in rows if i is not None and label is not None and sound(v)]
    out = []
    for a, (anchor_id, x, label) in enumerate(held):
        if not anchor(anchor_id):
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, n, other == label) for n, (i, y, other) in enumerate(held) if n != a and len(y) == len(x)]
        scored.sort(key=lambda s: s[:2])
        for score, positive, _, _ in [s for s in scored if s[3]][:n_positives]:
            inside = [(s, i) for s, i, _, same in scored if not same and low * -score <= 100 * -s <= high * -score][:k]
            out += [(anchor_id, positive, rank, i, -score, -s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def grouped(seed, n, dims, labels, spread):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    return [(i, [c + rng.gauss(0, spread) for c in centres[i % labels]], i % labels) for i in range(n)]


@pytest.mark.parametrize("spread", [0.4, 2.0])
def test_negatives_match_a_plain_version(spark, spread):
    rows = grouped(4, 600, 6, 4, spread)
    rows += [(1_000 + i, rows[0][1], 1) for i in range(200)]  # one vector that many rows share
    rows += [(2_000 + i, [x / 2 for x in rows[0][1]], 2) for i in range(100)]  # ties in a window
    rows += [(20, rows[20][1], 0), (40, rows[41][1], 1), (None, rows[0][1], 0), (60, rows[60][1], None)]
    rows += [(4_000 + 20 * i, v, 0) for i, v in enumerate(ODD)]
    got = negatives.mine(frame(spark, rows).repartition(5), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 20 == 0)


def test_several_blocks_and_runs_give_the_same_rows(spark, monkeypatch):
    rows = grouped(5, 400, 5, 3, 1.0)
    want = mined(rows, lambda i: i % 4 == 0)
    monkeypatch.setattr(negatives, "ANCHORS", 30)
    got = negatives.mine(frame(spark, rows).repartition(3), F.col("vec_id") % 4 == 0)
    assert want and sorted(map(tuple, got.collect())) == want


def test_tiny_runs_keep_the_same_rows():
    rng = np.random.default_rng(6)
    group, score, ids = rng.integers(0, 7, 2_000), rng.integers(-20, 20, 2_000), rng.integers(0, 900, 2_000)
    best = negatives.Best(7, 4)
    for at in range(0, 2_000, 13):
        part = slice(at, at + 13)
        best.add(group[part], score[part], ids[part], np.arange(2_000)[part])
    want = [sorted(zip(-score[group == g], ids[group == g]))[:4] for g in range(7)]
    got = [list(zip(-best.score[best.group == g], best.vec_id[best.group == g])) for g in range(7)]
    assert got == want


def test_no_anchor_no_rows_and_large_components(spark):
    empty = negatives.mine(frame(spark, []), F.col("vec_id") % 2 == 0)
    assert empty.count() == 0 and empty.columns[0] == "anchor_id"
    lone = negatives.mine(frame(spark, [(2, [1.0, 2.0], 0)]), F.col("vec_id") % 2 == 0)
    assert lone.count() == 0
    big = [(2, [1e6, 1e6], 0), (3, [1e6 + 1 / 256, 1e6], 0), (5, [5e5, 5e5], 1), (7, [5e5 + 1 / 256, 5e5], 2)]  # beyond 2^53
    assert sorted(map(tuple, negatives.mine(frame(spark, big), F.col("vec_id") == 2).collect())) == mined(big, lambda i: i == 2)
    with pytest.raises(Exception, match="beyond"):
        negatives.mine(frame(spark, [(2, [1e30], 0)]), F.col("vec_id") == 2)
