"""Integer clustering against the plain rounds over all centroids."""

import hashlib
import math

import numpy as np
import pytest

from candlewick.llm import centroids

VECTORS = "vec_id long, embedding array<float>"


def plain(rows, length, clusters, rounds, scale=256, salt="2:"):
    fine = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(fine, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[1]))
    means = [list(v) for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in fine:
            groups.setdefault(near(v)[1], []).append(v)
        means = [[sum(x) // len(groups[c]) for x in zip(*groups[c], strict=True)] if c in groups else m for c, m in enumerate(means)]
    last = [(i, *near(v)) for i, v in fine]
    own = {}
    for _, d, c in last:
        own[c] = own.get(c, 0) + d
    return sorted(((i, c, d, own[c], sum(own.values()), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for i, d, c in last), key=str)


def made(seed, n, length, centres=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(centres, length))
    return [(k, (base[rng.integers(centres)] + 0.2 * rng.normal(size=length)).tolist()) for k in range(n)]


ODD = [(900, None), (901, []), (902, [None] * 8), (903, [math.nan] * 8), (904, [math.inf] * 8), (905, [1.0] * 7), (None, [0.0] * 8), (906, [0.0] * 8), (906, [0.0] * 8)]


@pytest.mark.parametrize(("seed", "clusters", "leading"), [(1, 5, 3), (2, 12, 8), (3, 400, 2)])
def test_equal_to_plain_rounds(spark, seed, clusters, leading):
    rows = made(seed, 150, 8) + [(k + 500, v) for k, v in made(seed, 20, 8)] + ODD
    found = centroids.cluster(spark.createDataFrame(rows, VECTORS), length=8, clusters=clusters, rounds=3, leading=leading)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, 8, clusters, 3)


def test_bounds_rule_out_most_centroids():
    points = np.floor(256 * np.array([v for _, v in made(4, 2_000, 64, 40)])).astype(np.int64)
    middle = points[:40]
    mean = points.mean(0)
    _, axes = np.linalg.eigh(np.cov(points.T))
    rotated = centroids.Rotated(mean, axes[:, ::-1], 16)
    best, distance, measured = centroids.nearest(points, *rotated.place(points), middle, rotated)
    table = ((points[:, None] - middle) ** 2).sum(2)
    assert (best == table.argmin(1)).all() and (distance == table.min(1)).all()
    assert measured < 0.25 * table.size


def test_ties_go_to_the_smaller_number_and_far_points_stay_exact():
    points = np.array([[0, 0], [1, 0], [1 << 27, -(1 << 27)]], np.int64)
    middle = np.array([[1, 0], [-1, 0], [1, 0], [(1 << 27) - 1, 0]], np.int64)
    rotated = centroids.Rotated(np.zeros(2), np.eye(2), 1)
    best, distance, _ = centroids.nearest(points, *rotated.place(points), middle, rotated)
    assert best.tolist() == [0, 0, 3] and distance.tolist() == [1, 0, 1 + (1 << 54)]


def test_empty_table_other_columns_and_large_components(spark):
    assert centroids.cluster(spark.createDataFrame([], VECTORS)).count() == 0
    clash = spark.createDataFrame([(1, [1.0, 2.0], 5, "x")], "vec_id long, embedding array<float>, cluster int, point string")
    assert centroids.cluster(clash, length=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="no room"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], VECTORS), length=2).count()
