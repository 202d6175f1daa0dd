from hashlib import sha256

import numpy as np
import pytest

from quaybook.llm import bisector

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], SCHEMA)


def brute(rows, k, rounds, dim, scale=64):
    """(id, cluster, distance) and the centroids, vector by vector."""
    points = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
              if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(points, key=lambda p: (sha256(f"1:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    centroids = [p for _, p in order[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        near = [nearest(p)[1] for _, p in points]
        centroids = [[sum(x) // len(x) for x in zip(*mine)] if (mine := [p for (_, p), j in zip(points, near) if j == c]) else old
                     for c, old in enumerate(centroids)]
    return sorted(repr((i, nearest(p)[1], nearest(p)[0])) for i, p in points), centroids


def found(spark, rows, **options):
    assigned, centroids = bisector.cluster(frame(spark, rows), **options)
    return sorted(repr((r.vec_id, r.cluster, r.distance)) for r in assigned.collect()), centroids.tolist()


@pytest.mark.parametrize("k,dim,spread", [(5, 3, 1.0), (7, 2, 0.05), (16, 4, 3.0), (1, 2, 1.0)])
def test_brute_force(spark, k, dim, spread):
    rng = np.random.default_rng(k)
    rows = [(int(i), (spread * rng.standard_normal(dim)).tolist()) for i in range(200)]
    rows += rows[:20] + [(1000 + i, rows[0][1]) for i in range(100)]  # repeated rows and a hot vector
    rows += [(5, None), (6, []), (7, [1.0] * (dim + 1)), (8, [None] * dim), (9, [float("nan")] * dim),
             (10, [float("-inf")] * dim), (None, [0.5] * dim), (None, [0.25] * dim)]
    assert found(spark, rows, k=k, rounds=3, dim=dim) == brute(rows, k, 3, dim)


def test_ties_go_to_the_smaller_number():
    t = bisector.Tournament(np.array([[0, 0], [4, 0], [0, 4], [4, 4]]))
    assert t.nearest(np.array([[2, 2], [2, 0], [4, 2], [3, 3], [0, 2]])).tolist() == [0, 0, 1, 3, 0]


def test_equal_centroids_and_empty_clusters(spark):
    rows = [(i, [1.0, 1.0]) for i in range(6)] + [(9, [5.0, 5.0])]
    got, centroids = found(spark, rows, k=4, rounds=2, dim=2)
    assert (got, centroids) == brute(rows, 4, 2, 2)


def test_fewer_vectors_than_centroids_and_empty(spark):
    rows = [(3, [1.0, 2.0]), (4, [2.0, 1.0])]
    assert found(spark, rows, k=16, dim=2) == brute(rows, 16, 3, 2)
    assigned, centroids = bisector.cluster(frame(spark, [(1, None)]), dim=2)
    assert len(centroids) == 0 and bisector.with_inertia(assigned, centroids).collect() == []


def test_inertia_and_bounds(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(50)]
    assigned, centroids = bisector.cluster(frame(spark, rows), k=3, dim=2)
    got = bisector.with_inertia(assigned, centroids).collect()
    assert {r.inertia for r in got} == {sum(r.distance for r in got)}
    for c in range(3):
        assert {r.cluster_inertia for r in got if r.cluster == c} == {sum(r.distance for r in got if r.cluster == c)}
        assert {r.centroid for r in got if r.cluster == c} == {",".join(map(str, centroids[c]))}
    with pytest.raises(ValueError, match="pair normals"):
        bisector.cluster(frame(spark, rows), k=100_000, dim=2)
    with pytest.raises(Exception, match="not be exact"):
        bisector.cluster(frame(spark, [(1, [1e30, 0.0])]), dim=2)
