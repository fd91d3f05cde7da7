import hashlib
import math

import numpy as np
import pytest

from quillmill.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, distance long"


def brute(rows, clusters, rounds, seed, scale):
    """Full searches over lists, in Python's integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), np.array(r[1], "<i4").tobytes()))[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for r in range(rounds + 1):
        near = [min((far(v, c), k) for k, c in enumerate(centroids)) for _, v in kept]
        if r < rounds:
            for k in range(len(centroids)):
                mine = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == k]
                if mine:
                    centroids[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i is None, i or 0), c, d) for (i, _), (d, c) in zip(kept, near, strict=True)), centroids


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 7, 7) for i, v in rows], SCHEMA).repartition(3)
    found, centroids = clustering.cluster_vectors(df, **options)
    return sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"]) for r in found.collect()), centroids.tolist()


@pytest.mark.parametrize(("spread", "rounds", "clusters"), [(0.5, 5, 7), (3.0, 8, 5), (1e5, 3, 4)])  # the last beyond exact doubles
def test_against_full_searches(spark, spread, rounds, clusters):
    rng = np.random.default_rng(clusters)
    rows = [(i, (rng.integers(-3, 4, 4) * spread + rng.normal(0, spread / 4, 4)).tolist()) for i in range(300)]
    rows += [(i, rows[i][1]) for i in range(0, 90, 3)] + [(None, rows[1][1]), (None, rows[2][1])]  # repeated rows, null ids
    options = {"clusters": clusters, "rounds": rounds, "components": 4}
    assert got(spark, rows, **options) == brute(rows, clusters, rounds, 2, 256)


def test_ties_and_few_vectors(spark):
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([0, 0, 1, 1, 2, 2, 3, 4, 4, 4])]
    for clusters in (1, 2, 3, 40):  # equal starts, distances alike on both sides, and more clusters than vectors
        assert got(spark, rows, clusters=clusters, components=2, scale=2) == brute(rows, clusters, 5, 2, 2)


def test_odd_and_empty_tables(spark):
    good = [0.25] * 64
    rows = [(1, good), (2, None), (3, []), (4, [0.5] * 63), (5, [0.5] * 65), (6, [None, *good[1:]]), (7, [float("nan"), *good[1:]]), (8, [float("-inf"), *good[1:]]), (None, good)]
    assert [(i, c, d) for i, c, d in got(spark, rows)[0]] == [((False, 1), 0, 0), ((True, 0), 0, 0)]
    for none in ([], rows[1:8]):
        df = spark.createDataFrame([(i, v, 1, 7, 7) for i, v in none], SCHEMA)
        assert clustering.with_inertia(*clustering.cluster_vectors(df)).collect() == []
    with pytest.raises(Exception, match="would not fit a long"):
        got(spark, [(1, [1e9] * 64)])


def test_bounds_spare_searches():
    """With centroids that hardly move nearly no vector is compared with all of them, and no bound is ever wrong."""
    rng = np.random.default_rng(3)
    centers = rng.integers(-400, 400, (12, 16))
    x = centers[rng.integers(0, 12, 4000)] + rng.integers(-25, 26, (4000, 16))
    cluster, upper, lower = np.full(len(x), -1, np.int32), np.full(len(x), np.inf), np.zeros(len(x))
    assert clustering.assign(x, cluster, upper, lower, centers, np.zeros(12)) == 4000
    scans = 0
    for _ in range(5):
        moved = centers + rng.integers(-4, 5, centers.shape)
        scans += clustering.assign(x, cluster, upper, lower, moved, np.sqrt(((moved - centers) ** 2).sum(1)) * clustering.OUT)
        centers, d = moved, np.sort(clustering.squares(x, moved), 1)
        assert (cluster == clustering.squares(x, moved).argmin(1)).all() and (upper**2 >= d[:, 0]).all() and (lower**2 <= d[:, 1]).all()
    assert scans < 200
