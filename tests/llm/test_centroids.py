from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from bidlens.llm import centroids


def brute_force(rows, length, k, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [list(v) for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, vs in groups.items():
            centres[i] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = {}
    for _, c, d in found:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found], key=str)


@pytest.mark.parametrize("k", [3, 12, 500])
def test_clusters_against_brute_force(spark, k):
    rng = np.random.default_rng(k)
    points = np.float32(rng.standard_normal((150, 8)) * 0.3)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # copies
    odd = [(5000, None), (5001, []), (5002, [1.0] * 7), (5003, [float("nan")] + [1.0] * 7), (5004, [None] + [1.0] * 7), (5005, [float("inf")] + [1.0] * 7),
           (5006, [0.0] * 8), (None, rows[1][1]), rows[2], (7, rows[9][1])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, cluster int, distance string").repartition(3)
    got = centroids.cluster(df, length=8, k=k, rounds=5)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows + odd, 8, k, 5)


def test_nothing_to_cluster(spark):
    df = spark.createDataFrame([(1, [1.0] * 3), (2, None)], "vec_id long, embedding array<float>")
    assert centroids.cluster(df).count() == centroids.cluster(df.limit(0)).count() == 0


def test_dictionaries_lose_nothing_and_join_blocks():
    rng = np.random.default_rng(1)
    for rows in (rng.integers(-500, 500, (100, 7)), rng.integers(0, 2, (300, 16)), np.repeat(rng.integers(-9, 9, (2, 16)), 50, axis=0), np.zeros((1, 5), np.int64)):
        blocks = centroids.encode(rows)
        again = centroids.unpacked(centroids.packed(list(range(len(rows))), rows))
        for b in (blocks, again):
            assert (np.concatenate([d[c] for d, c in zip(b.dictionaries, b.codes, strict=True)], axis=1) == rows).all()
        centres = rng.integers(-400, 400, (6, rows.shape[1]))
        assert (blocks.distances(centres) == ((centres[:, None] - rows[None]) ** 2).sum(axis=2)).all()
        cluster = rng.integers(0, 6, len(rows))
        assert (blocks.sums(cluster, 6) == np.stack([rows[cluster == c].sum(axis=0) for c in range(6)])).all()
    copies = centroids.encode(np.repeat(rng.integers(-9, 9, (2, 16)), 50, axis=0))
    assert len(copies.dictionaries) == 1 and copies.dictionaries[0].shape == (2, 16)
