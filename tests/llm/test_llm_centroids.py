"""Clusters in integers against a plain version, and the lower bound against all distances."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import centroids


def plain_clusters(rows, dims=64, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [x for _, x in first[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        groups = [[] for _ in points]
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        points = [[sum(c) // len(g) for c in zip(*g)] if g else p for g, p in zip(groups, points)]
    found = [(i, *nearest(x)) for i, x in kept]
    sums = [sum(d for _, d, c in found if c == n) for n in range(len(points))]
    shas = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, sums[c], sum(sums), shas[c]) for i, d, c in found), key=str)


def clustered(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("CLUSTER", F.lit("x"))
    return sorted((tuple(r) for r in centroids.clusters(df.repartition(3), **how).collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_plain_version(spark, seed):
    random = np.random.default_rng(seed)
    middles = random.standard_normal((5, 64))
    rows = [(i, (middles[i % 5] + random.standard_normal(64) * 0.3).tolist()) for i in range(120)]
    rows += [(7, rows[3][1]), (None, rows[4][1]), (500, rows[5][1]), (501, rows[5][1])]
    rows += [(502, None), (503, [1.0] * 63), (504, [1.0] * 65), (505, [1.0] * 63 + [None]),
             (506, [1.0] * 63 + [float("nan")]), (507, [1.0] * 63 + [float("-inf")]), (508, [0.0] * 64), (509, [-0.0001] * 64)]
    assert clustered(spark, rows) == plain_clusters(rows)


def test_few_and_no_vectors(spark):
    one = [(3, [float(x) for x in range(64)])]
    assert clustered(spark, one) == plain_clusters(one)
    same = [(i, [0.5] * 64) for i in range(12)]
    assert clustered(spark, same) == plain_clusters(same)
    assert clustered(spark, []) == []
    assert clustered(spark, [(1, None), (None, None)]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [131_071.999 * (-1) ** (i * j % 3) for j in range(64)]) for i in range(20)]
    assert clustered(spark, rows) == plain_clusters(rows)
    assert clustered(spark, [(1, [131_072.0] + [0.0] * 63)]) == []


@pytest.mark.parametrize("spread", [0, 1, 30, 100_000])
def test_the_bound_rules_out_no_nearest_centroid(spread):
    random = np.random.default_rng(spread)
    x = (random.integers(-5, 6, (2000, 64)) * spread + random.integers(-2, 3, (2000, 64))).astype(np.int64)
    x = x * (np.arange(64) < 5) + random.integers(-1, 2, (2000, 64))
    centre = x.mean(axis=0)
    turn = centroids.Rotation(centre, np.linalg.eigh(np.cov(x.T))[1][:, ::-1])
    points = x[:8].tolist()
    points[5] = points[2]
    cluster, distance, verified = centroids.Centroids.of(points, turn).nearest(x, *turn.split(x))
    every = ((x[:, None, :] - np.array(points)[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert verified <= every.size
    if spread == 100_000:
        assert verified < every.size / 3
