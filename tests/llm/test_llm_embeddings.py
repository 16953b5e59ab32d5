"""Recall of the multi-index tables, exact counts, and odd vectors."""

import os

import numpy as np
import pytest

from tapeworks.llm import embedding_itq
from tapeworks.llm.embedding_itq import Plan


def plain(ids, vectors, least=0.9):
    """Links and smallest reachable ids by brute force; None for a vector that links with nothing."""
    good = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(vectors[i], dtype=float) / np.linalg.norm(vectors[i]) for i in good}
    links = {i: {j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least} for i in good}
    return [len(links.get(i, ())) for i in range(len(ids))], links


def test_rotations_are_orthogonal_and_codes_balanced():
    random = np.random.default_rng(0)
    unit = random.standard_normal((1000, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes = embedding_itq.learned(unit, Plan(8, 8))
    first = codes.projections[:, :32]
    assert np.allclose(first.T @ first, np.eye(32))
    signs = unit @ codes.projections - codes.mean @ codes.projections > 0
    assert np.all(np.abs(signs.mean(axis=0) - 0.5) < 0.1)
    assert codes.keys(unit).shape == (1000, 8) and codes.keys(unit).max() < 256


@pytest.mark.parametrize("n", [0, 1])
def test_rotations_of_next_to_nothing(n):
    assert embedding_itq.learned(np.ones((n, 4)) / 2, Plan(3, 4)).keys(np.ones((2, 4)) / 2).shape == (2, 3)


@pytest.fixture(scope="module")
def clusters():
    random = np.random.default_rng(7)
    vectors = []
    for size in (1,) * 60 + (2, 3, 5, 40):
        centre = random.standard_normal(24)
        centre /= np.linalg.norm(centre)
        vectors += [(centre + random.standard_normal(24) * 0.04).astype(np.float32).tolist() for _ in range(size)]
    vectors += [vectors[0]] * 6 + [[2 * x for x in vectors[1]]]
    return vectors


def test_links_and_components(spark, clusters):
    ids = list(range(100, 100 + len(clusters)))
    frame = spark.createDataFrame(list(zip(ids, clusters)), "vec_id long, embedding array<float>")
    counts, links = plain(ids, clusters)
    for block, plan in ((8, None), (512, None), (16, Plan(6, 6, 1)), (512, Plan(6, 6, 1))):  # small blocks: buckets are dealt out
        found = {r[0]: r for r in embedding_itq.near_duplicates(frame, block=block, plan=plan).collect()}
        assert len(found) == len(ids)
        assert all(found[i]["n_links"] <= c for i, c in zip(ids, counts))
        assert sum(r["n_links"] for r in found.values()) >= 0.9 * sum(counts)
        for i in links:
            for j in links[i]:
                assert found[ids[i]]["component_id"] <= min(ids[i], ids[j])
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
        assert len({r["component_id"] for r in found.values()}) == 64


NAN, INF = float("nan"), float("inf")
ODD = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 1.0]),
       (9, [3.0, 3.0]), (10, [-1.0, -1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0]), (11, [1.0, 1.0, 0.0]), (12, [1.0, 1.0, 0.0]),
       (13, [3e38, 3e38]), (14, [1e-30, 1e-30]), (None, None)]


def test_odd_vectors(spark):
    frame = spark.createDataFrame([(*r, "x") for r in ODD], "vec_id long, embedding array<float>, vec string")
    found = sorted(((r[0], r[1], r[2], r[3]) for r in embedding_itq.near_duplicates(frame).collect()), key=str)
    near = 6  # of 7, 8, 8, 9, 13, 14 and the row without an id, all but itself
    wanted = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)] + [(i, near, 7, i == 7) for i in (7, 8, 8, 9, 13, 14)]
    wanted += [(None, near, 7, False), (None, 0, None, False), (11, 1, 11, True), (12, 1, 11, False)]
    assert found == sorted(wanted, key=str)


def test_double_precision_and_all_lengths(spark, monkeypatch):
    rows = [(1, [1e200, 0.0, 0.0]), (2, [1e200, 1e190, 0.0]), (3, [0.0, 1e-200, 0.0]), (4, [1.0, 0.0]), (5, [2.0, 0.01]), (6, [0.0, 1.0]),
            (7, [5.0]), (8, [0.5]), (9, [-1.0]), (10, [1.0] * 9), (11, [1.0] * 8 + [1.1]), (12, [1.0, -1.0] * 4 + [0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (1, 7), 8: (1, 7), 9: (0, 9), 10: (1, 10), 11: (1, 10), 12: (0, 12)}
    for coded in (8, 2):  # lengths without codes of their own are compared whole
        monkeypatch.setattr(embedding_itq, "CODED_LENGTHS", coded)
        assert {r[0]: (r[1], r[2]) for r in embedding_itq.near_duplicates(frame).collect()} == wanted


def test_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_itq.near_duplicates(frame).count() == 0
    useless = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embedding_itq.near_duplicates(useless).collect()] == [(1, 0, 1, True)]


def test_recall_on_the_table(spark):
    from tapeworks.llm.queries import llm_queries

    # The small tables hold no near vectors.
    sf_dir = next(d for d in ("/root/testdata/check_s", "/root/testdata/sf0.1") if os.path.isdir(d))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found = {r["vec_id"]: r["n_links"] for r in llm_queries()["op5_embeddings"](spark, sf_dir).collect()}
    counts = near.sum(axis=1)
    if not counts.sum():
        pytest.skip("the tables here hold no near vectors; the planted ones below do")
    assert all(found[r["vec_id"]] <= c for r, c in zip(rows, counts))
    assert sum(found.values()) >= 0.9 * counts.sum()


def around(random, n, common):
    """Unit vectors about a mean of the given norm, and the mean."""
    mean = np.eye(64)[0] * common
    v = random.standard_normal((n, 64))
    v[:, 0] = 0
    return mean + v / np.linalg.norm(v, axis=1, keepdims=True) * np.sqrt(1 - common**2), mean


def at_cosine(random, a, mean, common, low, high):
    """A vector about the same mean for each of a, at a cosine between the bounds."""
    angle = np.arccos(random.uniform(low, high, len(a)))[:, None]
    away = around(random, len(a), common)[0] - mean
    away -= (away * (a - mean)).sum(axis=1, keepdims=True) / (1 - common**2) * (a - mean)
    # Both share the common part, so it is the rest that turns.
    rest = 1 - (1 - np.cos(angle)) / (1 - common**2)
    turned = away / np.linalg.norm(away, axis=1, keepdims=True) * np.sqrt(1 - common**2)
    return mean + rest * (a - mean) + np.sqrt(1 - rest**2) * turned


@pytest.mark.parametrize("common", [0.0, 0.6, 0.9])
def test_planted_pairs_at_the_least_cosine(spark, common):
    random = np.random.default_rng(11)
    vectors, mean = around(random, 19_000, common)
    near = at_cosine(random, vectors[:1000], mean, common, 0.901, 0.92)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([vectors, near]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    plan = embedding_itq.planned(vectors[:4096], len(rows), 0.9)
    assert plan is not None and plan.rows <= 40
    found = {r[0]: r for r in embedding_itq.near_duplicates(frame).collect()}
    met = sum(found[i]["component_id"] <= i and found[19_000 + i]["component_id"] == found[i]["component_id"] for i in range(1000))
    assert met >= 980


@pytest.mark.parametrize("common", [0.0, 0.6, 0.83])
def test_recall_just_at_the_least_cosine(common):
    random = np.random.default_rng(3)
    a, mean = around(random, 2000, common)
    b = at_cosine(random, a, mean, common, 0.90, 0.92)
    cosines = (a * b).sum(axis=1)
    assert np.allclose(np.linalg.norm(b, axis=1), 1) and cosines.min() > 0.899 and cosines.max() < 0.921
    sample = around(random, 4096, common)[0]
    for plan in (embedding_itq.planned(sample, 20_000, 0.9), embedding_itq.planned(sample, 500, 0.9)):
        codes = embedding_itq.learned(sample, plan, rounds=10)
        differing = np.bitwise_count(codes.keys(a) ^ codes.keys(b))
        assert (differing <= plan.radius).any(axis=1).mean() >= 0.98


def test_neighbouring_keys_find_more():
    random = np.random.default_rng(5)
    a, mean = around(random, 3000, 0.0)
    b = at_cosine(random, a, mean, 0.0, 0.90, 0.92)
    met = []
    for radius in (0, 1):
        codes = embedding_itq.learned(a, Plan(4, 10, radius), rounds=10)
        met.append((np.bitwise_count(codes.keys(a) ^ codes.keys(b)) <= radius).any(axis=1).mean())
    assert met[0] < 0.75 < 0.9 < met[1]


def test_no_plan_means_all_are_compared(spark):
    near_mean = np.ones((300, 64)) / 8 + np.random.default_rng(1).standard_normal((300, 64)) * 1e-3
    units = near_mean / np.linalg.norm(near_mean, axis=1, keepdims=True)
    assert embedding_itq.planned(units, 300, 0.9) is None
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near_mean)], "vec_id long, embedding array<double>")
    assert {tuple(r)[1:3] for r in embedding_itq.near_duplicates(frame).collect()} == {(299, 0)}
