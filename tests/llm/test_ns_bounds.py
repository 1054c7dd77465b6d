"""Clusters of op11 against the plain algorithm on whole numbers."""

import math
from hashlib import sha256

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import ns_bounds
from meterlake.llm.common import table

DIMS = 6


def plain(rows, k, rounds, seed=1, dims=DIMS):
    """(vec_id, cluster, distance) by all distances in every round, in Python integers."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), centroids


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance double")


def found(spark, rows, k, rounds, dims=DIMS):
    out, centroids = ns_bounds.clusters(ns_bounds.vectors(frame(spark, rows), dims=dims), k, rounds)
    got = out.collect()
    return sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str), centroids.tolist(), sum(r["evaluated"] for r in got)


def random_rows(seed, n, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 1, (7, DIMS))
    return [(i, (centres[i % 7] + r.normal(0, spread, DIMS)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed, spread, k, rounds", [(1, 0.1, 7, 4), (2, 0.8, 5, 8), (3, 0.01, 12, 3)])
def test_equals_the_plain_algorithm(spark, seed, spread, k, rounds):
    rows = random_rows(seed, 400, spread)
    want, centroids = plain(rows, k, rounds)
    got, mine, evaluated = found(spark, rows, k, rounds)
    assert got == want and mine == centroids
    assert evaluated < 0.8 * len(rows) * k * (rounds + 1)  # bounds save distances


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [float(i % 2)] * DIMS) for i in range(40)] + [(99, [0.5] * DIMS)]  # repeated vectors: several first centroids are equal
    want, centroids = plain(rows, 8, 3)
    assert found(spark, rows, 8, 3)[:2] == (want, centroids)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = random_rows(4, 30, 0.5)
    rows = good + [(100, None), (101, []), (102, [0.0] * (DIMS - 1)), (103, [nan] + [0.0] * (DIMS - 1)), (104, [inf] * DIMS), (105, [None] + [1.0] * (DIMS - 1)), (None, [0.25] * DIMS), (7, [0.1] * DIMS), (7, [0.1] * DIMS)]
    want, centroids = plain(rows, 4, 3)
    assert found(spark, rows, 4, 3)[:2] == (want, centroids)


def test_few_and_no_vectors(spark):
    want, centroids = plain(random_rows(5, 3, 0.5), 16, 3)
    assert found(spark, random_rows(5, 3, 0.5), 16, 3)[:2] == (want, centroids)
    out, centroids = ns_bounds.clusters(ns_bounds.vectors(frame(spark, []), dims=DIMS))
    assert out.isEmpty() and len(centroids) == 0


def test_large_components_are_exact_or_refused(spark):
    rows = [(i, [float(i * 9_000 + j) for j in range(DIMS)]) for i in range(60)]
    want, centroids = plain(rows, 5, 3)
    assert found(spark, rows, 5, 3)[:2] == (want, centroids)
    with pytest.raises(Exception, match="beyond"):
        ns_bounds.vectors(frame(spark, [(1, [3e38] * DIMS)]), dims=DIMS).collect()


def test_bounds_hold_round_by_round():
    """Whatever the centroids do, no stored bound is on the wrong side of a true distance."""
    r = np.random.default_rng(9)
    x = r.integers(-300, 300, (200, DIMS))
    history = r.integers(-300, 300, (1, 6, DIMS))
    state = ns_bounds.first_round(x, history[0])
    for _ in range(12):
        history = np.concatenate([history, history[:1] + r.integers(-40, 40, (1, 6, DIMS))])  # swings round where it began
        state = ns_bounds.next_round(x, state, history)
        d2 = ns_bounds.squared(x, history[-1])
        true, drift = np.sqrt(d2.astype(float)), ns_bounds.displacements(history)
        assert (d2.argmin(1) == state["cluster"]).all()
        assert (state["low"] - drift[state["low_round"], np.arange(6)] <= true + 1e-6).all()
        assert (state["own"] + drift[state["own_round"], state["cluster"]] >= true[np.arange(200), state["cluster"]] - 1e-6).all()
    assert state["evaluated"].sum() < 13 * 6 * 200


def test_total_displacement_is_less_than_the_sum_of_moves():
    here, there = np.zeros((1, DIMS), np.int64), np.full((1, DIMS), 10)
    assert ns_bounds.displacements(np.stack([here, there, here]))[0, 0] == 0


def test_query_equals_sql_and_keeps_all_vectors(spark, sf_dir):
    out = ns_bounds.op11(spark, sf_dir)
    assert compare.differences(out, compare.connect(sf_dir), ns_bounds.OP11_SQL) == []
    rows = table(spark, sf_dir, "embeddings")
    assert out.count() == rows.where(F.size("embedding") == 64).count()
