"""Centroid clustering against plain rounds, and its curve and bounds on their own."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from parley.llm import centroid_clustering as cc

DIMS = 4
# Columns that the operator uses inside, under names of its own.
EXTRA = "q string, key string, row string, ids string, cluster string, x string, draw string"


def plain(rows, clusters=3, rounds=10, scale=1024):
    """[(vec_id, cluster, distance)] of (vec_id, vector), and the centroids, with Python numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == DIMS and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", q) for i, q in kept))
    centroids = [q for _, _, q in drawn[:clusters]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        held = [[] for _ in centroids]
        for _, q in kept:
            held[near(q)[1]].append(q)
        centroids = [[sum(x) // len(own) for x in zip(*own, strict=True)] if own else c for own, c in zip(held, centroids, strict=True)]
    return [(i, near(q)[1], near(q)[0]) for i, q in kept], centroids


def awkward():
    """Vectors in three heaps, one of them equal for a third of all, ties, repeated and null ids, and some that do not count."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(m, 0.05) for _ in range(DIMS)]) for i, m in enumerate([0.2, -0.7, 1.5] * 60)]
    rows += [(1000 + i, [0.25, -0.25, 0.0, 0.5]) for i in range(100)]
    rows += [(2000, [0.0] * DIMS), (2000, [0.0] * DIMS), (2000, [0.5] * DIMS), (None, [0.1] * DIMS), (None, [-0.1] * DIMS)]
    rows += [(3000, None), (3001, []), (3002, [1.0] * 3), (3003, [1.0, None, 0.0, 0.0]), (3004, [1.0, math.nan, 0.0, 0.0]), (3005, [math.inf, 0.0, 0.0, 0.0]), (3006, [1.0] * 5)]
    return rows


def got(spark, rows, **options):
    docs = spark.createDataFrame([(*r, *"abcdefg") for r in rows], f"vec_id long, embedding array<double>, {EXTRA}").repartition(3)
    centroids, assigned = cc.centroid_clustering(docs, dims=DIMS, **options)
    return centroids.tolist(), sorted((tuple(r) for r in assigned.collect()), key=str), cc.with_inertia(centroids, assigned)


@pytest.mark.parametrize("block", [1, 7, 256])
def test_as_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(cc, "BLOCK_ROWS", block)
    rows = awkward()
    want, centroids = plain(rows)
    found, assigned, full = got(spark, rows, clusters=3)
    assert found == centroids
    assert assigned == sorted(want, key=str)
    total = sum(d for _, _, d in want)
    for r in full.collect():
        assert r["inertia"] == total and r["cluster_inertia"] == sum(d for _, k, d in want if k == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_empty_few_and_too_large(spark):
    assert got(spark, [])[1] == [] and got(spark, [])[2].count() == 0
    assert got(spark, [(1, None), (2, [1.0])])[1] == []
    rows = [(1, [0.1] * DIMS), (2, [0.2] * DIMS)]
    assert got(spark, rows)[1] == sorted(plain(rows, clusters=8)[0], key=str)
    with pytest.raises(ValueError, match="leave such vectors out"):
        got(spark, [(1, [1e9] * DIMS), (2, [0.0] * DIMS)])


def test_ids_of_another_type(spark):
    rows = [(str(i), v) for i, v in awkward() if i is not None]
    docs = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    assert cc.centroid_clustering(docs, dims=DIMS, clusters=3)[1].schema["vec_id"].dataType.simpleString() == "string"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 2), (4, 2)])
def test_neighbours_along_the_curve_are_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = cc.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_boxes_lose_no_centroid_and_open_few():
    rng = np.random.default_rng(1)
    few = 0
    for _ in range(300):
        centroids = rng.integers(-20, 20, (8, 5))
        q = rng.integers(-20, 20, 5) + rng.integers(-2, 3, (30, 5))
        may = np.flatnonzero(cc.candidates(q.min(0)[None], q.max(0)[None], centroids)[0])
        which, distance = cc.nearest(q, centroids)
        within, same = cc.nearest(q, centroids[may])
        assert (may[within] == which).all() and (same == distance).all()
        few += len(may) <= 2
    assert few > 200


def test_heaps_go_as_whole_blocks(spark):
    """On heaps far apart, most blocks have one candidate and their vectors are not looked at."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(0, 0.01, DIMS) + [[3, 0, 0, 0], [0, 3, 0, 0], [0, 0, 3, 0]][i % 3]).tolist()) for i in range(3000)]
    whole = cc.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding", DIMS, 1024)
    low, high, variance = cc.spread(whole, DIMS)
    cut = cc.blocks(whole, low, high, variance, DIMS).collect()
    may = cc.candidates(np.array([r["low"] for r in cut]), np.array([r["high"] for r in cut]), np.eye(3, DIMS, dtype=np.int64) * 3072)
    assert sum(len(r["ids"]) for r in cut) == 3000
    assert (may.sum(1) == 1).mean() > 0.6
