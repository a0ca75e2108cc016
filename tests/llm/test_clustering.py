"""Orchard search and clustering against plain loops over Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from sifter.llm import centroid_clustering as cc


def nearest(x, centroids):
    return min((cc.distance2(x, c), j) for j, c in enumerate(centroids))


def plain(rows, k, dims, rounds, scale, salt):
    kept = [(i, [math.floor(x) if scale is None else int(x * scale // 1) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"{salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    cents = [v for _, v in order[:k]]
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v, cents)[1], []).append(v)
        cents = [[sum(col) // len(own[j]) for col in zip(*own[j])] if j in own else c for j, c in enumerate(cents)]
    return [(i, *nearest(v, cents)[::-1]) for i, v in kept], cents


@pytest.mark.parametrize("spread", [2, 40, 4000])
def test_walk_finds_the_nearest_with_ties(spread):
    rng = random.Random(spread)
    for _ in range(30):
        dims, k = rng.randint(1, 4), rng.randint(1, 9)
        cents = [[rng.randint(-spread, spread) for _ in range(dims)] for _ in range(k)]
        v = np.array([[rng.randint(-spread, spread) for _ in range(dims)] for _ in range(60)], np.int64)
        o = cc.Orchard(cents)
        at, d = o.many(v)
        for i, x in enumerate(v.tolist()):
            assert (d[i], at[i]) == nearest(x, cents)
            assert o.one(x) == (at[i], d[i])


def test_walk_with_centroids_beyond_the_arrays():
    rng = random.Random(1)
    for small in (0, 1, 3):
        cents = [[rng.randint(-9, 9) for _ in range(3)] for _ in range(small)] + [[cc.SMALL + rng.randint(-5, 5), 10**40, -1], [cc.SMALL + 1, 0, 0]]
        rng.shuffle(cents)
        v = np.array([[rng.choice([0, 5, cc.SMALL]) for _ in range(3)] for _ in range(40)], np.int64)
        at, d = cc.Orchard(cents).many(v)
        assert [(int(x), int(j)) for x, j in zip(d, at)] == [nearest(x, cents) for x in v.tolist()]


def test_limbs_are_exact():
    for value in (0, -1, 1 << 60, -(1 << 60), (1 << 60) - 1, 10**45, -(10**45), -(1 << 200) + 3):
        limbs = cc._limbs(value)
        assert sum(x << (60 * i) for i, x in enumerate(limbs)) == value and all(-(1 << 62) < x < 1 << 62 for x in limbs)


def test_odd_vectors(spark):
    rng = random.Random(2)
    vec = lambda: [rng.choice([0.0, 0.25, -0.1, 1.0]) for _ in range(3)]
    rows = [(i, vec()) for i in range(40)] + [(None, vec()), (3, vec()), (3, vec())]
    rows += [(50, None), (51, [1.0]), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 0.0]), (54, [float("inf"), 0.0, 0.0]), (55, [])]
    far = rows + [(60, [1e30, -1e30, 0.5]), (61, [1e30, 1e5, 0.5]), (62, [3e38, 3e38, -3e38])]
    for table in (rows, far):
        df = spark.createDataFrame([(i, v, "z") for i, v in table], "vec_id long, embedding array<float>, cluster string").repartition(3)
        exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in table]
        for k in (1, 4):
            want, cents = plain(exact, k, 3, 3, 1024, "3")
            got = cc.cluster(df, k=k, dims=3, rounds=3)
            assert got.centroids == cents
            key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
            long = lambda x: x if x < 1 << 63 else None
            assert sorted(((r.id, r.cluster, -1 if r.distance is None else r.distance) for r in got.rows.collect()), key=key) == sorted(
                ((i, c, -1 if long(d) is None else d) for i, c, d in want), key=key)
            by = {}
            for _, c, d in want:
                by[c] = by.get(c, 0) + d
            for r in cc.with_inertia(got).collect():
                assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()
                if all(d < 1 << 63 for _, _, d in want):
                    assert (r.cluster_inertia, r.inertia) == (long(by[r.cluster]), long(sum(by.values())))


def test_empty_and_short_tables(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert cc.with_inertia(cc.cluster(df.limit(0), k=8, dims=2, rounds=2)).collect() == []
    r, = cc.with_inertia(cc.cluster(df, k=8, dims=2, rounds=2)).collect()
    assert (r.id, r.cluster, r.distance, r.inertia) == (1, 0, 0, 0)
