"""Clusters against counting all pairs, planes against a singular value decomposition."""

import itertools
import math
import random

import numpy as np
from strataspark.operators import density, graphs


def by_hand(points, radius, least):
    """(id: (cluster, core)) by all pairs and a flood from each core."""
    at = {i: p for i, *p in points}
    near = {i: [j for j in at if math.dist(at[i], at[j]) <= radius] for i in at}
    core = {i for i in at if len(near[i]) >= least}
    name = {}
    for i in sorted(core):
        todo = [] if i in name else [i]
        while todo:
            j = todo.pop()
            if j not in name:
                name[j] = i
                todo += [n for n in near[j] if n in core]
    return {i: (name[i], True) if i in core else (min((name[j] for j in near[i] if j in core), default=None), False) for i in at}


def scattered(n, seed, spots):
    r = random.Random(seed)
    rows = [(i, *(x + r.gauss(0, s) for x in spot)) for i, (spot, s) in enumerate(r.choice(spots) for _ in range(n))]
    r.shuffle(rows)
    return rows


def clusters(spark, rows, radius, least, **more):
    df = spark.createDataFrame(rows, "id long, x double, y double, z double")
    return {r.id: (r.cluster, r.core) for r in density.density_clusters(df, radius, least, **more).collect()}


def test_clusters_equal_all_pairs(spark):
    spots = [((0, 0, 0), 0.05), ((0.3, 0, 0), 0.02), ((1, 1, 1), 0.4), ((-2, 0, 5), 1.5), ((0.3, 0.21, 0), 0.01)]
    rows = scattered(420, 5, spots) + [(1000 + i, 0.1 * i, 3.0, 0.0) for i in range(12)] + [(2000 + i, 7.0, 7.0, 7.0) for i in range(9)]
    for radius, least in ((0.1, 5), (0.25, 8)):
        assert clusters(spark, rows, radius, least) == by_hand(rows, radius, least)


def test_dense_cells_on_either_side_of_a_gap(spark):
    r = random.Random(2)
    sheet = lambda x, first: [(first + i, x, r.random() * 0.4, r.random() * 0.4) for i in range(150)]
    for gap in (0.0999, 0.1001):
        rows = sheet(0.0, 0) + sheet(gap, 500) + [(900, 0.0, 0.2, 0.2), (901, gap, 0.2, 0.2)]
        assert clusters(spark, rows, 0.1, 5) == by_hand(rows, 0.1, 5)


def test_clusters_of_odd_points(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0.0, 0.0), (2, nan, 0.0, 0.0), (3, inf, 0.0, 0.0), (4, 0.0, 0.0, 0.0), (5, 0.0, 0.0, 0.0)]
    assert clusters(spark, rows, 0.5, 2) == {1: (None, False), 2: (None, False), 3: (None, False), 4: (4, True), 5: (4, True)}
    assert clusters(spark, [], 0.5, 2) == {}
    two = spark.createDataFrame([("a", 1, 0.0), ("b", 2, 0.0), ("a", 3, 0.1)], "k string, id long, x double").selectExpr("*", "0D AS y", "0D AS z")
    assert {(r.id, r.cluster) for r in density.density_clusters(two, 0.5, 2, "k").collect()} == {(1, 1), (3, 1), (2, None)}


def test_planes(spark):
    r = np.random.default_rng(3)
    floor = np.c_[r.uniform(0, 9, (300, 2)), r.normal(2, 0.004, 300)]
    wall = np.c_[r.normal(4, 0.004, 120), r.uniform(0, 9, 120), r.uniform(3, 9, 120)]
    rest = r.uniform(10, 19, (40, 3))
    rows = [("k", i, *map(float, p)) for i, p in enumerate(itertools.chain(floor, wall, rest))] + [("k", 9000, None, 1.0, 1.0), ("few", 9001, 0.0, 0.0, 0.0), (None, 9002, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "key string, id long, x double, y double, z double")
    limits = density.PlaneLimits(planes=3, least_points=60)
    found, left = density.plane_segments(df, "key", limits)
    again, _ = density.plane_segments(df.repartition(7).orderBy("z"), "key", limits)
    got = sorted(found.collect(), key=lambda p: p.plane)
    assert [(p.key, p.plane, p.n, p.nx) for p in got] == sorted((p.key, p.plane, p.n, p.nx) for p in again.collect())
    assert len(got) == 2 and got[0].n > 250 and got[1].n > 90  # the third has too few points
    for p, true in zip(got, ((0, 0, 1), (1, 0, 0))):
        mine = np.array([q for q in (floor, wall)[p.plane - 1]])
        mine = np.vstack([q for q in np.vstack([floor, wall, rest]) if abs(q @ [p.nx, p.ny, p.nz] - p.offset) <= 0.035]) if p.plane == 1 else mine
        assert abs(np.dot([p.fx, p.fy, p.fz], true)) > 0.999
        if p.plane == 1:
            u, s, v = np.linalg.svd(mine - mine.mean(0))
            assert len(mine) == p.n and abs(s[2] / math.sqrt(len(mine)) - p.rms) < 1e-6
    ids = {q.id for q in left.collect()}
    assert 9001 in ids and 9000 not in ids and 9002 not in ids and len(ids) == 461 - got[0].n - got[1].n
    none, kept = density.plane_segments(df.filter("id < 0"), "key", limits)
    assert none.count() == kept.count() == 0


def test_running_median():
    r, held, m = random.Random(8), [], graphs.RunningMedian()
    for _ in range(500):
        held.append(r.choice([r.uniform(-5, 5), float(r.randint(-2, 2))]))
        m.push(held[-1])
        assert abs(m.value() - float(np.median(held))) < 1e-12


def test_lanes_by_medians(spark):
    r = random.Random(9)
    rows = [(k, i, i, r.choice([0.0, 10.0, 25.0]) + r.uniform(-2, 2)) for k in range(4) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, step long, id long, at double")
    got = {(q.k, q.id): q.lane for q in graphs.lanes(df, "k", "step", "at", 4.0).collect()}
    for k in range(4):
        held = []
        for _, i, _, v in (q for q in rows if q[0] == k):
            apart = [abs(float(np.median(x)) - v) for x in held]
            best = int(np.argmin(apart)) if apart else -1
            if best < 0 or apart[best] > 4.0:
                held.append([])
                best = len(held) - 1
            held[best].append(v)
            assert got[k, i] == best
