"""The best ways against listing all of them."""

import itertools
import random

import numpy as np
from strataspark.operators import paths


def by_hand(stages, limits):
    """The cheapest ways through lists of (id, position, cost): (total, ids, seams)."""
    ways = []
    for way in itertools.product(*stages):
        total, seams = way[0][2], [False]
        for a, b in zip(way, way[1:]):
            apart = abs(a[1] - b[1])
            total = total + (limits.weight * apart if apart <= limits.reach else limits.seam) + b[2]
            seams.append(apart > limits.reach)
        ways.append((round(total, 9), [w[0] for w in way], seams))
    return sorted(ways)[: limits.paths]


def test_best_ways_equal_enumeration(spark):
    r, rows, stages = random.Random(4), [], {}
    for key in range(12):
        for stage in range(r.randint(1, 5)):
            stages.setdefault(key, []).append([(key * 1000 + stage * 10 + i, r.uniform(0, 40), r.uniform(0, 5)) for i in range(r.randint(1, 5))])
            rows += [(key, stage, *x) for x in stages[key][-1]]
    rows += [(0, 9, 5, 1.0, None), (None, 0, 1, 1.0, 1.0), (99, 0, 7, None, 1.0), (5, 50, 7777, 3.0, 1.0)]
    r.shuffle(rows)
    limits = paths.PathLimits(paths=4)
    df = spark.createDataFrame(rows, "k long, stage long, id long, at double, cost double")
    got = {}
    for q in sorted(paths.k_best_sequences(df, "k", "stage", "at", "cost", limits).collect(), key=lambda q: q.stage):
        total, ids, seams = got.setdefault((q.k, q.run), {}).setdefault(q.path, (round(q.total, 9), [], []))
        ids.append(q.id)
        seams.append(q.seam)
    assert set(got) == {(k, 0) for k in stages} | {(5, 1)}  # a far stage begins a run, null rows take no part
    for key, s in stages.items():
        assert [tuple(got[key, 0][p]) for p in sorted(got[key, 0])] == by_hand(s, limits)


def test_ties_go_to_the_smaller_id_and_repeats_of_cost(spark):
    df = spark.createDataFrame([(1, s, 10 * s + i, 0.0, 1.0) for s in range(3) for i in range(2)], "k long, stage long, id long, at double, cost double")
    rows = paths.k_best_sequences(df, "k", "stage", "at", "cost", paths.PathLimits(paths=2)).collect()
    best = [q.id for q in sorted(rows, key=lambda q: q.stage) if q.path == 1]
    assert best == [0, 10, 20] and len(rows) == 6 and not any(q.seam for q in rows)
    assert paths.k_best_sequences(df.filter("k > 1"), "k", "stage", "at", "cost").count() == 0


def test_blocks_do_not_change_survivors(monkeypatch):
    r, limits = np.random.default_rng(1), paths.PathLimits()
    total, at, now = r.integers(0, 9, 40).astype(float), r.integers(0, 50, 40).astype(float), r.integers(0, 50, 17).astype(float)
    whole = paths.survivors(total, at, now, limits)
    monkeypatch.setattr(paths, "BLOCK", 100)
    parts = paths.survivors(total, at, now, limits)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
