"""Line traces against counting votes by hand, and sag fits of spans that are known."""

import hashlib
import math
import random

import numpy as np
from strataspark.operators import robust


def made(seed=1):
    r, rows = random.Random(seed), []
    for key, lines in ((1, ((0.5, 1.0, 60), (-0.3, 6.0, 40))), (2, ((0.0, 3.0, 50),)), (3, ())):
        for slope, intercept, n in lines:
            for _ in range(n):
                u = r.uniform(0, 5)
                rows.append((key, u, slope * u + intercept + r.uniform(-0.02, 0.02)))
        rows += [(key, r.uniform(0, 5), r.uniform(0, 9)) for _ in range(12)]
    return rows + [(1, None, 2.0), (2, 1.0, None)]


def by_hand(rows, key, seed, t):
    """The best score of one key's first round, all votes counted one by one."""
    cells = {}
    for k, u, z in rows:
        if k == key and u is not None and z is not None:
            at = (math.floor(u / t.cell + 0.5), math.floor(z / t.cell + 0.5))
            cells[at] = min(cells.get(at, (u, z)), (u, z))
    buckets = {}
    for (cu, cz), p in cells.items():
        mark = hashlib.md5(f"{seed}|{key}|{cu}|{cz}".encode()).hexdigest()
        buckets.setdefault(int(mark[:6], 16) % t.hypotheses, []).append((mark, p))
    best = None
    for h, members in buckets.items():
        (ua, za), (ub, zb) = min(members)[1], max(members)[1]
        if abs(ub - ua) < t.least_apart or abs((zb - za) / (ub - ua)) > t.steepest:
            continue
        slope = (zb - za) / (ub - ua)
        inside = sorted(u for u, z in cells.values() if abs(z - slope * u - (za - slope * ua)) <= t.tolerance)
        if len(inside) < t.least_points:
            continue
        lo, hi = np.percentile(inside, [5, 95])
        if hi - lo < t.least_span:
            continue
        cover = len({math.floor(u / t.bin) for u in inside}) / max(1, math.ceil((hi - lo) / t.bin) + 1)
        score = (-round((hi - lo) * cover * math.sqrt(len(inside)), 9), h)
        best = min(best or (score, 0), (score, len(inside)))
    return best and best[1]


def test_best_consensus_and_order_of_lines(spark):
    rows, limits = made(), robust.TraceLimits(traces=4)
    one = spark.createDataFrame(rows, "key long, u double, z double")
    got = robust.line_traces(one.repartition(7), "key", limits).collect()
    again = robust.line_traces(one.repartition(1).orderBy("z"), "key", limits).collect()
    show = lambda rs: sorted((r.key, r.trace, r.n, round(r.slope, 9), round(r.rmse, 9)) for r in rs)
    assert show(got) == show(again)  # however the points are dealt
    first = {r.key: r for r in got if r.trace == 1}
    for key in (1, 2):
        assert first[key].n == by_hand(rows, key, 1, limits)
    assert abs(first[1].slope - 0.5) < 0.02 and abs(first[2].intercept - 3) < 0.05
    second = next(r for r in got if r.key == 1 and r.trace == 2)
    assert abs(second.slope + 0.3) < 0.02 and second.n >= 20
    assert not [r for r in got if r.key == 3 and r.n > 20]


def test_no_points_no_traces(spark):
    none = spark.createDataFrame([], "key string, u double, z double")
    out = robust.line_traces(none, "key")
    assert out.count() == 0 and out.columns[:3] == ["key", "trace", "n"]


def test_sag_of_known_spans(spark):
    r, rows = random.Random(2), []
    for key, sag, noise in ((1, 0.8, 0.01), (2, 0.0, 0.01), (3, 0.8, 0.6)):
        for i in range(2000):
            s = i / 40
            u = (s - 25) / 25
            z = 6 + sag * (u * u - 1) + r.uniform(-noise, noise)
            if key == 1 and i % 400 < 30:
                z += 3  # a few bins are off
            rows.append((key, s, 0.01 * s + r.uniform(-noise, noise), z, 0.0, 50.0))
    rows += [(4, 10.0, 0.0, 1.0, 0.0, 50.0)] * 5  # a single bin
    got = {x.key: x for x in robust.sag_fits(spark.createDataFrame(rows, "key long, s double, c double, z double, start double, stop double"), "key").collect()}
    assert got[1].passed and abs(got[1].sag - 0.8) < 0.02 and abs(got[1].slope - 0.01) < 1e-3 and got[1].kept < got[1].bins
    assert not got[2].passed and abs(got[2].sag) < 0.02  # straight
    assert not got[3].passed
    assert (got[4].bins, got[4].kept, got[4].slope, got[4].passed) == (1, 0, None, False)
