"""Recoveries chosen at once against choosing one after the other with a whole audit each time."""

import random

from pyspark.sql import functions as F
from strataspark.operators.recovery import Check, select_recoveries

CHECKS = [
    Check("low", own=lambda v: v["a"] < 3),
    Check("step", seam=lambda x, y: F.abs(x["a"] - y["a"]) > 3),
    Check("drop", seam=lambda x, y: y["b"] - x["b"] < -4, protected=True),
]


def audit(line):
    """Failures of the whole line, all checks counted again."""
    near = list(zip(line, line[1:]))
    return {"low": sum(a < 3 for a, _ in line), "step": sum(abs(x[0] - y[0]) > 3 for x, y in near), "drop": sum(y[1] - x[1] < -4 for x, y in near)}


def by_hand(rows):
    """(place: (accepted, deltas)) by trying one recovery after the other."""
    rows = sorted(rows)
    line, out = [base for _, base, _ in rows], {}
    for i, (place, _, trial) in enumerate(rows):
        if trial is not None:
            tried = [*line[:i], trial, *line[i + 1:]]
            before, after = audit(line), audit(tried)
            delta = {k: after[k] - before[k] for k in before}
            taken = max(delta.values()) <= 0 and min(delta["low"], delta["step"]) < 0
            out[place] = (taken, delta)
            line = tried if taken else line
    return out, line


def test_same_as_one_after_the_other(spark):
    r, rows = random.Random(6), []
    two = lambda: (r.randint(0, 8), r.randint(0, 8))
    for key in range(40):
        rows += [(key, i, two(), two() if r.random() < 0.8 else None) for i in range(r.randint(1, 25))]
    shuffled = [*rows, (None, 0, (1, 1), (5, 5))]
    r.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k long, place long, base struct<a: long, b: long>, trial struct<a: long, b: long>")
    got = {}
    for q in select_recoveries(df, "k", ["place"], CHECKS).collect():
        got.setdefault(q.k, {})[q.place] = (q.accepted, {k.name: q[f"delta_{k.name}"] for k in CHECKS})
        assert (q.reasons == []) == q.accepted
        assert q.accepted or q.reasons == (sorted(k.name for k in CHECKS if q[f"delta_{k.name}"] > 0) or ["none_improved"])
    taken = after_taken = 0
    for key in range(40):
        mine = [(i, b, t) for k, i, b, t in rows if k == key]
        want, line = by_hand(mine)
        assert got.get(key, {}) == want
        first = audit([b for _, b, _ in sorted(mine)])
        assert all(audit(line)[k] <= first[k] for k in first)
        places = sorted(want)
        taken += sum(want[p][0] for p in places)
        after_taken += sum(want[p][0] for p in places if p - 1 in want and want[p - 1][0])
    assert taken > 50 and after_taken > 10 and None not in got


def test_no_rows_and_values_that_are_null(spark):
    df = spark.createDataFrame([(1, 1, (None, None), (5, None)), (1, 2, (1, 1), (5, 1))], "k long, place long, base struct<a: long, b: long>, trial struct<a: long, b: long>")
    rows = {q.place: q for q in select_recoveries(df, "k", ["place"], CHECKS).collect()}
    assert rows[1].reasons == ["step"] and rows[2].accepted  # an undefined check does not fail; base 1 beside trial 5 is a step
    assert select_recoveries(df.filter("k > 1"), "k", ["place"], CHECKS).count() == 0
