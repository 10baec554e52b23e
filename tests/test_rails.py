"""Paired lines on a made corridor."""

import random

from strataspark.operators import rails


def test_one_pair_at_its_spacing(spark):
    rng = random.Random(7)
    rows = [("s", i * 0.25, y, 0.30) for i in range(241) for y in (-0.7175, 0.7175)]
    rows += [("s", rng.uniform(0, 60), rng.uniform(-4, 4), rng.gauss(0, 0.01)) for _ in range(1500)]
    rows += [("empty", rng.uniform(0, 60), rng.uniform(-4, 4), rng.gauss(0, 0.01)) for _ in range(300)] + [("s", None, 0.0, 0.3)]
    got = rails.detect_pairs(spark.createDataFrame(rows, "segment_id string, x double, y double, z double")).collect()
    assert [r.segment_id for r in got] == ["s"] and abs(got[0].spacing - 1.435) < 0.02 and got[0].joint > 0.95 and got[0].gap == 0


def test_no_points_no_pairs(spark):
    assert rails.detect_pairs(spark.createDataFrame([], "segment_id string, x double, y double, z double")).count() == 0
