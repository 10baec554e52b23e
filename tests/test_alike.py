"""Rows that are alike are joined once: what joins are given, and results where many rows share a place."""

import time

import pytest
from test_catalogue import SF

from strataspark.operators import assets, boxes, chains, closing, profiles
from strataspark.plans import catalogue


def once(df, *names):
    return df.count() == df.select(*names).distinct().count()


@pytest.fixture()
def twice(spark, tmp_path):
    """The smallest tables, parts and line items twice: the same boxes and points under other keys."""
    import os
    for f in os.listdir(SF):
        df = spark.read.parquet(f"{SF}/{f}")
        if f in ("part.parquet", "lineitem.parquet"):
            key = "p_partkey" if f == "part.parquet" else "l_partkey"
            df = df.union(df.withColumn(key, df[key] + 3600))
        df.write.parquet(f"{tmp_path}/{f}")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["candidate_box_extraction", "column_support", "footprint_margin_join"])
def test_points_and_boxes_come_once(spark, twice, monkeypatch, name):
    join = boxes.points_in_boxes

    def watched(points, held, size):
        assert once(points, "x", "y", "z") and once(held, *boxes.SHAPE)
        return join(points, held, size)

    monkeypatch.setattr(boxes, "points_in_boxes", watched)
    assert catalogue.QUERIES[name](spark, twice).count() > 0


@pytest.mark.parametrize("name, module, function, names", [("nearest_box_join", boxes, "box_pairs", boxes.SHAPE), ("foundation_clearance", assets, "span_pairs", ["kind", "start", "stop"])])
def test_boxes_and_spans_come_once(spark, twice, monkeypatch, name, module, function, names):
    join = getattr(module, function)

    def watched(a, b, *args, **more):
        assert once(a, *names) and once(b, *names)
        return join(a, b, *args, **more)

    monkeypatch.setattr(module, function, watched)
    assert catalogue.QUERIES[name](spark, twice).count() > 0


def test_gaps_and_roofs_come_once(spark, monkeypatch):
    join = assets.span_pairs

    def watched(a, b, *args):
        assert (a.count(), b.count()) == (1, 2)
        return join(a, b, *args)

    monkeypatch.setattr(assets, "span_pairs", watched)
    gaps = spark.createDataFrame([(k, 0.0, 8.0, 1.0, 1.0) for k in (7, 5)], "span_id long, start double, stop double, c double, z double")
    roofs = spark.createDataFrame([(k, 0.0, 8.0, a, 9.0, 1.0) for k, a in ((3, 1.5), (4, 1.0), (2, 1.0))], "span_id long, start double, stop double, c0 double, c1 double, z double")
    assert sorted(map(tuple, assets.linear_matches(gaps, roofs, 8.0, 2.0, 2.0).collect())) == [(5, 2, "P2"), (7, 2, "P2")]


def test_many_rows_at_one_station(spark):
    rows, began = spark.range(60_000).selectExpr("'k' AS key", "id", "1.0D AS at"), time.time()
    got = chains.same_station(rows, rows.withColumn("id", rows["id"] + 7), "key", "at", 2.0)
    assert {r.template for r in got.select("template").distinct().collect()} == {7} and got.count() == 60_000
    assert time.time() - began < 60


def test_many_seeds_at_few_places(spark):
    began = time.time()
    seeds = spark.range(90_000).selectExpr("'k' AS key", "CAST(id % 3 AS DOUBLE) * 12 + 5 AS s")
    (r,) = profiles.column_grid(seeds, "key", "s", 12.0, 10.0, 14.0).collect()
    assert (r.seeds, r.spacing, r.phase % 12, r.worst) == (90_000, pytest.approx(12), pytest.approx(5), pytest.approx(0, abs=1e-9))
    assert time.time() - began < 60


def test_candidates_of_one_place_are_linked_once(spark, monkeypatch):
    join = closing.radius_join

    def watched(a, b, radius):
        assert a.count() == b.count() == 5
        return join(a, b, radius)

    monkeypatch.setattr(closing, "radius_join", watched)
    same = [(k, 0.0, 0.0, 0.0, 2.0, float(k % 3)) for k in (4, 5, 6, 7, 8)]  # 5 and 8 have the best score of their place
    rest = [(1, 1.0, 0.0, 0.0, 2.0, 1.0), (2, 9.0, 0.0, 0.0, 2.0, 0.5), (20, 30.0, 0.0, 1.0, 1.0, 1.0), (21, 30.0, 0.0, 1.0, 1.0, 2.0)]  # the last two have no height, so they do not reach each other
    df = spark.createDataFrame(same + rest, "id long, x double, y double, z0 double, z1 double, score double")
    got = {r.seed_id: r.n for r in closing.merged_candidates(df, 3.0, 0.4, "score").collect()}
    assert got == {5: 6, 2: 1, 20: 1, 21: 1}
