from pyspark.sql import functions as F

from strataspark.operators import fits, gates, intervals, registry, spatial
from strataspark.sources.tables import load
from strataspark.streaming import windows


def test_components_are_smallest_reachable(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (10, 9), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in spatial.components(edges).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 7: 7, 8: 8, 9: 8, 10: 8}


def test_robust_line_ignores_outliers(spark):
    rows = [("a", float(x), 2.0 * x + 1) for x in range(20)] + [("a", 3.0, 500.0)]
    r = fits.robust_line(spark.createDataFrame(rows, "k string, x double, y double"), "k", "x", "y", 5).first()
    assert abs(r.slope - 2) < 1e-6 and abs(r.intercept - 1) < 1e-6


def test_gate_blocks_on_missing_values(spark):
    m = spark.createDataFrame([(None,)], "v double")
    assert not gates.run_checks(m, {"v": F.col("v") > 0}).first().passed
    assert m.select(gates.status(F.lit("odd"), ["ok"], ["maybe"]).alias("s")).first().s == "block"


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k string, s double, e double")
    assert intervals.coverage(e, "k", "s", "e").count() == 0
    assert registry.upsert(e, e, "k").count() == 0


def test_set_hash_ignores_order(spark):
    df = spark.range(100).toDF("i")
    assert registry.set_hash(df, ["i"]).first() == registry.set_hash(df.orderBy(F.desc("i")), ["i"]).first()


def test_stream_equals_batch(spark, tmp_path):
    events = load(spark, "/root/testdata/sf0.001", "events")
    events.write.parquet(str(tmp_path / "e"))
    out = windows.run_available(spark, str(tmp_path / "e"), events.schema, lambda d: windows.tumbling(d, "1 hour"), "tumbled")
    key = lambda df: {(r.start_s, r.event_type): r.n for r in df.collect()}
    assert key(out) == key(windows.tumbling(events, "1 hour"))
