"""Neighbours and components on cell keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut, discard

FOREST_NODES, ONE_TASK_LINKS = 2_000_000, 1_000_000


def nearest_1d(left: DataFrame, right: DataFrame, left_value: str, right_value: str, right_id: str) -> DataFrame:
    """Each left row with the nearest right value (ties to the smaller value, then id). Both sides are dealt by ranges of the value and a hash, so
    that a common value is spread; windows run within ranges, and the last right value before a range and the first after it, one row a range, are handed on."""
    cols = left.columns
    both = (left.withColumn("__v", F.col(left_value).cast("double")).withColumn("__side", F.lit(1)).withColumn("__h", F.xxhash64(*cols))
            .unionByName(right.groupBy(F.col(right_value).cast("double").alias("__v")).agg(F.min(right_id).alias("__id")).filter("__v is not null")
                         .withColumn("__side", F.lit(0)).withColumn("__h", F.lit(0).cast("long")), allowMissingColumns=True))
    both = cut(both.repartitionByRange("__v", "__side", "__h").withColumn("__part", F.spark_partition_id()))
    item = F.when(F.col("__side") == 0, F.struct(F.col("__v").alias("v"), F.col("__id").alias("id")))
    spots = both.groupBy("__part").agg(F.min(item).alias("first"), F.max(item).alias("last"))
    w = Window.orderBy("__part")  # one row for each range
    spots = spots.select("__part", F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__below"), F.first("first", True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("__above"))
    w = Window.partitionBy("__part").orderBy("__v", "__side")
    back = Window.partitionBy("__part").orderBy(F.col("__v").desc(), "__side")  # a frame that only grows: one pass, where one that shrinks is quadratic
    near = (both.withColumn("__down", F.last(item, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("__up", F.last(item, True).over(back.rowsBetween(Window.unboundedPreceding, 0))).filter("__side = 1").join(F.broadcast(spots), "__part"))
    near = near.withColumn("__d", F.coalesce("__down", "__below")).withColumn("__u", F.coalesce("__up", "__above"))
    take = F.col("__d.v").isNotNull() & (F.col("__u.v").isNull() | (F.col("__v") - F.col("__d.v") <= F.col("__u.v") - F.col("__v")))
    pick = F.when(take, F.col("__d")).otherwise(F.col("__u"))
    return near.select(*cols, pick["id"].alias("nearest_id"), F.abs(F.col("__v") - pick["v"]).alias("distance"))


def local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links (a, b) that one task holds by links to the smallest node of each local component."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def links() -> pd.DataFrame:
        return pd.DataFrame([(k, find(k)) for k in up], columns=["a", "b"], dtype=np.int64)

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            x, y = find(up.setdefault(a, a)), find(up.setdefault(b, b))
            if x != y:
                up[max(x, y)] = min(x, y)
        if len(up) > FOREST_NODES:  # bounded memory: hand over what is known and start again
            yield links()
            up.clear()
    if up:
        yield links()


def components(edges: DataFrame, contracted: bool = False) -> DataFrame:
    """(id, component) of (a, b) links between long ids, the smallest id reachable; null ends are ignored, a node may link itself.

    Each task first contracts the links it holds, twice: as they lie, and dealt by their larger end, of which each task has one
    row at most, so that a star with millions of leaves is spread. Up to ONE_TASK_LINKS of what is left, counted, are joined in one task of bounded
    memory; beyond that labels spread: each round a node takes the smallest of its own label, its neighbours' and the label of
    its label (pointer jumping), aggregated before they are shuffled. ``contracted``: links come from a Python function that has
    passed them through ``local_forest``; one more here would give each of its tasks a second Python worker.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    if not contracted:
        e = e.mapInPandas(local_forest, "a long, b long")
    e = cut(e.repartition("a").mapInPandas(local_forest, "a long, b long").distinct())
    if e.count() <= ONE_TASK_LINKS:
        return cut(e.coalesce(1).mapInPandas(local_forest, "a long, b long").select(F.col("a").alias("id"), F.col("b").alias("component")))
    both = cut(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")))
    before = labels
    while True:
        known = labels.select(F.col("id").alias("k"), F.col("label").alias("up"))
        own = labels.select("id", "label", F.lit(True).alias("own"))
        near = both.join(known, both.b == known.k).select(F.col("a").alias("id"), F.col("up").alias("label"), F.lit(False).alias("own"))
        jump = labels.join(known, labels.label == known.k).select("id", F.col("up").alias("label"), F.lit(False).alias("own"))
        step = cut(own.union(near).union(jump).groupBy("id").agg(F.min("label").alias("label"), F.max(F.when(F.col("own"), F.col("label"))).alias("was")))
        discard(before)
        before, labels = step, step.select("id", "label")
        if not step.filter("label <> was").limit(1).count():
            return labels.select("id", F.col("label").alias("component"))


def cell_links(cells: DataFrame) -> DataFrame:
    """Links of occupied cells (cx, cy, id) to their right, upper and diagonal neighbours."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i, j in ((0, 0), (1, 0), (0, 1), (1, 1), (1, -1))])).alias("s")
    ahead = cells.select(F.col("id").alias("a"), "cx", "cy", steps).select("a", (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"))
    return ahead.join(cells.select(F.col("id").alias("b"), "cx", "cy"), ["cx", "cy"]).select("a", "b")
