"""Joins of boxes, spans and points on shared cells: every join is an equi-join on a cell, in which a pair is met once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cell


def _cells(df: DataFrame, size: float, spans: list[tuple[Column, Column]]) -> DataFrame:
    """Each row once for every cell that its spans touch; as many as its extent over ``size``."""
    for i, (low, high) in enumerate(spans):
        df = df.withColumn(f"__c{i}", F.explode(F.sequence(cell(low, size), cell(high, size))))
    return df


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float) -> DataFrame:
    """Points (x, y, z, ...) with the boxes (box_id, x0, x1, y0, y1, z0, z1, closed) that hold them. A point has one cell,
    so a pair comes once; choose ``size`` about as wide as a box."""
    spread = _cells(boxes, size, [(F.col("x0"), F.col("x1")), (F.col("y0"), F.col("y1"))])
    placed = points.withColumn("__c0", cell(F.col("x"), size)).withColumn("__c1", cell(F.col("y"), size))
    held = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")) & F.col("z").between(F.col("z0"), F.col("z1"))
    return placed.join(spread, ["__c0", "__c1"]).filter(held).drop("__c0", "__c1")


SHAPE = ["x0", "x1", "y0", "y1", "z0", "z1"]


def alike(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Rows that are equal in ``values`` once, under the smallest ``key`` among them: they meet the same others, so a join need see them only once, and what it finds goes back by an equi-join on the values."""
    return df.groupBy(*values).agg(F.min(key).alias(key))


def _renamed(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.select(*[F.col(n).alias(prefix + n) for n in names])


def box_pairs(a: DataFrame, b: DataFrame, size: float, reach: float = 0.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of boxes (box_id, x0, x1, y0, y1, z0, z1) that are at most ``reach`` apart in x and y: columns a_*, b_* and ``gap``, the distance of the
    boxes in three dimensions (0 where they meet). A pair is met in the cell of the larger of its two lower corners only."""
    names = [*keys, "box_id", "x0", "x1", "y0", "y1", "z0", "z1"]
    left = _cells(_renamed(a, "a_", names), size, [(F.col("a_x0") - reach, F.col("a_x1") + reach), (F.col("a_y0") - reach, F.col("a_y1") + reach)])
    right = _cells(_renamed(b, "b_", names), size, [(F.col("b_x0"), F.col("b_x1")), (F.col("b_y0"), F.col("b_y1"))])
    c = F.col
    on = [c(f"a_{k}") == c(f"b_{k}") for k in keys]
    j = left.withColumnsRenamed({"__c0": "__l0", "__c1": "__l1"}).join(right, [c("__l0") == c("__c0"), c("__l1") == c("__c1"), *on])
    j = j.filter((c("a_x0") - reach <= c("b_x1")) & (c("b_x0") <= c("a_x1") + reach) & (c("a_y0") - reach <= c("b_y1")) & (c("b_y0") <= c("a_y1") + reach))
    j = j.filter((c("__c0") == cell(F.greatest(c("a_x0") - reach, c("b_x0")), size)) & (c("__c1") == cell(F.greatest(c("a_y0") - reach, c("b_y0")), size)))
    apart = [F.greatest(F.lit(0.0), c(f"a_{n}0") - c(f"b_{n}1"), c(f"b_{n}0") - c(f"a_{n}1")) for n in "xyz"]
    return j.drop("__l0", "__l1", "__c0", "__c1").withColumn("gap", F.sqrt(sum((g * g for g in apart), F.lit(0.0))))


def span_pairs(a: DataFrame, b: DataFrame, size: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of closed spans (keys, span_id, start, stop) that meet: columns a_*, b_* and ``overlap``; met in the cell of the later start only."""
    names = [*keys, "span_id", "start", "stop"]
    left = _cells(_renamed(a, "a_", names), size, [(F.col("a_start"), F.col("a_stop"))]).withColumnRenamed("__c0", "__l0")
    right = _cells(_renamed(b, "b_", names), size, [(F.col("b_start"), F.col("b_stop"))])
    c = F.col
    j = left.join(right, [c("__l0") == c("__c0"), *[c(f"a_{k}") == c(f"b_{k}") for k in keys]])
    j = j.filter((c("a_start") <= c("b_stop")) & (c("b_start") <= c("a_stop")) & (c("__c0") == cell(F.greatest("a_start", "b_start"), size)))
    return j.drop("__l0", "__c0").withColumn("overlap", F.least("a_stop", "b_stop") - F.greatest("a_start", "b_start"))


def best(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__rn = 1").drop("__rn")
