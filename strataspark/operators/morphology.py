"""Morphology of sparse masks: cells (keys, cx, cy) are rows, neighbours are key arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def _spread(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Each cell nine times: as itself and as each of its neighbours."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in AROUND])).alias("s")
    moved = cells.select(*keys, "cx", "cy", steps)
    return moved.select(*keys, (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))


def dilate(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The mask grown by one cell on every side."""
    return _spread(cells.select(*keys, "cx", "cy"), list(keys)).distinct()


def erode(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cells whose neighbours all belong to the mask. Input rows are distinct."""
    votes = _spread(cells.select(*keys, "cx", "cy"), list(keys)).groupBy(*keys, "cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    return votes.filter(F.col("n") == len(AROUND)).drop("n")


def closing(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cx, cy, filled): the mask grown and shrunk by one cell; filled marks cells that it did not hold."""
    held = cells.select(*keys, "cx", "cy").distinct()
    done = erode(dilate(held, keys), keys)
    return done.join(held.withColumn("__held", F.lit(True)), [*keys, "cx", "cy"], "left").select(*keys, "cx", "cy", F.col("__held").isNull().alias("filled"))


def gap_rims(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cx, cy, rim): the cells a closing fills, with the share of their eight neighbours that the mask holds."""
    held = cells.select(*keys, "cx", "cy").distinct()
    gaps = closing(held, keys).filter("filled").drop("filled")
    votes = _spread(held, list(keys)).groupBy(*keys, "cx", "cy").agg((F.count(F.lit(1)) / 8).alias("rim"))
    return gaps.join(votes, [*keys, "cx", "cy"], "left").fillna(0.0, ["rim"])


def level_links(cells: DataFrame, height: str, most: float) -> DataFrame:
    """Links (a, b) of cells (id, cx, cy, height) to themselves and to touching cells whose heights differ by at most ``most``."""
    ahead = [(0, 0), (1, 0), (0, 1), (1, 1), (1, -1)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ahead])).alias("s")
    a = cells.select(F.col("id").alias("a"), F.col(height).alias("ha"), "cx", "cy", steps).select(
        "a", "ha", (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    near: Column = F.abs(F.col("ha") - F.col("hb")) <= most
    return a.join(cells.select(F.col("id").alias("b"), F.col(height).alias("hb"), "cx", "cy"), ["cx", "cy"]).filter(near).select("a", "b")
