"""Sparse grids: cells are key columns, never dense arrays; all aggregates combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cell


def cell_stats(points: DataFrame, size: float, value: str = "z", keys: tuple[str, ...] = ()) -> DataFrame:
    by = [*keys, cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy")]
    return points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("top"), F.min(value).alias("bottom"), F.sum(value).alias("total"))


def cell_percentiles(points: DataFrame, size: float, value: str, least: int) -> DataFrame:
    """Exact percentiles of cells with ``least`` rows or more."""
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    out = points.groupBy(cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy")).agg(F.count(F.lit(1)).alias("n"), p.alias("p"))
    return out.filter(F.col("n") >= least).select("cx", "cy", "n", *[F.col("p")[i].alias(k) for i, k in enumerate(("p10", "p50", "p90"))])


def continuity(points: DataFrame, size: float, key: str) -> DataFrame:
    """Per key: occupied cells along x, the longest run of neighbours and the largest gap."""
    cells = points.select(key, cell(F.col("x"), size).alias("c")).distinct()
    w = Window.partitionBy(key).orderBy("c")
    step = cells.withColumn("step", F.col("c") - F.lag("c").over(w)).withColumn("run", F.sum(F.when(F.col("step") == 1, 0).otherwise(1)).over(w))
    runs = step.groupBy(key, "run").agg(F.count(F.lit(1)).alias("length"), F.max("step").alias("step"))
    return runs.groupBy(key).agg(F.sum("length").alias("occupied"), F.max("length").alias("longest_run"), F.coalesce(F.max("step") - 1, F.lit(0)).alias("largest_gap"))


def voxel_coverage(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """Voxels held by each side and by both."""
    vox = lambda d, side: d.select(*[cell(F.col(c), size).alias("v" + c) for c in "xyz"], F.lit(side).alias("side"))
    held = vox(a, 1).union(vox(b, 2)).groupBy("vx", "vy", "vz").agg(F.bit_or("side").alias("sides"))
    count = lambda c: F.count(F.when(c, 1))
    return held.agg(count(F.col("sides").bitwiseAND(1) == 1).alias("in_a"), count(F.col("sides").bitwiseAND(2) == 2).alias("in_b"), count(F.col("sides") == 3).alias("in_both"))


def histogram(df: DataFrame, value: Column, width: float) -> DataFrame:
    return df.groupBy(cell(value, width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def local_peaks(bins: DataFrame, least: int) -> DataFrame:
    """Bins above both neighbours, placed between bins by a parabola through the three."""
    near = bins.select((F.col("bin") - 1).alias("bin"), F.col("n").alias("right"))
    far = bins.select((F.col("bin") + 1).alias("bin"), F.col("n").alias("left"))
    j = bins.join(near, "bin", "left").join(far, "bin", "left").fillna(0, ["left", "right"])
    bend = F.col("left") - 2 * F.col("n") + F.col("right")
    return (j.filter((F.col("n") >= least) & (F.col("n") > F.col("left")) & (F.col("n") >= F.col("right")))
            .select("bin", "n", (F.col("bin") + 0.5 * (F.col("left") - F.col("right")) / bend).alias("position")))


def voxel_holdout(points: DataFrame, size: float, part: float) -> DataFrame:
    """``points`` with a boolean column holdout: whole voxels go to the held-out side, by a hash of the voxel. No shuffle; the same
    voxel goes to the same side in every run and file."""
    name = F.concat_ws(",", *[cell(F.col(c), size) for c in "xyz"])
    bucket = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long") % 1_000_000
    return points.withColumn("holdout", bucket < round(part * 1_000_000))


def symmetric_cells(points: DataFrame, across: float, along: float) -> DataFrame:
    """``points`` with (col, row) of a grid that lies symmetrically to the origin, x across and y along: turning an axis round mirrors the
    grid. Two empty columns stand at each side; what rounding puts outside goes to the edge."""
    far = points.agg(F.max(F.abs("x")).alias("x"), F.max(F.abs("y")).alias("y")).first()
    out = points
    for name, axis, size, pad in (("col", "x", across, 2), ("row", "y", along, 0)):
        half = F.lit(-(-(far[axis] or 0.0) // size) + pad)
        out = out.withColumn(name, F.greatest(F.lit(0), F.least(2 * half, F.floor((F.col(axis) + (half + 0.5) * size) / size + 1e-9))).cast("long"))
    return out
