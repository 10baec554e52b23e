"""Paired line detection: height filter, occupancy profile across, peaks, pairs by spacing, joint support, exclusive choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cell
from .neighbours import greedy_pairs


def above_ground(points: DataFrame, key: str, step: float, low: float, high: float) -> DataFrame:
    """Points between ``low`` and ``high`` over their stretch's ground, the 0.2 quantile of z in each ``step`` along x."""
    p = points.withColumn("row", cell(F.col("x"), step))
    ground = p.groupBy(key, "row").agg(F.expr("percentile(z, 0.2)").alias("ground"))
    return p.join(ground, [key, "row"]).filter((F.col("z") >= F.col("ground") + low) & (F.col("z") <= F.col("ground") + high)).drop("ground")


def line_peaks(rows: DataFrame, key: str, width: float, support: float) -> DataFrame:
    """(key, bin, across, n_rows, share): columns of ``width`` across that hold points in ``support`` or more of the stretches and
    in no fewer than their neighbours (ties to the smaller bin); across is the mean of the points there and next to it."""
    cols = rows.withColumn("bin", cell(F.col("y"), width))
    total = cols.groupBy(key).agg(F.count_distinct("row").alias("all_rows"))
    prof = cols.groupBy(key, "bin").agg(F.count_distinct("row").alias("n_rows"), F.sum("y").alias("sy"), F.count("y").alias("n"))
    w = Window.partitionBy(key).orderBy("bin")

    def beside(c: str, step: int):
        other = F.lag if step < 0 else F.lead
        return F.when(other("bin").over(w) == F.col("bin") + step, other(c).over(w)).otherwise(0)

    prof = prof.select(key, "bin", "n_rows", beside("n_rows", -1).alias("l"), beside("n_rows", 1).alias("r"),
                       ((F.col("sy") + beside("sy", -1) + beside("sy", 1)) / (F.col("n") + beside("n", -1) + beside("n", 1))).alias("across"))
    peaks = prof.filter((F.col("n_rows") > F.col("l")) & (F.col("n_rows") >= F.col("r"))).join(total, key)
    return peaks.withColumn("share", F.col("n_rows") / F.col("all_rows")).filter(F.col("share") >= support).select(key, "bin", "across", "n_rows", "share")


def pair_candidates(rows: DataFrame, peaks: DataFrame, key: str, width: float, narrow: float, wide: float) -> DataFrame:
    """(key, a, b, spacing, joint, gap): peaks of a key ``narrow`` to ``wide`` apart, the share of stretches in which both (with the bins beside them) hold
    points, and the longest run of stretches between such ones. Peaks of a key are few: spacing bounds them by extent over width."""
    near = peaks.select(key, F.col("bin").alias("peak"), F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    held = rows.withColumn("bin", cell(F.col("y"), width)).select(key, "bin", "row").distinct().join(near, [key, "bin"]).select(key, "peak", "row").distinct()
    left, right = peaks.select(key, F.col("bin").alias("a"), F.col("across").alias("ya")), peaks.select(key, F.col("bin").alias("b"), F.col("across").alias("yb"))
    pairs = left.join(right, key).filter((F.col("yb") - F.col("ya")).between(narrow, wide)).select(key, "a", "b", (F.col("yb") - F.col("ya")).alias("spacing"))
    total = rows.groupBy(key).agg(F.count_distinct("row").alias("all_rows"))
    both = (pairs.join(held.withColumnRenamed("peak", "a"), [key, "a"])
            .join(held.select(key, F.col("peak").alias("b"), "row"), [key, "b", "row"], "left_semi"))
    step = F.col("row") - F.lag("row").over(Window.partitionBy(key, "a", "b").orderBy("row"))
    seen = both.withColumn("step", step).groupBy(key, "a", "b", "spacing").agg(F.count(F.lit(1)).alias("joint_rows"), F.coalesce(F.max("step") - 1, F.lit(0)).alias("gap"))
    return seen.join(total, key).select(key, "a", "b", "spacing", (F.col("joint_rows") / F.col("all_rows")).alias("joint"), "gap")


def detect_pairs(points: DataFrame, key: str = "segment_id", step: float = 1.0, width: float = 0.05, low: float = 0.1, high: float = 0.6,
                 support: float = 0.5, spacing: float = 1.435, off: float = 0.1, joint: float = 0.5) -> DataFrame:
    """(key, a, b, spacing, joint, gap): pairs of lines along x at about ``spacing``, each line used once, those nearest to it first.

    Points (key, x, y, z) are in the corridor's frame. Rows with a null take no part. Only counts per (key, row, bin) are shuffled
    beyond the ground quantile; no key's points are gathered in one task's memory.
    """
    rows = above_ground(points.select(key, "x", "y", "z").dropna(), key, step, low, high)
    peaks = line_peaks(rows, key, width, support)
    pairs = pair_candidates(rows, peaks, key, width, spacing - off, spacing + off).filter(F.col("joint") >= joint)
    ends = lambda c: F.xxhash64(F.col(key), F.col(c))
    scored = pairs.withColumn("__a", ends("a")).withColumn("__b", ends("b")).withColumn("score", F.round(F.abs(F.col("spacing") - spacing), 6))
    best = greedy_pairs(scored.select(F.col("__a").alias("a"), F.col("__b").alias("b"), "score")).select(F.col("a").alias("__a"), F.col("b").alias("__b"))
    return scored.join(best, ["__a", "__b"], "left_semi").select(key, "a", "b", "spacing", "joint", "gap")
