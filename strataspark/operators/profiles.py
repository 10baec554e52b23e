"""Fits and profiles of each key's points: frames, robust lines, grids of columns, sections, support and lanes. One partitioning by key serves all steps of a fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cell, ratio


def median(value: str | Column) -> Column:
    return F.percentile(value, 0.5)


def oriented_frame(df: DataFrame, key: str, x: str, y: str, order: list[str]) -> DataFrame:
    """(key, ox, oy, ax, ay, rx, ry): centre, the unit vector of the main axis, and that of the regression on the coordinate with the larger range;
    both point from the first row to the last in ``order``."""
    c = F.col
    first, last = F.struct(*order), F.struct(x, y)
    m = df.groupBy(key).agg(F.avg(x).alias("ox"), F.avg(y).alias("oy"), F.var_pop(x).alias("sxx"), F.var_pop(y).alias("syy"), F.covar_pop(x, y).alias("sxy"), (F.max(x) - F.min(x)).alias("wx"),
                            (F.max(y) - F.min(y)).alias("wy"), F.min_by(last, first).alias("a"), F.max_by(last, first).alias("b"))
    turn = 0.5 * F.atan2(2 * c("sxy"), c("sxx") - c("syy"))
    m = m.withColumns({"px": F.cos(turn), "py": F.sin(turn), "qx": F.when(c("wy") >= c("wx"), ratio(c("sxy"), c("syy"))).otherwise(1.0), "qy": F.when(c("wy") >= c("wx"), 1.0).otherwise(ratio(c("sxy"), c("sxx"))),
                       "dx": c("b")[x] - c("a")[x], "dy": c("b")[y] - c("a")[y]})
    sign = lambda u, v: F.when(u * c("dx") + v * c("dy") < 0, -1.0).otherwise(1.0)
    s, t, n = sign(c("px"), c("py")), sign(c("qx"), c("qy")), F.sqrt(c("qx") * c("qx") + c("qy") * c("qy"))
    return m.select(key, "ox", "oy", (c("px") * s).alias("ax"), (c("py") * s).alias("ay"), (c("qx") * t / n).alias("rx"), (c("qy") * t / n).alias("ry"))


def robust_line(df: DataFrame, key: str, x: str, y: str, least: float = 0.02, scale: float = 3.0) -> DataFrame:
    """(key, n, kept, slope, intercept, p90): least squares, refitted to rows whose residual is within the larger of ``least`` and ``scale`` times 1.4826 median
    absolute deviations of the median residual; p90 of the absolute residuals of the rows kept. Keys of fewer than two rows or without extent
    have slope 0, the median and no p90. All steps are windows over one partitioning."""
    c, w = F.col, Window.partitionBy(key)
    d = df.select(key, c(x).cast("double").alias("__x"), c(y).cast("double").alias("__y"))
    d = d.withColumn("__flat", (F.max("__x").over(w) - F.min("__x").over(w) <= 1e-9) | (F.count(F.lit(1)).over(w) < 2))
    d = d.withColumn("__a", F.regr_slope("__y", "__x").over(w)).withColumn("__b", F.regr_intercept("__y", "__x").over(w)).withColumn("__r", c("__y") - c("__a") * c("__x") - c("__b"))
    d = d.withColumn("__m", F.expr("percentile(__r, 0.5)").over(w)).withColumn("__d", F.abs(c("__r") - c("__m")))
    d = d.withColumn("__t", F.expr("percentile(__d, 0.5)").over(w)).withColumn("__k", c("__d") <= F.greatest(F.lit(least), scale * 1.4826 * c("__t")))
    kx = F.when(c("__k"), c("__x"))
    d = d.withColumn("__kx", kx).withColumn("__two", (F.count("__kx").over(w) >= 2) & (F.max("__kx").over(w) - F.min("__kx").over(w) > 1e-9))
    d = d.withColumn("__kx", F.when(c("__two"), c("__kx")).otherwise(c("__x")))  # too few kept: the first fit stands
    d = d.withColumn("__a2", F.regr_slope("__y", "__kx").over(w)).withColumn("__b2", F.regr_intercept("__y", "__kx").over(w)).withColumn("__e", F.when(c("__kx").isNotNull(), F.abs(c("__y") - c("__a2") * c("__x") - c("__b2"))))
    out = d.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count("__e").alias("kept"), F.first("__flat").alias("flat"), F.first("__a2").alias("slope"), F.first("__b2").alias("intercept"),
                             median("__y").alias("mid"), F.percentile("__e", 0.9).alias("p90"))
    pick = lambda good, bad: F.when(c("flat"), bad).otherwise(good)
    return out.select(key, "n", pick(c("kept"), c("n")).alias("kept"), pick(c("slope"), F.lit(0.0)).alias("slope"), pick(c("intercept"), c("mid")).alias("intercept"), pick(c("p90"), F.lit(None)).alias("p90"))


def deviation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, median, mad): median and median absolute deviation."""
    w = Window.partitionBy(*keys)
    d = df.select(*keys, F.col(value).alias("__v")).filter("__v is not null").withColumn("__m", F.expr("percentile(__v, 0.5)").over(w))
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("__m").alias("median"), median(F.abs(F.col("__v") - F.col("__m"))).alias("mad"))


def spacing(df: DataFrame, key: str, at: str, id_col: str, least: int = 3) -> DataFrame:
    """(key, n, median, mad, variation, variation_without_one): regularity of the steps along each key; the last leaves out the step farthest from the
    median, so that one odd step does not hide a regular row."""
    c, w = F.col, Window.partitionBy(key)
    steps = df.select(key, (c(at) - F.lag(at).over(w.orderBy(at, id_col))).alias("s")).filter("s is not null")
    d = steps.withColumn("m", F.expr("percentile(s, 0.5)").over(w)).withColumn("d", F.abs(c("s") - c("m"))).withColumn("odd", F.row_number().over(w.orderBy(c("d").desc(), "s")) == 1)
    rest = F.when(~c("odd"), c("s"))
    out = d.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("m").alias("median"), median("d").alias("mad"), ratio(F.stddev_pop("s"), F.avg("s")).alias("variation"),
                             ratio(F.stddev_pop(rest), F.avg(rest)).alias("variation_without_one"))
    return out.filter(c("n") >= least)


def column_grid(seeds: DataFrame, key: str, at: str, nominal: float, low: float, high: float) -> DataFrame:
    """(key, seeds, spacing, phase, worst): the grid of places ``phase + k * spacing`` that best goes through each key's seeds.

    Spacings come from pairs of seeds within four nominal steps (their distance over the number of steps nearest to nominal), the median of those within [low, high]
    numbers the seeds from the one nearest to their median; a least-squares line through the numbers is the grid. Keys without a
    plausible spacing have none."""
    c, w = F.col, Window.partitionBy(key)
    s = seeds.select(key, c(at).cast("double").alias("s"))
    once = s.groupBy(key, "s").agg(F.count(F.lit(1)).alias("m")).withColumn("__c", F.floor(c("s") / (4 * nominal)))  # seeds of one place make the same pairs
    near = once.select(key, c("s").alias("t"), c("m").alias("l"), F.explode(F.array(c("__c"), c("__c") + 1)).alias("__c"))
    step = F.abs(c("t") - c("s"))
    pairs = near.join(once, [key, "__c"]).filter((step > 0) & (step <= 4 * nominal)).withColumn("d", step / F.greatest(F.lit(1), F.rint(step / nominal)))
    first = pairs.filter(c("d").between(low, high)).groupBy(key).agg(F.expr("percentile(d, 0.5D, l * m)").alias("d"))
    j = s.join(first, key).withColumn("m", F.expr("percentile(s, 0.5)").over(w))
    anchor = F.first("s").over(w.orderBy(F.abs(c("s") - c("m")), "s").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    j = j.withColumn("k", F.rint((c("s") - anchor) / c("d")))
    fit = j.withColumn("a", F.regr_slope("s", "k").over(w)).withColumn("b", F.regr_intercept("s", "k").over(w))
    out = fit.groupBy(key).agg(F.count(F.lit(1)).alias("seeds"), F.first("a").alias("spacing"), F.first("b").alias("phase"), F.max(F.abs(c("s") - c("b") - c("a") * c("k"))).alias("worst"))
    return out.filter(c("spacing").between(low, high))


def two_faces(df: DataFrame, key: str, value: str, least: float) -> DataFrame:
    """(key, low, high, centre, gap): a key's sorted values split at their largest gap (ties to the lower one), the medians of both halves; keys whose
    largest gap is under ``least`` are left out."""
    c, w = F.col, Window.partitionBy(key)
    d = df.select(key, c(value).alias("v")).withColumn("g", F.lead("v").over(w.orderBy("v")) - c("v"))
    top = d.groupBy(key).agg(F.max_by(F.struct("v", "g"), F.struct("g", -c("v"))).alias("t")).filter(c("t.g") >= least)
    halves = d.join(top, key).groupBy(key).agg(median(F.when(c("v") <= c("t.v"), c("v"))).alias("low"), median(F.when(c("v") > c("t.v"), c("v"))).alias("high"), F.first("t.g").alias("gap"))
    return halves.select(key, "low", "high", ((c("low") + c("high")) / 2).alias("centre"), "gap")


def longest_false(bins: DataFrame, key: list[str], at: str, flag: str) -> DataFrame:
    """(keys, bins, share, longest, inner): how many bins, the share that holds, the longest run that does not, and the longest such run between bins that hold
    (all bins where fewer than two hold)."""
    c, w = F.col, Window.partitionBy(*key).orderBy(at)
    run = F.sum(c(flag).cast("int")).over(w)
    total = F.sum(c(flag).cast("int")).over(Window.partitionBy(*key))
    d = bins.withColumn("__run", run).withColumn("__all", total)
    runs = d.groupBy(*key, "__run").agg(F.count(F.when(~c(flag), 1)).alias("f"), F.count(F.lit(1)).alias("m"), F.first("__all").alias("held"))
    out = runs.groupBy(*key).agg(F.sum("m").alias("bins"), F.first("held").alias("held"), F.max("f").alias("longest"),
                                 F.coalesce(F.max(F.when((c("__run") > 0) & (c("__run") < c("held")), c("f"))), F.lit(0)).alias("inner"))
    return out.select(*key, "bins", (c("held") / c("bins")).alias("share"), "longest", F.when(c("held") < 2, c("bins")).otherwise(c("inner")).alias("inner"))


def occupancy(df: DataFrame, key: list[str], value: str, size: float, times: str | None = None) -> DataFrame:
    """(keys, n, low, high, bins, filled, ratio, longest_gap): occupied bins of a value between the first and last, and the longest run of empty ones. A row counts as often as its column ``times`` says, or once."""
    c = F.col
    b = df.groupBy(*key, cell(c(value), size).alias("b")).agg((F.sum(times) if times else F.count(F.lit(1))).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    b = b.withColumn("__s", c("b") - F.lag("b").over(Window.partitionBy(*key).orderBy("b")) - 1)
    out = b.groupBy(*key).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), (F.max("b") - F.min("b") + 1).alias("bins"), F.count(F.lit(1)).alias("filled"),
                              F.coalesce(F.max("__s"), F.lit(0)).alias("longest_gap"))
    return out.select(*key, "n", "low", "high", "bins", "filled", (c("filled") / c("bins")).alias("ratio"), "longest_gap")


def sections(df: DataFrame, key: str, height: str, across: str, low: float, high: float, size: float) -> DataFrame:
    """(key, level, n, p05, p50, p95, width): percentiles across in half-open bins of height over [low, high], the last one closed."""
    c = F.col
    n = max(1, round((high - low) / size))
    level = F.least(F.lit(n - 1), F.floor((c(height) - low) / size)).alias("level")
    out = df.filter(c(height).between(low, high)).groupBy(key, level).agg(F.count(F.lit(1)).alias("n"), F.percentile(across, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("p"))
    return out.select(key, "level", "n", c("p")[0].alias("p05"), c("p")[1].alias("p50"), c("p")[2].alias("p95"), (c("p")[2] - c("p")[0]).alias("width"))


def baseline(bins: DataFrame, keys: list[str], at: str, value: str, half: int) -> DataFrame:
    """``bins`` with ``base``, the median of the 2 * half + 1 bins around each one, and ``above``, what stands over it; beyond the ends the end bins
    repeat (as many copies as are missing)."""
    c, w = F.col, Window.partitionBy(*keys).orderBy(at)
    near = F.collect_list(value).over(w.rowsBetween(-half, half))
    d = bins.withColumn("__n", near).withColumn("__i", F.row_number().over(w)).withColumn("__m", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    first, last = F.first(value).over(w), F.last(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    d = d.withColumn("__f", first).withColumn("__l", last)
    miss = lambda k: F.greatest(F.lit(0), k).cast("int")
    full = F.array_sort(F.concat(F.array_repeat("__f", miss(half + 1 - c("__i"))), c("__n"), F.array_repeat("__l", miss(c("__i") + half - c("__m")))))
    return d.withColumn("base", F.element_at(full, half + 1)).withColumn("above", c(value) - c("base")).drop("__n", "__i", "__m", "__f", "__l")


def gaussian(bins: DataFrame, keys: list[str], at: str, value: str, sigma: float) -> DataFrame:
    """``bins`` with ``smooth``: weighted means over four sigma, beyond the ends mirrored with the end bin twice."""
    import math

    half = int(4 * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-half, half + 1)]
    weights = [x / sum(weights) for x in weights]
    w, c = Window.partitionBy(*keys).orderBy(at), F.col
    d = bins.withColumn("__i", F.row_number().over(w)).withColumn("__m", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    near = F.collect_list(value).over(w.rowsBetween(-2 * half, 2 * half))
    d = d.withColumn("__n", near).withColumn("__o", F.least(c("__i") - 1, F.lit(2 * half)))  # place of the row in its list
    parts = []
    for k, x in zip(range(-half, half + 1), weights):
        at_ = c("__i") - 1 + k
        at_ = F.when(at_ < 0, -at_ - 1).otherwise(at_)
        at_ = F.when(at_ >= c("__m"), 2 * c("__m") - 1 - at_).otherwise(at_)
        parts.append(F.get("__n", (at_ - (c("__i") - 1) + c("__o")).cast("int")) * x)
    return d.withColumn("smooth", sum(parts, F.lit(0.0))).drop("__i", "__m", "__n", "__o")


def prominent_peaks(bins: DataFrame, keys: list[str], at: str, value: str, height: float, prominence: float, reach: int) -> DataFrame:
    """Bins above both neighbours (ends excluded) of ``height`` or more that stand ``prominence`` or more over the higher of the lowest bins to
    each side, up to the next higher bin or ``reach`` bins away."""
    c, w = F.col, Window.partitionBy(*keys).orderBy(at)
    d = bins.withColumn("__l", F.lag(value).over(w)).withColumn("__r", F.lead(value).over(w))
    d = d.withColumn("__left", F.reverse(F.collect_list(value).over(w.rowsBetween(-reach, -1)))).withColumn("__right", F.collect_list(value).over(w.rowsBetween(1, reach)))

    def floor(side: str) -> Column:
        zero = F.struct(c(value).alias("low"), F.lit(False).alias("stop"))
        step = lambda a, x: F.struct(F.when(a["stop"] | (x > c(value)), a["low"]).otherwise(F.least(a["low"], x)).alias("low"), (a["stop"] | (x > c(value))).alias("stop"))
        return F.aggregate(side, zero, step, lambda a: a["low"])

    peak = d.filter((c(value) > c("__l")) & (c(value) >= c("__r")) & (c(value) >= height))
    peak = peak.withColumn("prominence", c(value) - F.greatest(floor("__left"), floor("__right")))
    return peak.filter(c("prominence") >= prominence).drop("__l", "__r", "__left", "__right")


def apart(peaks: DataFrame, keys: list[str], at: str, value: str, distance: int) -> DataFrame:
    """Peaks none of which has a higher one (ties: an earlier one) within ``distance``."""
    c, w = F.col, Window.partitionBy(*keys).orderBy(at).rangeBetween(-distance, distance)
    best = F.max(F.struct(c(value), (-c(at)).alias("__n"))).over(w)
    return peaks.withColumn("__b", best).filter((c("__b")[value] == c(value)) & (c("__b")["__n"] == -c(at))).drop("__b")
