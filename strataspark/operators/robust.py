"""Fits that stand outliers: line traces by hypotheses and votes, and sagging wires by trimmed normal equations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut, discard

c = F.col
SMALL = 200_000  # rows of a table of hypotheses that is broadcast


@dataclass(frozen=True)
class TraceLimits:
    """Limits of ``line_traces``; fixed values of the method, in the unit of the points."""

    cell: float = 0.05  # points of a cell of this size count once
    hypotheses: int = 48  # pairs of points a key and round
    least_apart: float = 0.55  # of a pair, along u
    steepest: float = 1.8
    tolerance: float = 0.065
    least_points: int = 10
    least_span: float = 0.55
    bin: float = 0.12  # of which a trace should occupy every one
    removed: float = 0.13  # around an accepted trace
    traces: int = 8


def thinned(points: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, cu, cz, u, z): of each cell its smallest point."""
    at = lambda v: F.floor(c(v) / cell + 0.5).alias(f"c{v}")
    return points.select(key, "u", "z", at("u"), at("z")).dropna().groupBy(key, "cu", "cz").agg(F.min(F.struct("u", "z")).alias("p")).select(key, "cu", "cz", "p.u", "p.z")


def hypotheses(cells: DataFrame, key: str, seed: int, limits: TraceLimits) -> DataFrame:
    """(key, h, slope, intercept): lines through pairs of a key's points. Points fall into buckets by a hash of their cell; the first and the last of a bucket by that hash are a pair, so the
    pairs depend on the points alone, not on how they are dealt, and one aggregation finds them all."""
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), c(key).cast("string"), "cu", "cz").cast("binary"))
    rows = cells.withColumn("mark", mark).withColumn("h", F.conv(F.substring("mark", 1, 6), 16, 10).cast("long") % limits.hypotheses)
    ends = rows.groupBy(key, "h").agg(F.min_by(F.struct("u", "z"), "mark").alias("a"), F.max_by(F.struct("u", "z"), "mark").alias("b"))
    run = c("b.u") - c("a.u")
    slope = (c("b.z") - c("a.z")) / run
    return ends.filter(F.abs(run) >= limits.least_apart).select(key, "h", slope.alias("slope"), (c("a.z") - slope * c("a.u")).alias("intercept")).filter(F.abs("slope") <= limits.steepest)


def line_traces(points: DataFrame, key: str, limits: TraceLimits = TraceLimits()) -> DataFrame:
    """(key, trace, n, u05, u95, slope, intercept, rmse, coverage): each key's dominant lines z = slope u + intercept of points (key, u, z), one after the other.

    Every round draws hypotheses, counts their inliers for all keys at once, takes each key's best by span, coverage and root of inliers, fits its inliers and removes what
    lies near it. Keys without an acceptable line drop out. Null points take no part.
    """
    left, found, kind = cut(thinned(points, key, limits.cell)), None, dict(points.dtypes)[key]
    for trace in range(1, limits.traces + 1):
        lines = cut(hypotheses(left, key, trace, limits))
        lines = F.broadcast(lines) if lines.count() <= SMALL else lines
        off = F.abs(c("z") - c("slope") * c("u") - c("intercept"))
        votes = left.join(lines, key).filter(off <= limits.tolerance).groupBy(key, "h", "slope", "intercept").agg(
            F.count(F.lit(1)).alias("n"), F.percentile("u", F.array(F.lit(0.05), F.lit(0.95))).alias("q"), F.size(F.collect_set(F.floor(c("u") / limits.bin))).alias("bins"))
        span = F.round(c("q")[1] - c("q")[0], 9)
        cover = c("bins") / F.greatest(F.lit(1), F.ceil(span / limits.bin) + 1)
        fair = votes.filter((c("n") >= limits.least_points) & (span >= limits.least_span)).withColumn("score", F.round(span * cover * F.sqrt("n"), 9))
        best = cut(fair.groupBy(key).agg(F.min_by(F.struct("slope", "intercept", "q", cover.alias("coverage")), F.struct(-c("score"), c("h"))).alias("b")).select(key, "b.*"))
        some = best.count()
        if some:
            met = left.join(F.broadcast(best) if some <= SMALL else best, key)
            fits = met.filter(off <= limits.tolerance).groupBy(key).agg(
                F.count(F.lit(1)).alias("n"), F.regr_slope("z", "u").alias("slope"), F.regr_intercept("z", "u").alias("intercept"), F.regr_sxx("z", "u").alias("sxx"), F.regr_syy("z", "u").alias("syy"),
                F.first("q").alias("q"), F.first("coverage").alias("coverage"))
            rest = F.greatest(c("syy") - c("slope") * c("slope") * c("sxx"), F.lit(0.0))
            fits = cut(fits.select(key, F.lit(trace).alias("trace"), "n", c("q")[0].alias("u05"), c("q")[1].alias("u95"), "slope", "intercept", F.sqrt(rest / c("n")).alias("rmse"), "coverage"))
            found = fits if found is None else found.unionByName(fits)
            near = fits.select(key, "slope", "intercept")
            before, left = left, cut(left.join(F.broadcast(near) if some <= SMALL else near, key).filter(off > limits.removed).select(left.columns))
            discard(before)
        discard(lines)
        discard(best)
        if not some:
            break
    if found is None:
        return points.sparkSession.createDataFrame([], f"{key} {kind}, trace int, n long, u05 double, u95 double, slope double, intercept double, rmse double, coverage double")
    return found


@dataclass(frozen=True)
class SagLimits:
    """Limits of ``sag_fits``; fixed values of the method, in the unit of the points."""

    bin: float = 0.5  # along the span
    margin: float = 0.6  # left out at either end
    least_points: int = 3  # of a bin
    least_bins: int = 20
    rounds: int = 6
    tightest: float = 0.035
    widest: float = 0.15
    deviations: float = 3 * 1.4826
    least_kept: float = 0.7
    most_p90: float = 0.1
    least_sag: float = 0.05


def determinant(a: list[list[Column]]) -> Column:
    (p, q, r), (s, t, u), (v, w, x) = a
    return p * (t * x - u * w) - q * (s * x - u * v) + r * (s * w - t * v)


def sag_fits(points: DataFrame, key: str, limits: SagLimits = SagLimits()) -> DataFrame:
    """(key, bins, kept, slope, curvature, sag, p90, passed): wires (key, s, c, z, start, stop) as a straight line across and a parabola of height over the station.

    Medians of bins along the span are fitted. Each round solves the normal equations of all spans from sums over their kept bins, and keeps the bins whose distance from the fit is within
    robust deviations, as long as enough of them are left; a selection that no longer changes stays as it is. Everything is windows over a span's bins: one shuffle, whatever the rounds.
    Spans of fewer than four bins have no fit and do not pass.
    """
    inner = points.filter((c("s") >= c("start") + limits.margin) & (c("s") <= c("stop") - limits.margin))
    bins = inner.groupBy(key, "start", "stop", F.floor((c("s") - c("start")) / limits.bin).alias("b")).agg(F.count(F.lit(1)).alias("n"), *[F.percentile(v, 0.5).alias(v) for v in ("s", "c", "z")])
    whole = Window.partitionBy(key)
    rows = bins.filter(c("n") >= limits.least_points).select(key, ((c("stop") - c("start")) / 2).alias("half"), (c("s") - (c("start") + c("stop")) / 2).alias("u"), c("c").alias("y"), "z", F.lit(True).alias("keep"))
    rows = rows.withColumn("bins", F.count(F.lit(1)).over(whole))

    def fitted(df: DataFrame) -> DataFrame:
        """``df`` with the line (a0, a1), the parabola (b0, b1, b2) of the kept rows and each row's distance from both."""
        total = lambda v: F.sum(F.when(c("keep"), v)).over(whole)
        power = [total(F.pow("u", F.lit(i))) for i in range(5)]
        y, z = [total(c("y") * F.pow("u", F.lit(i))) for i in range(2)], [total(c("z") * F.pow("u", F.lit(i))) for i in range(3)]
        df = df.select("*", *[v.alias(f"m{i}") for i, v in enumerate(power)], *[v.alias(f"y{i}") for i, v in enumerate(y)], *[v.alias(f"z{i}") for i, v in enumerate(z)])
        m = [[c(f"m{i + j}") for j in range(3)] for i in range(3)]
        swap = lambda k: [[c(f"z{i}") if j == k else m[i][j] for j in range(3)] for i in range(3)]
        flat, solid = c("m0") * c("m2") - c("m1") * c("m1"), determinant(m)
        over = lambda a, b: F.when(b != 0, a / b)
        df = df.select(*[n for n in df.columns if n[0] not in "abm" or n == "bins"], over(c("y0") * c("m2") - c("y1") * c("m1"), flat).alias("a0"), over(c("y1") * c("m0") - c("y0") * c("m1"), flat).alias("a1"),
                       *[over(determinant(swap(k)), solid).alias(f"b{k}") for k in range(3)])
        df = df.drop("y0", "y1", "z0", "z1", "z2")
        return df.withColumn("off", F.hypot(c("y") - c("a0") - c("a1") * c("u"), c("z") - c("b0") - c("b1") * c("u") - c("b2") * c("u") * c("u")))

    base = [key, "half", "u", "y", "z", "keep", "bins"]
    middle = lambda v: F.percentile(F.when(c("keep"), v), 0.5).over(whole)
    for _ in range(limits.rounds):
        off = fitted(rows).withColumn("mid", middle(c("off"))).withColumn("spread", middle(F.abs(c("off") - c("mid"))))
        limit = F.least(F.lit(limits.widest), F.greatest(F.lit(limits.tightest), c("mid") + limits.deviations * c("spread")))
        tried = off.withColumn("try", F.coalesce(c("off") <= limit, F.lit(False)))
        enough = F.sum(c("try").cast("int")).over(whole) >= max(4, limits.least_bins)
        rows = tried.withColumn("enough", enough).withColumn("keep", F.when(c("enough"), c("try")).otherwise(c("keep"))).select(*base)
    last = fitted(rows).groupBy(key).agg(
        F.first("bins").alias("bins"), F.sum(c("keep").cast("long")).alias("kept"), F.first("a1").alias("slope"), F.first("b2").alias("curvature"), (F.first("b2") * F.first("half") * F.first("half")).alias("sag"),
        F.percentile(F.when(c("keep"), c("off")), 0.9).alias("p90"))
    few = c("bins") < 4
    out = last.select(key, "bins", F.when(few, F.lit(0)).otherwise(c("kept")).alias("kept"), *[F.when(~few, c(v)).alias(v) for v in ("slope", "curvature", "sag", "p90")])
    ok = (c("bins") >= limits.least_bins) & (c("kept") / c("bins") >= limits.least_kept) & (c("p90") <= limits.most_p90) & (c("curvature") > 0) & (c("sag") >= limits.least_sag)
    return out.withColumn("passed", F.coalesce(ok, F.lit(False)))
