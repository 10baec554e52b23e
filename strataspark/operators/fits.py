"""Fits as closed-form aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line(df: DataFrame, key: str, x: str, y: str, least: int) -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
            .filter((F.col("n") >= least) & F.col("slope").isNotNull()))


def robust_line(df: DataFrame, key: str, x: str, y: str, least: int, scale: float = 2.5) -> DataFrame:
    """A least-squares line refitted to rows within ``scale`` times 1.4826 median absolute deviations of the first."""
    first = line(df, key, x, y, least)
    rest = df.join(first, key).withColumn("__r", F.abs(F.col(y) - F.col("slope") * F.col(x) - F.col("intercept")))
    mad = rest.groupBy(key).agg(F.expr("percentile(__r, 0.5)").alias("__mad"))
    kept = rest.join(mad, key).filter(F.col("__r") <= scale * 1.4826 * F.col("__mad") + 1e-9).select(key, x, y)
    return line(kept, key, x, y, 2)


def principal_frame(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Centre and angle of the main axis of each key's points."""
    m = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("center_x"), F.avg(y).alias("center_y"), F.var_pop(x).alias("sxx"), F.var_pop(y).alias("syy"), F.covar_pop(x, y).alias("sxy"))
    return m.withColumn("angle", 0.5 * F.atan2(2 * F.col("sxy"), F.col("sxx") - F.col("syy"))).drop("sxx", "syy", "sxy")


def plane(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, n, a, b, c) of the least-squares planes z = a x + b y + c, from moments; none where x and y lie on a line."""
    m = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{v}") for v in "xyz"], F.var_pop("x").alias("sxx"), F.var_pop("y").alias("syy"),
                              *[F.covar_pop(*p).alias(f"s{p}") for p in ("xy", "xz", "yz")])
    det = F.col("sxx") * F.col("syy") - F.col("sxy") * F.col("sxy")
    m = m.filter(F.col("n") >= least).withColumn("det", det).filter("det > 1e-6")
    m = m.withColumn("a", F.expr("(sxz * syy - syz * sxy) / det")).withColumn("b", F.expr("(syz * sxx - sxz * sxy) / det"))
    return m.withColumn("c", F.expr("mz - a * mx - b * my")).select(*keys, "n", "a", "b", "c")


def robust_plane(df: DataFrame, keys: list[str], least: int, rounds: int = 1, scale: float = 2.5) -> DataFrame:
    """(keys, n, a, b, c, rms): planes refitted ``rounds`` times to the rows within ``scale`` times 1.4826 median absolute residuals of the
    last fit; n and rms are those of the rows kept. Rows are joined with one row per key and aggregated, never gathered."""
    rows = df.select(*keys, "x", "y", "z")

    def residuals(rows: DataFrame, fit: DataFrame) -> DataFrame:
        return rows.join(fit.drop("n"), keys).withColumn("r", F.abs(F.expr("z - a * x - b * y - c")))

    fit = plane(rows, keys, least)
    for _ in range(rounds):
        off = residuals(rows, fit)
        mad = off.groupBy(*keys).agg(F.expr("percentile(r, 0.5)").alias("mad"))
        rows = off.join(mad, keys).filter(F.col("r") <= scale * 1.4826 * F.col("mad") + 1e-9).select(*keys, "x", "y", "z")
        fit = plane(rows, keys, 3)
    rms = residuals(rows, fit).groupBy(*keys).agg(F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rms"))
    return fit.join(rms, keys)


def height_window(points: DataFrame, mode: str, low: float, high: float, z: str = "z", core: Column | None = None,
                  quantiles: tuple[float, float] = (0.05, 0.95), reference: Column | None = None) -> DataFrame:
    """Points within a closed range of heights: ``absolute`` from low to high; ``percentile``, the quantiles of the heights where ``core`` holds,
    moved by low and high; ``relative``, low and high added to each row's ``reference``. An empty range is an error."""
    if mode == "absolute":
        if high <= low:
            raise ValueError("the upper height must lie above the lower one")
        return points.filter(F.col(z).between(low, high))
    if mode == "relative":
        return points.filter(F.col(z).between(reference + low, reference + high))
    if mode != "percentile":
        raise ValueError(f"unknown height mode {mode!r}")
    ends = points.filter(core if core is not None else F.lit(True)).agg(F.percentile(z, F.array(*[F.lit(q) for q in quantiles])).alias("q")).first().q
    if ends is None or ends[1] + high <= ends[0] + low:
        raise ValueError("the upper height must lie above the lower one")
    return points.filter(F.col(z).between(ends[0] + low, ends[1] + high))
