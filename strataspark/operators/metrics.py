"""Evaluation metrics as aggregates; undefined ratios are null."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import ratio
from .sequences import running_totals


def hash_share(*parts: Column | str) -> Column:
    """A number in [0, 1) from the SHA-256 of the parts, the same in every engine."""
    text = F.concat_ws(",", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") / 4294967296.0


def poisson_steps(most: int = 8) -> list[float]:
    """From which share on a Poisson(1) number is at least 1, 2, ..."""
    steps, total = [], 0.0
    for k in range(most):
        total += math.exp(-1) / math.factorial(k)
        steps.append(round(total, 9))
    return steps


def confusion(df: DataFrame, truth: Column, guess: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    n = lambda c: F.count(F.when(c, 1))
    out = df.groupBy(*keys).agg(n(truth & guess).alias("tp"), n(~truth & guess).alias("fp"), n(truth & ~guess).alias("fn"), n(~truth & ~guess).alias("tn"))
    c = F.col
    out = out.withColumn("precision", ratio(c("tp"), c("tp") + c("fp"))).withColumn("recall", ratio(c("tp"), c("tp") + c("fn")))
    return out.withColumn("f1", ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn"))).withColumn("iou", ratio(c("tp"), c("tp") + c("fp") + c("fn")))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's agreement of two ratings."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(F.col(a).alias("k")).agg(F.sum("n").alias("ra"))
    cols = cells.groupBy(F.col(b).alias("k")).agg(F.sum("n").alias("rb"))
    chance = rows.join(cols, "k").agg(F.sum(F.col("ra") * F.col("rb")).alias("e"))
    seen = cells.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    po, pe = F.col("same") / F.col("rows"), F.col("e") / (F.col("rows") * F.col("rows"))
    return seen.crossJoin(chance).select("rows", po.alias("agreement"), ratio(po - pe, 1 - pe).alias("kappa"))  # one row each


def calibration(df: DataFrame, score: str, truth: Column, bins: int) -> DataFrame:
    b = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("confidence"), F.avg(F.when(truth, 1.0).otherwise(0.0)).alias("accuracy"))


def paired_bootstrap(df: DataFrame, key: str, a: str, b: str, draws: int, seed: int) -> DataFrame:
    """Mean difference a - b and its 2.5 and 97.5 percentiles over resampled keys. A key's multiplicity in a draw is Poisson(1) from its
    hash, so no draw gathers rows: one narrow expansion by ``draws`` and one partial aggregation."""
    per = df.groupBy(key).agg(F.sum(F.col(a) - F.col(b)).alias("d"), F.count(F.lit(1)).alias("n"))
    drawn = per.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).withColumn("u", hash_share(F.lit(seed), "draw", key))
    times = sum((F.when(F.col("u") >= s, 1).otherwise(0) for s in poisson_steps()), F.lit(0))
    means = drawn.withColumn("t", times).groupBy("draw").agg((F.sum(F.col("d") * F.col("t")) / F.sum(F.col("n") * F.col("t"))).alias("m"))
    return means.agg(F.avg("m").alias("mean"), F.expr("percentile(m, 0.025)").alias("low"), F.expr("percentile(m, 0.975)").alias("high"))


def set_scores(found: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    both = found.select(*keys).distinct().withColumn("f", F.lit(1)).join(wanted.select(*keys).distinct().withColumn("w", F.lit(1)), keys, "full")
    n = lambda c: F.count(F.when(c, 1))
    out = both.agg(n(F.col("f").isNotNull() & F.col("w").isNotNull()).alias("tp"), n(F.col("w").isNull()).alias("fp"), n(F.col("f").isNull()).alias("fn"))
    return out.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))


def ranked_consensus(df: DataFrame, keys: list[str], score: Column, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(score.desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).withColumn("ties", F.count(F.lit(1)).over(Window.partitionBy(*keys, score)))


def selective_risk(df: DataFrame, order: list[Column], correct: Column) -> DataFrame:
    """(n, aurc, risk_at_half): the mean over all ranks of the error rate up to that rank, and that rate at half of the rows."""
    rows = running_totals(df.withColumn("__wrong", F.when(correct, 0).otherwise(1)).withColumn("__one", F.lit(1)), order, {"__e": "__wrong", "__i": "__one"})
    n = df.count()
    risk = F.col("__e") / F.col("__i")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(risk).alias("aurc"), F.max(F.when(F.col("__i") == (n + 1) // 2, risk)).alias("risk_at_half"))


def class_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """(class, tp, fp, fn, precision, recall, f1) of every class that is a truth or a guess: rows are counted by the pair first."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    part = lambda c, tp, fp, fn: F.struct(F.col(c).alias("class"), *[(F.col("n") * v).alias(k) for k, v in (("tp", tp), ("fp", fp), ("fn", fn))])
    same = F.col("t") == F.col("g")
    hit = same.cast("int")
    each = cells.select(F.explode(F.when(same, F.array(part("t", hit, F.lit(0), F.lit(0)))).otherwise(F.array(part("g", F.lit(0), F.lit(1), F.lit(0)), part("t", F.lit(0), F.lit(0), F.lit(1))))).alias("x"))
    out = each.select("x.*").groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    c = F.col
    return out.select("class", "tp", "fp", "fn", ratio(c("tp"), c("tp") + c("fp")).alias("precision"), ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
                      ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1"))


def tied_rank_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n, rank_share): the mean rank of tied rows from 0 to 1. Values are counted first, so the window runs over distinct ones."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key).orderBy(value)
    counts = counts.withColumn("before", F.sum("n").over(w) - F.col("n")).withColumn("total", F.sum("n").over(Window.partitionBy(key)))
    return counts.select(key, value, "n", ratio(F.col("before") + (F.col("n") - 1) / 2, F.col("total") - 1).alias("rank_share"))


def threshold_scores(distances: DataFrame, thresholds: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, threshold, completeness, precision, fscore) of rows (keys, side, distance): side 'reference' measures reference to model,
    'model' the other way. One aggregation over rows expanded by the few thresholds, combined before the shuffle."""
    t = F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold")
    share = lambda side: F.avg(F.when(F.col("side") == side, (F.col("distance") <= F.col("threshold")).cast("double")))
    out = distances.select(*keys, "side", "distance", t).groupBy(*keys, "threshold").agg(share("reference").alias("completeness"), share("model").alias("precision"))
    both = F.col("completeness") + F.col("precision")
    return out.withColumn("fscore", F.when(both == 0, 0.0).otherwise(2 * F.col("completeness") * F.col("precision") / both))
