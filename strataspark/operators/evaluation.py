"""Evaluation of detections, topology, evidence, measurements and diagnoses; selection and regression of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import ratio
from .metrics import calibration, hash_share, poisson_steps, selective_risk


def prf(df: DataFrame) -> DataFrame:
    """``df`` (tp, fp, fn) with precision, recall and f1; undefined ones are null, f1 also where both are 0."""
    c = F.col
    out = df.withColumn("precision", ratio(c("tp"), c("tp") + c("fp"))).withColumn("recall", ratio(c("tp"), c("tp") + c("fn")))
    return out.withColumn("f1", ratio(2 * c("precision") * c("recall"), c("precision") + c("recall")))


def count_scores(df: DataFrame) -> DataFrame:
    """``df`` (tp, fp, fn) with f1 from the counts: 0, not null, where nothing is right but something was there."""
    c = F.col
    out = df.withColumn("precision", ratio(c("tp"), c("tp") + c("fp"))).withColumn("recall", ratio(c("tp"), c("tp") + c("fn")))
    return out.withColumn("f1", ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")))


def mutual_matches(truth: DataFrame, found: DataFrame, most: float) -> DataFrame:
    """(truth_id, found_id, distance): rows (id, block, center) of a block that are each other's nearest within ``most``, ties to the smaller id.
    An equi-join on block and cells of that width."""
    c = F.col
    left = truth.select(c("id").alias("truth_id"), c("block"), c("center").alias("a")).withColumn("__c", F.explode(F.sequence(F.floor(c("a") / most) - 1, F.floor(c("a") / most) + 1)))
    right = found.select(c("id").alias("found_id"), c("block"), c("center").alias("b")).withColumn("__c", F.floor(c("b") / most))
    j = left.join(right, ["block", "__c"]).withColumn("distance", F.abs(c("a") - c("b"))).filter(c("distance") <= most)
    first = lambda k, o: F.row_number().over(Window.partitionBy(k).orderBy("distance", o)) == 1
    return j.withColumn("__t", first("truth_id", "found_id")).withColumn("__f", first("found_id", "truth_id")).filter("__t and __f").select("truth_id", "found_id", "distance")


def matched_scores(truth: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(label, tp, fp, fn, precision, recall, f1) of detection whatever the type (label ``detection``) and of each type, and the mean f1 of the types where it is
    defined (label ``macro``). Rows are (id, type); a pair counts for a type if both sides have it."""
    c = F.col
    t = truth.select(c("id").alias("truth_id"), c("type").alias("tt"))
    f = found.select(c("id").alias("found_id"), c("type").alias("ft"))
    j = pairs.select("truth_id", "found_id").join(t, "truth_id", "full").join(f, "found_id", "full")
    one = lambda label, tp, fp, fn: F.struct(label.alias("label"), *[F.lit(v).alias(k) for k, v in (("tp", tp), ("fp", fp), ("fn", fn))])
    hit, lost = c("truth_id").isNotNull() & c("found_id").isNotNull(), c("found_id").isNull()
    whole = F.when(hit, one(F.lit("detection"), 1, 0, 0)).when(lost, one(F.lit("detection"), 0, 0, 1)).otherwise(one(F.lit("detection"), 0, 1, 0))
    kinds = (F.when(hit & (c("tt") == c("ft")), F.array(one(c("tt"), 1, 0, 0))).when(hit, F.array(one(c("tt"), 0, 0, 1), one(c("ft"), 0, 1, 0)))
             .when(lost, F.array(one(c("tt"), 0, 0, 1))).otherwise(F.array(one(c("ft"), 0, 1, 0))))
    sums = j.select(F.explode(F.concat(F.array(whole), kinds)).alias("x")).select("x.*").groupBy("label").agg(*[F.sum(k).alias(k) for k in ("tp", "fp", "fn")])
    scored = prf(sums)
    none = F.lit(None)
    macro = scored.filter("label <> 'detection'").agg(F.avg("f1").alias("f1")).select(
        F.lit("macro").alias("label"), *[none.cast("long").alias(k) for k in ("tp", "fp", "fn")], *[none.cast("double").alias(k) for k in ("precision", "recall")], "f1")
    return scored.select("label", "tp", "fp", "fn", "precision", "recall", "f1").union(macro)


def topology_scores(truth: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(scope, tp, fp, fn, precision, recall, f1) of relations (type, a, b): ``end_to_end`` over all, ends that no pair maps being wrong; ``conditional`` over relations
    whose ends both are in pairs."""
    c = F.col
    to = lambda k: pairs.select(c("found_id").alias(k), c("truth_id").alias(f"{k}_t"))
    mapped = found.select("type", "a", "b").join(to("a"), "a", "left").join(to("b"), "b", "left")
    name = lambda k: F.when(c(f"{k}_t").isNotNull(), F.concat(F.lit("t"), c(f"{k}_t"))).otherwise(F.concat(F.lit("f"), c(k)))
    guess = mapped.select("type", name("a").alias("a"), name("b").alias("b"), (c("a_t").isNotNull() & c("b_t").isNotNull()).alias("known")).distinct()
    own = lambda k: pairs.select(c("truth_id").alias(k), F.lit(True).alias(f"{k}_in")).distinct()
    real = truth.select("type", "a", "b").distinct().join(own("a"), "a", "left").join(own("b"), "b", "left")
    real = real.select("type", F.concat(F.lit("t"), "a").alias("a"), F.concat(F.lit("t"), "b").alias("b"), (c("a_in").isNotNull() & c("b_in").isNotNull()).alias("held"), F.lit(True).alias("real"))
    j = guess.withColumn("guess", F.lit(True)).join(real, ["type", "a", "b"], "full")
    scopes = F.array(F.struct(F.lit("end_to_end").alias("scope"), c("real").alias("r"), c("guess").alias("g")),
                     F.struct(F.lit("conditional").alias("scope"), (c("real") & c("held")).alias("r"), (c("guess") & c("known")).alias("g")))
    yes = lambda k: F.coalesce(c(k), F.lit(False))
    n = lambda x: F.count(F.when(x, 1))
    return prf(j.select(F.explode(scopes).alias("x")).select("x.*").groupBy("scope").agg(n(yes("r") & yes("g")).alias("tp"), n(~yes("r") & yes("g")).alias("fp"), n(yes("r") & ~yes("g")).alias("fn")))


def release_rates(df: DataFrame, released: Column, status: Column, statuses: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, predictions, released, coverage, a rate for each status among the released)."""
    n = lambda x: F.count(F.when(x, 1))
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("predictions"), n(released).alias("released"), *[n(released & (status == s)).alias(s) for s in statuses])
    return out.select(*keys, "predictions", "released", ratio(F.col("released"), F.col("predictions")).alias("coverage"), *[ratio(F.col(s), F.col("released")).alias(f"{s}_rate") for s in statuses])


def confidence_summary(df: DataFrame, score: str, truth: Column, order: list[Column], bins: int = 10) -> DataFrame:
    """(n, brier, ece, aurc, risk_at_half): mean squared error of a score in [0, 1], the gap of score and accuracy over bins weighted by rows (the last bin
    is closed), and the risk by falling score. ``order`` breaks ties, so that it tells rows apart."""
    hit = F.when(truth, 1.0).otherwise(0.0)
    rows = df.filter(F.col(score).isNotNull())
    brier = rows.agg(F.avg((F.col(score) - hit) * (F.col(score) - hit)).alias("brier"))
    b = calibration(rows, score, truth, bins)
    ece = b.agg((F.sum(F.col("n") * F.abs(F.col("confidence") - F.col("accuracy"))) / F.sum("n")).alias("ece"))
    return selective_risk(rows, [F.col(score).desc(), *order], truth).crossJoin(brier).crossJoin(ece).select("n", "brier", "ece", "aurc", "risk_at_half")  # one row each


def strict_matches(truth: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """(tp, fp, fn) of findings against faults, one to one by ``keys``: of several findings of a fault one is right, the others are false alarms."""
    t = truth.select(*keys).distinct().withColumn("t", F.lit(1))
    f = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    j = t.join(f, keys, "full")
    hit = F.col("t").isNotNull() & F.col("m").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return j.agg(total(hit.cast("int")).alias("tp"), total(F.when(hit, F.col("m") - 1).otherwise(F.coalesce("m", F.lit(0)))).alias("fp"), total(F.col("m").isNull().cast("int")).alias("fn"))


def paired_interval(df: DataFrame, key: str, difference: str, draws: int, seed: int) -> DataFrame:
    """(n, mean, low, high, better, degenerate): the mean difference of the keys, its 2.5 and 97.5 percentiles over resampled keys, the share of draws above 0 and
    whether all keys agree. A key's multiplicity in a draw is Poisson(1) from its hash: one narrow expansion by ``draws``, one partial aggregation."""
    per = df.groupBy(key).agg(F.avg(difference).alias("d"))
    drawn = per.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).withColumn("u", hash_share(F.lit(seed), "draw", key))
    times = sum((F.when(F.col("u") >= s, 1).otherwise(0) for s in poisson_steps()), F.lit(0))
    means = drawn.withColumn("t", times).groupBy("draw").agg(ratio(F.sum(F.col("d") * F.col("t")), F.sum("t")).alias("m"))
    ends = means.agg(F.expr("percentile(m, 0.025)").alias("low"), F.expr("percentile(m, 0.975)").alias("high"), F.avg((F.col("m") > 0).cast("double")).alias("better"))
    whole = per.agg(F.count(F.lit(1)).alias("n"), F.avg("d").alias("mean"), (F.min("d") == F.max("d")).alias("degenerate"))
    return whole.crossJoin(ends).select("n", "mean", "low", "high", "better", "degenerate")  # one row each


def guarded_choice(variants: DataFrame, key: str, name: str, base: Column, metric: str, floors: dict[str, float], ceilings: dict[str, float]) -> DataFrame:
    """(key, chosen, metric, passing): of the variants that keep within tolerances of the key's base variant (not lower than it by more than ``floors``, not higher by
    more than ``ceilings``) the one with the least ``metric``, ties to the smaller name. ``base`` marks the base variant."""
    at = variants.groupBy(key).agg(*[F.max(F.when(base, F.col(c))).alias(f"__{c}") for c in (*floors, *ceilings)])
    ok = F.lit(True)
    for c, t in floors.items():
        ok = ok & (F.col(c) >= F.col(f"__{c}") - t)
    for c, t in ceilings.items():
        ok = ok & (F.col(c) <= F.col(f"__{c}") + t)
    good = variants.join(at, key).filter(ok)
    return good.groupBy(key).agg(F.min_by(name, F.struct(metric, name)).alias("chosen"), F.min(metric).alias(metric), F.count(F.lit(1)).alias("passing"))


def no_worse(before: DataFrame, after: DataFrame, key: str, protected: list[str], wanted: list[str]) -> DataFrame:
    """(key, accepted, regressed, improved): a trial is accepted if no count of the protected or wanted checks rises and one of the wanted falls."""
    j = before.join(after.withColumnsRenamed({c: f"__{c}" for c in (*protected, *wanted)}), key)
    step = lambda c: F.col(f"__{c}") - F.col(c)
    worse = sum(((step(c) > 0).cast("int") for c in (*protected, *wanted)), F.lit(0))
    better = sum(((step(c) < 0).cast("int") for c in wanted), F.lit(0))
    return j.select(key, ((worse == 0) & (better > 0)).alias("accepted"), worse.alias("regressed"), better.alias("improved"))


def paired_winner(base: DataFrame, trial: DataFrame, key: str, metric: str, lower_is_better: bool = True) -> DataFrame:
    """(key, base, trial, delta, winner) of the keys that both sides have."""
    j = base.select(key, F.col(metric).alias("base")).join(trial.select(key, F.col(metric).alias("trial")), key)
    delta = F.col("trial") - F.col("base")
    good = delta < 0 if lower_is_better else delta > 0
    return j.select(key, "base", "trial", delta.alias("delta"), F.when(delta == 0, "tie").when(good, "trial").otherwise("base").alias("winner"))
