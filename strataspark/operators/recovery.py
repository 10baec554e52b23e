"""Recoveries taken one after the other only where no check gets worse, decided for all segments at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


@dataclass(frozen=True)
class Check:
    """A check that fails a segment (``own``, of its values) or a seam (``seam``, of the values before and after it); ``protected`` ones must not fail more often, others are hoped to improve."""

    name: str
    own: Callable[[Column], Column] | None = None
    seam: Callable[[Column, Column], Column] | None = None
    protected: bool = False


def failures(check: Check, before: Column, at: Column, after: Column) -> Column:
    """How often a check fails on a segment and its two seams; an undefined check does not fail."""
    one = lambda fails: F.when(fails, 1).otherwise(0)
    own = one(check.own(at)) if check.own else F.lit(0)
    return own + one(before.isNotNull() & check.seam(before, at)) + one(after.isNotNull() & check.seam(at, after)) if check.seam else own


def select_recoveries(segments: DataFrame, key: str, order: list[str], checks: list[Check]) -> DataFrame:
    """``segments`` (key, order, base, trial: structs of values, trial null where there is none) that have a trial, with ``accepted``, ``reasons`` (sorted names of checks that get worse, or
    ``none_improved``) and ``delta_<check>``.

    Trials are taken in order. One is accepted if, beside what was accepted before it, no check fails more often and one that is not protected fails less often. A trial touches its own segment and two
    seams alone, so its answer depends on whether the one before was accepted: each row has an answer for both, and answers are composed along the order. A row whose two answers are equal
    settles what follows; between such rows only flips are counted. So no trial waits for the audit of another, and the whole is one window by key. Rows with a null key take no part;
    ``order`` should be unique in a key, of which one task sorts the rows.
    """
    w = Window.partitionBy(key).orderBy(*order)
    rows = segments.filter(c(key).isNotNull()).withColumns({"__b": F.lag("base").over(w), "__t": F.lag("trial").over(w), "__n": F.lead("base").over(w)})
    for state, before in ((0, c("__b")), (1, F.coalesce(c("__t"), c("__b")))):
        rows = rows.withColumns({f"__d{state}{i}": failures(k, before, c("trial"), c("__n")) - failures(k, before, c("base"), c("__n")) for i, k in enumerate(checks)})
        better = F.lit(False)
        worse = F.lit(False)
        for i, k in enumerate(checks):
            worse = worse | (c(f"__d{state}{i}") > 0)
            better = better if k.protected else better | (c(f"__d{state}{i}") < 0)
        rows = rows.withColumn(f"__a{state}", c("trial").isNotNull() & ~worse & better)
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    settled = (c("__a0") == c("__a1")) | c("__t").isNull()  # no trial before: it was not accepted
    rows = rows.withColumn("__f", F.sum(F.when(~settled & c("__a0"), 1).otherwise(0)).over(to_here))
    rows = rows.withColumn("__s", F.last(F.when(settled, F.struct(c("__a0").cast("int").alias("v"), "__f")), ignorenulls=True).over(to_here))
    rows = rows.withColumn("accepted", (c("__s.v") + c("__f") - c("__s.__f")) % 2 == 1)
    rows = rows.withColumn("__was", F.coalesce(F.lag("accepted").over(w), F.lit(False))).filter(c("trial").isNotNull())
    rows = rows.withColumns({f"delta_{k.name}": F.when(c("__was"), c(f"__d1{i}")).otherwise(c(f"__d0{i}")) for i, k in enumerate(checks)})
    worse = F.array_sort(F.array_compact(F.array(*[F.when(c(f"delta_{k.name}") > 0, F.lit(k.name)) for k in checks])))
    reasons = F.when(c("accepted"), F.array().cast("array<string>")).when(F.size(worse) > 0, worse).otherwise(F.array(F.lit("none_improved")))
    return rows.withColumn("reasons", reasons).select(*segments.columns, "accepted", "reasons", *[f"delta_{k.name}" for k in checks])
