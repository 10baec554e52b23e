"""Queries of optimal one-to-one assignment. On a line an assignment of most pairs and least distance exists that keeps both orders, so SQL finds its size and total by going over
one side row by row; which of several such assignments is taken is open, and queries that depend on it have no SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import matching
from ..sources.tables import load
from .catalogue import query, r
from .evaluation import FOUND, TRUTH, sides


def totals_sql(left: str, right: str, most: float) -> str:
    """Per block the number of pairs and the least total of distances, by scores of a million a pair less the distance."""
    return f"""WITH RECURSIVE a AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY block ORDER BY center, id) AS i FROM {left}), b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY block ORDER BY center, id) AS j FROM {right}),
n AS (SELECT block, max(i) AS n FROM a GROUP BY block),
g(block, i, j, s) AS (SELECT block, 0::BIGINT, 0::BIGINT, 0::DOUBLE FROM n UNION ALL SELECT b.block, 0, j, 0 FROM b JOIN n USING (block)
UNION ALL SELECT block, i + 1, j, max(v) OVER (PARTITION BY block ORDER BY j) FROM (SELECT g.block, g.i, g.j, greatest(g.s, CASE WHEN abs(a.center - b.center) <= {most} THEN g.p + 1000000 - abs(a.center - b.center) END) AS v
  FROM (SELECT *, lag(s) OVER (PARTITION BY block ORDER BY j) AS p FROM g) g JOIN a ON a.block = g.block AND a.i = g.i + 1 LEFT JOIN b ON b.block = g.block AND b.j = g.j) x)
SELECT block, ceil(max(s) / 1000000)::BIGINT AS n_pairs, round(ceil(max(s) / 1000000) * 1000000 - max(s), 4) AS total FROM g JOIN n USING (block) WHERE g.i = n.n GROUP BY block"""


def totals(left: DataFrame, right: DataFrame, most: float) -> DataFrame:
    pairs = matching.assign_on_line(left, right, most)
    return matching.block_totals(left, pairs).select("block", "n_pairs", r("total"))


@query(totals_sql(TRUTH, FOUND, 400))
def asset_assignment(s, d) -> DataFrame:
    t, f, _ = sides(s, d)
    return totals(t, f, 400.0)


@query()
def asset_matching_v2(s, d) -> DataFrame:
    """Detection and types after the optimal assignment of findings to truth."""
    t, f, _ = sides(s, d)
    pairs = matching.assign_on_line(t, f, 400.0).select(F.col("left").alias("truth_id"), F.col("right").alias("found_id"))
    return ev.matched_scores(t, f, pairs).select("label", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


PARTS = "(SELECT p_partkey AS id, p_type AS block, p_retailprice AS center FROM part WHERE p_partkey % 2 = {k})"


def parts(s, d, k: int) -> DataFrame:
    return load(s, d, "part").filter(F.col("p_partkey") % 2 == k).select(F.col("p_partkey").alias("id"), F.col("p_type").alias("block"), F.col("p_retailprice").alias("center"))


@query(totals_sql(PARTS.format(k=0), PARTS.format(k=1), 15))
def holdout_line_match(s, d) -> DataFrame:
    """Prices of even parts, as lines found, against those held out, the odd parts of the same type."""
    return totals(parts(s, d, 0), parts(s, d, 1), 15.0)


SEAM = "(SELECT c_custkey AS id, c_nationkey + {k} AS block, c_acctbal AS center FROM customer)"


def seam(s, d, k: int) -> DataFrame:
    return load(s, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") + k).alias("block"), F.col("c_acctbal").alias("center"))


@query(totals_sql(SEAM.format(k=0), SEAM.format(k=1), 60))
def seam_pair_assignment(s, d) -> DataFrame:
    """Balances on both sides of the seams between neighbouring nations."""
    return totals(seam(s, d, 0), seam(s, d, 1), 60.0)


@query()
def boundary_warp(s, d) -> DataFrame:
    """Line items of even parts as lines that run up to a seam with the odd parts of their type: paired ends meet halfway, by a smoothstep over the last 20 quantities and at most by 4."""
    left, right = parts(s, d, 0), parts(s, d, 1)
    pairs = matching.assign_on_line(left, right, 15.0)
    ends = pairs.join(left.select(F.col("id").alias("left"), F.col("center").alias("end_cross")), "left").join(right.select(F.col("id").alias("right"), F.col("center").alias("other_cross")), "right")
    items = load(s, d, "lineitem").filter("l_partkey % 2 = 0").select(F.col("l_partkey").alias("line"), (F.col("l_quantity") - 50).alias("station"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("cross"))
    warped = matching.seam_warp(items, ends.withColumnRenamed("left", "line"), 20.0, 4.0)
    move = F.col("warped") - F.col("cross")
    return warped.groupBy("line").agg(F.count(F.lit(1)).alias("n"), r(F.max(F.abs(move)), "largest"), r(F.max(F.when(F.col("station") == 0, F.abs(move))), "at_seam"))
