"""Queries that choose recoveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.recovery import Check, select_recoveries
from ..sources.tables import load
from .catalogue import query

CHECKS = [
    Check("pair", own=lambda v: ~v["pair"]),
    Check("gauge", own=lambda v: F.abs(v["gauge"] - 5) > 3),
    Check("seam_gauge", seam=lambda a, b: F.abs(a["gauge"] - b["gauge"]) > 4),
    Check("seam_height", seam=lambda a, b: F.abs(a["height"] - b["height"]) > 15, protected=True),
]


def seams(column: str, limit: int, version: str) -> str:
    return f"(CASE WHEN abs(p.{column} - n.{version}_{column}) > {limit} THEN 1 ELSE 0 END + CASE WHEN abs(n.{version}_{column} - n.next_{column}) > {limit} THEN 1 ELSE 0 END)"


DELTAS = f"""SELECT n.*, CASE WHEN n.t_pair THEN 0 ELSE 1 END - CASE WHEN n.b_pair THEN 0 ELSE 1 END AS d1, CASE WHEN abs(n.t_gauge - 5) > 3 THEN 1 ELSE 0 END - CASE WHEN abs(n.b_gauge - 5) > 3 THEN 1 ELSE 0 END AS d2,
{seams('gauge', 4, 't')} - {seams('gauge', 4, 'b')} AS d3, {seams('height', 15, 't')} - {seams('height', 15, 'b')} AS d4 FROM w p JOIN s n ON n.supplier = p.supplier AND n.i = p.i + 1"""


@query(f"""WITH RECURSIVE s AS MATERIALIZED (SELECT l_suppkey AS supplier, l_orderkey AS order_key, l_linenumber AS line, row_number() OVER k AS i, l_returnflag <> 'R' AS b_pair, round(l_discount * 100)::BIGINT AS b_gauge, l_quantity::BIGINT AS b_height,
l_returnflag = 'R' OR l_linenumber = 1 AS has, l_partkey % 4 <> 0 AS t_pair, round(l_tax * 100)::BIGINT AS t_gauge, (l_quantity::BIGINT + l_partkey % 21 - 10) AS t_height, lead(round(l_discount * 100)::BIGINT) OVER k AS next_gauge, lead(l_quantity::BIGINT) OVER k AS next_height FROM lineitem
WINDOW k AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)),
w(supplier, i, gauge, height, order_key, line, has, accepted, d1, d2, d3, d4) AS (SELECT DISTINCT supplier, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, false, false, 0, 0, 0, 0 FROM s UNION ALL
SELECT supplier, i, CASE WHEN a THEN t_gauge ELSE b_gauge END, CASE WHEN a THEN t_height ELSE b_height END, order_key, line, has, a, d1, d2, d3, d4 FROM (SELECT *, has AND greatest(d1, d2, d3, d4) <= 0 AND least(d1, d2, d3) < 0 AS a FROM ({DELTAS})))
SELECT supplier, order_key, line::BIGINT AS line, accepted, CASE WHEN accepted THEN '' WHEN greatest(d1, d2, d3, d4) <= 0 THEN 'none_improved' ELSE concat_ws(',', CASE WHEN d2 > 0 THEN 'gauge' END, CASE WHEN d1 > 0 THEN 'pair' END, CASE WHEN d3 > 0 THEN 'seam_gauge' END, CASE WHEN d4 > 0 THEN 'seam_height' END) END AS reasons,
d1::BIGINT AS delta_pair, d2::BIGINT AS delta_gauge, d3::BIGINT AS delta_seam_gauge, d4::BIGINT AS delta_seam_height FROM w WHERE has""")
def recovery_selection(s, d) -> DataFrame:
    """Line items as segments along their supplier, those returned or first of their order with a trial: which trials are taken, one after the other, and why others are not."""
    c = F.col
    shape = lambda pair, gauge, height: F.struct(pair.alias("pair"), F.round(gauge * 100).cast("long").alias("gauge"), height.cast("long").alias("height"))
    moved = c("l_quantity").cast("long") + c("l_partkey") % 21 - 10
    rows = load(s, d, "lineitem").select(
        c("l_suppkey").alias("supplier"), c("l_orderkey").alias("order_key"), c("l_linenumber").cast("long").alias("line"), "l_partkey", "l_extendedprice", shape(c("l_returnflag") != "R", c("l_discount"), c("l_quantity")).alias("base"),
        F.when((c("l_returnflag") == "R") | (c("l_linenumber") == 1), shape(c("l_partkey") % 4 != 0, c("l_tax"), moved)).alias("trial"))
    out = select_recoveries(rows, "supplier", ["order_key", "line", "l_partkey", "l_extendedprice"], CHECKS)
    return out.select("supplier", "order_key", "line", "accepted", F.concat_ws(",", "reasons").alias("reasons"), *[c(f"delta_{k.name}").cast("long").alias(f"delta_{k.name}") for k in CHECKS])
