"""More of the query catalogue: morphology, running totals over whole tables, class scores, seams, consensus, paired lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import grid, intervals, metrics, morphology, rails, sequences, spatial
from ..sources.tables import load, points, trajectory
from .catalogue import ISLANDS, P, SPANS, T, query, r, spans

CELLS = f"(SELECT DISTINCT floor(x / 2)::BIGINT AS cx, floor(y / 2)::BIGINT AS cy FROM {P} WHERE z >= 9)"
STEPS = "(SELECT i, j FROM (VALUES (-1), (0), (1)) a(i), (VALUES (-1), (0), (1)) b(j))"
CLOSED = f"""(SELECT e.cx, e.cy, c.cx IS NULL AS filled FROM (SELECT cx + i AS cx, cy + j AS cy FROM (SELECT DISTINCT cx + i AS cx, cy + j AS cy FROM {CELLS}, {STEPS}), {STEPS} GROUP BY 1, 2 HAVING count(*) = 9) e
LEFT JOIN {CELLS} c ON e.cx = c.cx AND e.cy = c.cy)"""


def high_cells(s, d) -> DataFrame:
    return grid.cell_stats(points(s, d).filter("z >= 9"), 2.0)


@query(f"SELECT cx, cy, filled FROM {CLOSED}")
def closed_cells(s, d) -> DataFrame:
    return morphology.closing(high_cells(s, d))


@query(f"""SELECT g.cx, g.cy, count(c.cx) / 8 AS rim FROM (SELECT cx, cy FROM {CLOSED} WHERE filled) g LEFT JOIN {CELLS} c ON abs(g.cx - c.cx) <= 1 AND abs(g.cy - c.cy) <= 1 GROUP BY 1, 2""")
def gap_rims(s, d) -> DataFrame:
    return morphology.gap_rims(high_cells(s, d))


@query(f"""WITH RECURSIVE i AS (SELECT (floor(x / 5)::BIGINT + 1000) * 100000 + floor(y / 5)::BIGINT AS id, floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, avg(z) AS h FROM {P} GROUP BY 1, 2, 3),
l AS (SELECT a.id AS a, b.id AS b FROM i a JOIN i b ON abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND abs(a.h - b.h) <= 0.25),
w(a, b) AS (SELECT id, id FROM i UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a)
SELECT component, count(*) AS cells FROM (SELECT a, min(b) AS component FROM w GROUP BY 1) GROUP BY 1""")
def level_regions(s, d) -> DataFrame:
    cells = grid.cell_stats(points(s, d), 5.0).select(((F.col("cx") + 1000) * 100000 + F.col("cy")).alias("id"), "cx", "cy", (F.col("total") / F.col("n")).alias("h"))
    return spatial.components(morphology.level_links(cells, "h", 0.25)).groupBy("component").agg(F.count(F.lit(1)).alias("cells"))


@query("""WITH q AS (SELECT row_number() OVER w AS i, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) OVER w AS e, count(*) OVER () AS n FROM lineitem WINDOW w AS (ORDER BY l_discount DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING))
SELECT count(*) AS n, round(avg(e / i), 4) AS aurc, round(max(e / i) FILTER (i = (n + 1) // 2), 4) AS risk_at_half FROM q""")
def selective_risk(s, d) -> DataFrame:
    rows = load(s, d, "lineitem").select("l_discount", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("right"))
    return metrics.selective_risk(rows, [F.col("l_discount").desc(), *map(F.col, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))], F.col("right")).select("n", r("aurc"), r("risk_at_half"))


GUESS = "CASE WHEN o_orderpriority < '2' THEN 'P' WHEN o_orderpriority < '4' THEN 'F' ELSE 'O' END"


@query(f"""WITH c AS (SELECT o_orderstatus AS t, {GUESS} AS g FROM orders), k AS (SELECT t AS class FROM c UNION SELECT g FROM c),
n AS (SELECT class, count(*) FILTER (t = class AND g = class) AS tp, count(*) FILTER (t <> class AND g = class) AS fp, count(*) FILTER (t = class AND g <> class) AS fn FROM c, k GROUP BY 1)
SELECT class, tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 4) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 4) AS recall,
round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END, 4) AS f1 FROM n""")
def class_scores(s, d) -> DataFrame:
    rows = load(s, d, "orders").select(F.col("o_orderstatus").alias("t"), F.expr(GUESS).alias("g"))
    return metrics.class_scores(rows, "t", "g").select("class", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


@query("""SELECT p_brand, p_size, count(*) AS n, round((min(rk) - 1 + (count(*) - 1) / 2) / nullif(min(total) - 1, 0), 4) AS rank_share FROM
(SELECT p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS rk, count(*) OVER (PARTITION BY p_brand) AS total FROM part) GROUP BY 1, 2""")
def tied_rank_share(s, d) -> DataFrame:
    return metrics.tied_rank_share(load(s, d, "part"), "p_brand", "p_size").select("p_brand", "p_size", "n", r("rank_share"))


@query(f"""WITH g AS (SELECT user_id, max(greatest(0, b - before)) AS largest_gap FROM (SELECT user_id, b, lag(e) OVER (PARTITION BY user_id ORDER BY b, e) AS before FROM {SPANS}) GROUP BY 1),
u AS (SELECT user_id, max(stop - start) AS longest_span FROM {ISLANDS} GROUP BY 1)
SELECT g.user_id, round(coalesce(largest_gap, 0), 4) AS largest_gap, round(longest_span, 4) AS longest_span FROM g JOIN u ON g.user_id = u.user_id""")
def interval_gap_extremes(s, d) -> DataFrame:
    rows = spans(s, d)
    step = F.col("b") - F.lag("e").over(Window.partitionBy("user_id").orderBy("b", "e"))
    gaps = rows.withColumn("gap", F.greatest(F.lit(0.0), step)).groupBy("user_id").agg(F.coalesce(F.max("gap"), F.lit(0.0)).alias("largest_gap"))
    union = intervals.islands(rows, "user_id", [], "b", "e").groupBy("user_id").agg(F.max(F.col("stop") - F.col("start")).alias("longest_span"))
    return gaps.join(union, "user_id").select("user_id", r("largest_gap"), r("longest_span"))


@query(f"""SELECT user_id, island AS gap, round(stop, 4) AS start, round(nxt, 4) AS stop FROM (SELECT user_id, island::BIGINT AS island, stop, lead(start) OVER (PARTITION BY user_id ORDER BY start) AS nxt FROM {ISLANDS}) WHERE nxt - stop <= 86400""")
def inferred_gaps(s, d) -> DataFrame:
    held = intervals.islands(spans(s, d), "user_id", [], "b", "e")
    nxt = F.lead("start").over(Window.partitionBy("user_id").orderBy("start"))
    return held.withColumn("nxt", nxt).filter("nxt - stop <= 86400").select("user_id", F.col("island").alias("gap"), r("stop", "start"), r("nxt", "stop"))


@query(f"""SELECT user_id, event_id, round(CASE WHEN abs(position - p) <= 5 THEN (position + p) / 2 ELSE position END, 4) AS start_value, round(CASE WHEN abs(position - q) <= 5 THEN (position + q) / 2 ELSE position END, 4) AS end_value
FROM (SELECT *, lag(position) OVER w AS p, lead(position) OVER w AS q FROM {T} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def seam_midpoints(s, d) -> DataFrame:
    return sequences.seam_midpoints(trajectory(s, d), "user_id", ["ts", "event_id"], "position", 5.0).select("user_id", "event_id", r("start_value"), r("end_value"))


@query("""WITH b AS (SELECT event_type, floor(value / 10)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
k AS (SELECT event_type, unnest(range(lo, hi + 1)) AS bin FROM (SELECT event_type, min(bin) AS lo, max(bin) AS hi FROM b GROUP BY 1))
SELECT k.event_type, count(*) AS bins, count(b.bin) AS filled, max(coalesce(n, 0)) AS most, min(coalesce(n, 0)) AS least FROM k LEFT JOIN b ON k.event_type = b.event_type AND k.bin = b.bin GROUP BY 1""")
def station_bins(s, d) -> DataFrame:
    bins = load(s, d, "events").filter("value is not null").groupBy("event_type", F.floor(F.col("value") / 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = bins.groupBy("event_type").agg(F.min("bin").alias("lo"), F.max("bin").alias("hi")).select("event_type", F.explode(F.sequence("lo", "hi")).alias("bin"))
    n = F.coalesce("n", F.lit(0))
    return every.join(bins, ["event_type", "bin"], "left").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("bins"), F.count("n").alias("filled"), F.max(n).alias("most"), F.min(n).alias("least"))


@query("""SELECT degree, count(*) AS nodes FROM (SELECT node, count(*) AS degree FROM (SELECT 's' || l_suppkey AS node FROM lineitem UNION ALL SELECT 'p' || l_partkey FROM lineitem) GROUP BY 1) GROUP BY 1""")
def node_degrees(s, d) -> DataFrame:
    ends = load(s, d, "lineitem").select(F.explode(F.array(F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey"))).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"SELECT x, round(y) AS y, round(max(z), 4) AS top, arg_min(row_key, (-z, row_key)) AS row_key FROM {P} GROUP BY 1, 2")
def top_envelope(s, d) -> DataFrame:
    p = points(s, d)
    return p.groupBy("x", F.round("y").alias("y")).agg(r(F.max("z"), "top"), F.min_by("row_key", F.struct(-F.col("z"), F.col("row_key"))).alias("row_key"))


@query("""WITH l AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS ok, bool_or(l_linestatus = 'F') AS assigned FROM lineitem GROUP BY 1)
SELECT CASE WHEN ok THEN 'correct' WHEN assigned THEN 'assigned' WHEN l_orderkey IS NOT NULL THEN 'detected' ELSE 'undetected' END AS route, count(*) AS n FROM orders LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY 1""")
def decision_routes(s, d) -> DataFrame:
    found = load(s, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("ok"), F.bool_or(F.col("l_linestatus") == "F").alias("assigned"))
    rows = load(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")).join(found.withColumn("seen", F.lit(True)), "l_orderkey", "left")
    route = F.when(F.col("ok"), "correct").when(F.col("assigned"), "assigned").when(F.col("seen"), "detected").otherwise("undetected")
    return rows.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT p_brand, p_type, max(p_retailprice) AS v FROM part WHERE p_size >= 5 GROUP BY 1, 2)
SELECT p_brand, count(*) AS configurations, round(quantile_cont(v, 0.5), 4) AS consensus, round(max(v) - min(v), 4) AS spread, count(*) >= 3 AND max(v) - min(v) <= 900 AS accepted FROM b GROUP BY 1""")
def configuration_consensus(s, d) -> DataFrame:
    best = load(s, d, "part").filter("p_size >= 5").groupBy("p_brand", "p_type").agg(F.max("p_retailprice").alias("v"))
    out = best.groupBy("p_brand").agg(F.count(F.lit(1)).alias("configurations"), r(F.expr("percentile(v, 0.5)"), "consensus"), (F.max("v") - F.min("v")).alias("spread"))
    return out.select("p_brand", "configurations", "consensus", r("spread"), ((F.col("configurations") >= 3) & (F.col("spread") <= 900)).alias("accepted"))


@query()
def paired_lines(s, d) -> DataFrame:
    p = points(s, d).select(F.col("source").alias("segment_id"), "x", "y", "z")
    found = rails.detect_pairs(p, step=1.0, width=1.0, low=0.0, high=10.0, support=0.3, spacing=10.0, off=5.0, joint=0.2)
    return found.select("segment_id", "a", "b", r("spacing"), r("joint"), "gap")
