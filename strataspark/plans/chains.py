"""Queries that chain operators: candidates, surfaces, gap audits, support, small assets, alignment, reviews and regressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chains as ch
from ..sources.tables import load, points
from .catalogue import P, V, places, query, r
from .frames import BOX, candidates
from .planning import HASH, TRI

COLS = f"(SELECT floor(x / 2)::BIGINT AS cx, floor(y / 2)::BIGINT AS cy, count(*) AS n, min(z) AS low, max(z) AS high, count(DISTINCT floor(z)) / (floor(max(z)) - floor(min(z)) + 1) AS ratio FROM {P} WHERE class = 'A' GROUP BY 1, 2 HAVING count(*) >= 3 AND max(z) - min(z) >= 6)"
CELL = "((cx + 1048576) * 2097152 + cy + 1048576)::BIGINT"


def closure(rows: str, near: str) -> str:
    """SQL of (id, component) of rows (id, ...) that ``near`` (over a and b) links."""
    return f"(WITH RECURSIVE i AS MATERIALIZED (SELECT * FROM {rows}), l AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM i a JOIN i b ON {near}), w(a, b) AS (SELECT id, id FROM i UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a) SELECT a AS id, min(b) AS component FROM w GROUP BY 1)"


LCELLS = f"(SELECT *, {CELL} AS id FROM {COLS} WHERE ratio >= 0.2)"


@query(f"""SELECT component, count(*) AS cells, sum(n)::BIGINT AS n, min(cx) * 2.0 AS x0, (max(cx) + 1) * 2.0 AS x1, min(cy) * 2.0 AS y0, (max(cy) + 1) * 2.0 AS y1, round(min(low), 4) AS low, round(max(high), 4) AS high
FROM {LCELLS} c JOIN {closure(LCELLS, 'abs(a.cx - b.cx) + abs(a.cy - b.cy) <= 3')} k ON k.id = c.id GROUP BY 1""")
def linear_candidates(s, d) -> DataFrame:
    out = ch.linear_candidates(points(s, d).filter("class = 'A'"), 2.0, 3, 6.0, 1.0, 0.2)
    return out.select("component", "cells", "n", "x0", "x1", "y0", "y1", r("low"), r("high"))


FLAT = f"(SELECT *, {CELL} AS id FROM (SELECT floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, count(*) AS n, quantile_cont(z, 0.5) AS z, quantile_cont(z, 0.9) - quantile_cont(z, 0.1) AS wide FROM {P} GROUP BY 1, 2 HAVING count(*) >= 5) WHERE wide <= 7.8)"
SURF = f"(SELECT c.*, (cx + 0.5) * 5 AS x, (cy + 0.5) * 5 AS y, component FROM {FLAT} c JOIN {closure(FLAT, 'abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND abs(a.z - b.z) <= 0.45')} k ON k.id = c.id)"


@query(f"""WITH m AS (SELECT component, count(*) AS k, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS sxx, var_pop(y) AS syy, covar_pop(x, y) AS sxy, covar_pop(x, z) AS sxz, covar_pop(y, z) AS syz FROM {SURF} GROUP BY 1),
f AS (SELECT component, (sxz * syy - syz * sxy) / det AS a, (syz * sxx - sxz * sxy) / det AS b, mz - (sxz * syy - syz * sxy) / det * mx - (syz * sxx - sxz * sxy) / det * my AS c FROM (SELECT *, sxx * syy - sxy * sxy AS det FROM m WHERE k >= 3) WHERE det > 1e-6)
SELECT u.component, count(*) AS cells, sum(n)::BIGINT AS n, round(any_value(a), 4) AS a, round(any_value(b), 4) AS b, round(sqrt(avg((z - a * x - b * y - c) ** 2)), 4) AS rms FROM {SURF} u LEFT JOIN f ON f.component = u.component GROUP BY 1""")
def platform_surfaces(s, d) -> DataFrame:
    return ch.platform_surfaces(points(s, d), 5.0, 5, 7.8, 0.45).select("component", "cells", "n", r("a"), r("b"), r("rms"))


GCOLS = COLS.replace("WHERE class = 'A' ", "").replace(">= 3 AND", ">= 4 AND")


@query(f"""WITH c AS (SELECT *, {CELL} AS id FROM {GCOLS}), g AS (SELECT c.id, b.box_id, sqrt(greatest(0, cx * 2 - x1, x0 - (cx + 1) * 2) ** 2 + greatest(0, cy * 2 - y1, y0 - (cy + 1) * 2) ** 2 + greatest(0, low - z1, z0 - high) ** 2) AS gap FROM c JOIN {BOX} b ON cx * 2 - 1 <= x1 AND x0 <= (cx + 1) * 2 + 1 AND cy * 2 - 1 <= y1 AND y0 <= (cy + 1) * 2 + 1),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, box_id) AS rn FROM g WHERE gap <= 1), e AS (SELECT min(x) + 8 AS lo, max(x) - 8 AS hi FROM {P}), q AS (SELECT c.*, k.box_id AS nearest, k.gap, CASE WHEN (cx + 0.5) * 2 < lo THEN 'previous' WHEN (cx + 0.5) * 2 > hi THEN 'next' ELSE 'within' END AS scope FROM e, c LEFT JOIN k ON k.id = c.id AND rn = 1 WHERE k.box_id IS NULL OR k.gap > 0)
SELECT cx, cy, n, round(high - low, 4) AS height, nearest, round(gap, 4) AS gap, scope, CASE WHEN scope <> 'within' THEN 'P3' WHEN high - low >= 8 AND n >= 12 THEN 'P0' WHEN high - low >= 7 THEN 'P1' ELSE 'P2' END AS priority FROM q""")
def cloud_model_gap_audit(s, d) -> DataFrame:
    p = points(s, d)
    limits = p.agg((F.min("x") + 8).alias("low_x"), (F.max("x") - 8).alias("high_x"))
    out = ch.gap_candidates(p, candidates(s, d).select("box_id", "x0", "x1", "y0", "y1", "z0", "z1"), 2.0, 4, 6.0, 1.0, 1.0, limits)
    return out.select("cx", "cy", "n", r("height"), "nearest", r("gap"), "scope", "priority")


RED = f"(SELECT row_key * 1000000 + part_key AS id, x, y, z FROM {P} WHERE class = 'R' AND z >= 9.5)"
SAMPLE = f"""(SELECT id * 100000 + k AS id, ax + ra * (1 - rb) * (bx - ax) + ra * rb * (cx - ax) AS x, ay + ra * rb * (cy - ay) AS y, az + ra * rb * (cz - az) AS z FROM (SELECT *, sqrt({HASH.format(p="3, id, k, 'a'")}) AS ra, {HASH.format(p="3, id, k, 'b'")} AS rb FROM (SELECT *, unnest(range(1, ceil(round(area * 0.3, 6))::BIGINT + 1)) AS k FROM {TRI})))"""


@query(f"""WITH n AS (SELECT s.id, min(sqrt((s.x - p.x) ** 2 + (s.y - p.y) ** 2 + (s.z - p.z) ** 2)) AS d FROM {SAMPLE} s, {RED} p GROUP BY 1)
SELECT count(*) AS samples, round(avg(d), 4) AS mean, round(quantile_cont(d, 0.5), 4) AS p50, round(quantile_cont(d, 0.9), 4) AS p90, round(avg(CASE WHEN d <= 5 THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM n""")
def model_point_support(s, d) -> DataFrame:
    c = F.col
    tri = candidates(s, d).select(c("box_id").alias("id"), *[c(f"{a}{int(k == 'b' and a == 'x' or k == 'c' and a != 'x')}").alias(f"{k}{a}") for k in "abc" for a in "xyz"])
    p = points(s, d).filter("class = 'R' and z >= 9.5").select((c("row_key") * 1000000 + c("part_key")).alias("id"), "x", "y", "z")
    return ch.model_support(tri, p, 0.3, 3, 4.0, 5.0).select("samples", r("mean"), r("p50"), r("p90"), r("coverage"))


@query(f"""WITH n AS (SELECT 'a_to_b' AS side, a.id, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) AS d FROM {V} a, {V} b WHERE a.id % 3 = 0 AND b.id % 3 <> 0 GROUP BY 1, 2 UNION ALL SELECT 'b_to_a', b.id, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) FROM {V} a, {V} b WHERE a.id % 3 = 0 AND b.id % 3 <> 0 GROUP BY 1, 2)
SELECT side, count(*) AS n, round(quantile_cont(d, 0.5), 6) AS p50, round(quantile_cont(d, 0.9), 6) AS p90, round(max(d), 6) AS most FROM n GROUP BY 1""")
def seam_distances(s, d) -> DataFrame:
    p = places(s, d)
    out = ch.seam_distances(p.filter("id % 3 = 0"), p.filter("id % 3 <> 0"), 0.05)
    return out.select("side", "n", *[F.round(k, 6).alias(k) for k in ("p50", "p90", "most")])


LOW = f"(SELECT * FROM {P} WHERE class = 'N' AND x IN (3, 4, 17, 30) AND z < 3)"
SVOX = f"(SELECT *, ((vx + 1048576) * 4398046511104 + (vy + 1048576) * 2097152 + vz + 1048576)::BIGINT AS id FROM (SELECT floor(x / 1.5)::BIGINT AS vx, floor(y / 1.5)::BIGINT AS vy, floor(z / 1.5)::BIGINT AS vz, count(*) AS n, sum((z < 1)::INT) AS g FROM {LOW} GROUP BY 1, 2, 3))"


@query(f"""WITH g AS (SELECT component, count(*) AS voxels, sum(n)::BIGINT AS n, sum(g) AS g, {', '.join(f'min(v{a}) * 1.5 AS {a}0, (max(v{a}) + 1) * 1.5 AS {a}1' for a in 'xyz')} FROM {SVOX} v JOIN {closure(SVOX, 'abs(a.vx - b.vx) <= 1 AND abs(a.vy - b.vy) <= 1 AND abs(a.vz - b.vz) <= 1')} k ON k.id = v.id GROUP BY 1),
t AS (SELECT DISTINCT component FROM g JOIN {BOX} b ON sqrt(greatest(0, g.x0 - b.x1, b.x0 - g.x1) ** 2 + greatest(0, g.y0 - b.y1, b.y0 - g.y1) ** 2 + greatest(0, g.z0 - b.z1, b.z0 - g.z1) ** 2) <= 0.7)
SELECT component, voxels, n, CASE WHEN n < 3 THEN 'too_small' WHEN greatest(x1 - x0, y1 - y0, z1 - z0) > 30 THEN 'too_large' WHEN component IN (SELECT component FROM t) THEN 'existing_residual' WHEN g * 2 > n THEN 'vegetation' ELSE 'candidate' END AS kind FROM g""")
def small_asset_rescan(s, d) -> DataFrame:
    p = points(s, d).filter("class = 'N' and x in (3, 4, 17, 30) and z < 3")
    return ch.small_assets(p, candidates(s, d).select("box_id", "x0", "x1", "y0", "y1", "z0", "z1"), 1.5, 1, 3, 30.0, 0.7, F.col("z") < 1)


@query(f"""WITH m AS (SELECT part_key, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS sxx, var_pop(y) AS syy, covar_pop(x, y) AS sxy, covar_pop(x, z) AS sxz, covar_pop(y, z) AS syz FROM {P} GROUP BY 1 HAVING count(*) >= 3), f AS (SELECT *, (sxz * syy - syz * sxy) / det AS a, (syz * sxx - sxz * sxy) / det AS b FROM (SELECT *, sxx * syy - sxy * sxy AS det FROM m) WHERE det > 1e-6),
q AS (SELECT p.part_key, count(*) AS n, any_value(a) AS a, any_value(b) AS b, quantile_cont(abs(z - a * x - b * y - (mz - a * mx - b * my)), 0.9) AS p90 FROM {P} p JOIN f ON f.part_key = p.part_key GROUP BY 1) SELECT part_key, n, round(a, 4) + 0 AS a, round(b, 4) + 0 AS b, round(p90, 4) AS p90, CASE WHEN p90 <= 4.5 THEN 'planar' WHEN p90 <= 5 THEN 'shallow' ELSE 'curved' END AS shape FROM q""")
def surface_shapes(s, d) -> DataFrame:
    return ch.plane_shape(points(s, d).select("part_key", "x", "y", "z"), "part_key", 4.5, 5.0).select("part_key", "n", (F.round("a", 4) + 0).alias("a"), (F.round("b", 4) + 0).alias("b"), r("p90"), "shape")


@query(f"""WITH c AS (SELECT kind, x0 AS s, y0 AS c FROM {BOX} WHERE p_size % 2 = 0), q AS (SELECT kind, x0 + 0.25 AS u, y0 + p_size % 3 AS v FROM {BOX} WHERE p_size % 2 = 1), j AS (SELECT q.*, v - c AS e, row_number() OVER (PARTITION BY q.kind, u, v ORDER BY abs(u - s), s, c) AS rn, abs(u - s) AS d FROM q JOIN c ON c.kind = q.kind AND floor(c.s / 3) - floor(u / 3) BETWEEN -1 AND 1),
n AS (SELECT kind, e, quantile_cont(e, 0.5) OVER (PARTITION BY kind) AS m FROM j WHERE rn = 1 AND d <= 3 AND e BETWEEN -20 AND 20) SELECT kind, count(*) AS matches, round(any_value(m), 4) AS delta, round(quantile_cont(abs(e - m), 0.5), 4) AS mad, count(*) >= 3 AND quantile_cont(abs(e - m), 0.5) <= 7.4 AS coherent FROM n GROUP BY 1""")
def row_alignment(s, d) -> DataFrame:
    c, b = F.col, candidates(s, d)
    cols = b.filter("p_size % 2 = 0").select("kind", c("x0").alias("s"), c("y0").alias("c"))
    cand = b.filter("p_size % 2 = 1").select("kind", (c("x0") + 0.25).alias("s"), (c("y0") + c("p_size") % 3).alias("c")).distinct()
    return ch.row_alignment(cols, cand, "kind", 3.0, -20.0, 20.0, 3, 7.4).select("kind", "matches", r("delta"), r("mad"), "coherent")


@query(f"""WITH g AS (SELECT part_key, floor(y / 8)::BIGINT AS lv, min(abs(z - 5)) <= 0.5 AS ok FROM {P} GROUP BY 1, 2), q AS (SELECT *, sum(ok::INT) OVER (PARTITION BY part_key ORDER BY lv) AS run FROM g), k AS (SELECT part_key, run, count(*) FILTER (NOT ok) AS f FROM q GROUP BY 1, 2), m AS (SELECT part_key, max(f) AS longest FROM k GROUP BY 1)
SELECT g.part_key, count(*) AS levels, count(*) FILTER (ok) AS seen, any_value(longest) AS longest, CASE WHEN avg(ok::INT) >= 0.4 THEN 'confirmed' WHEN avg(ok::INT) > 0 THEN 'partial' ELSE 'unseen' END AS decision FROM g JOIN m ON m.part_key = g.part_key GROUP BY 1""")
def level_visibility(s, d) -> DataFrame:
    p = points(s, d).select("part_key", F.floor(F.col("y") / 8).alias("lv"), F.abs(F.col("z") - 5).alias("d"))
    return ch.levels_visible(p, "part_key", "lv", "d", 0.5, 0.4)


@query("""SELECT p_partkey, p_brand AS class, p_size / 50 AS score, r.decision AS review, CASE WHEN r.decision IS NOT NULL THEN r.decision = 'accepted' ELSE p_size / 50 >= 0.6 END AS seed FROM part LEFT JOIN (SELECT l_partkey, max(CASE WHEN l_tax < 0.04 THEN 'accepted' ELSE 'rejected' END) AS decision FROM lineitem WHERE l_quantity > 48 GROUP BY 1) r ON r.l_partkey = p_partkey""")
def reviewed_overlay(s, d) -> DataFrame:
    rev = load(s, d, "lineitem").filter("l_quantity > 48").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max(F.when(F.col("l_tax") < 0.04, "accepted").otherwise("rejected")).alias("decision"))
    pred = load(s, d, "part").select("p_partkey", F.col("p_brand").alias("class"), (F.col("p_size") / 50).alias("score"))
    return ch.overlaid(pred, rev, "p_partkey", 0.6).select("p_partkey", "class", "score", "review", "seed")


@query(f"""WITH q AS (SELECT part_key, floor(x / 3)::BIGINT AS b, quantile_cont(y, 0.5) AS c, quantile_cont(z, 0.5) AS h FROM {P} GROUP BY 1, 2), m AS (SELECT *, CASE WHEN abs(b - lag(b) OVER w) > 1 OR abs(c - lag(c) OVER w) > 30 OR abs(h - lag(h) OVER w) > 3.25 THEN 1 ELSE 0 END AS new FROM q WINDOW w AS (PARTITION BY part_key ORDER BY b)),
g AS (SELECT part_key, run, count(*) AS m FROM (SELECT part_key, sum(new) OVER (PARTITION BY part_key ORDER BY b) AS run FROM m) GROUP BY 1, 2) SELECT part_key, count(*) AS runs, count(*) FILTER (m > 1) AS kept, count(*) FILTER (m = 1) AS dropped, count(*) - 1 AS splits FROM g GROUP BY 1""")
def profile_runs(s, d) -> DataFrame:
    q = points(s, d).groupBy("part_key", F.floor(F.col("x") / 3).alias("b")).agg(F.percentile("y", 0.5).alias("c"), F.percentile("z", 0.5).alias("h"))
    return ch.profile_runs(q, "part_key", "b", "c", "h", 1, 30.0, 3.25)


@query(f"""WITH q AS (SELECT kind, box_id AS id, x0 FROM {BOX} WHERE p_size % 3 = 0), t AS (SELECT kind, box_id AS template, x0 FROM {BOX} WHERE p_size % 3 = 1), j AS (SELECT q.kind, q.id, template, row_number() OVER (PARTITION BY q.id ORDER BY abs(q.x0 - t.x0), template) AS rn FROM q JOIN t ON t.kind = q.kind AND abs(q.x0 - t.x0) <= 2)
SELECT q.kind, q.id, j.template FROM q LEFT JOIN j ON j.id = q.id AND rn = 1""")
def same_station_templates(s, d) -> DataFrame:
    b = candidates(s, d).select("kind", F.col("box_id").alias("id"), "x0", "p_size")
    return ch.same_station(b.filter("p_size % 3 = 0"), b.filter("p_size % 3 = 1"), "kind", "x0", 2.0)


RUN = "(SELECT l_suppkey, {m} FROM lineitem WHERE l_linestatus = '{v}' GROUP BY 1)"
METRICS = {"mean_discount": "avg(l_discount)", "p90_tax": "quantile_cont(l_tax, 0.9)", "rows": "count(*)::DOUBLE"}


@query("WITH " + ", ".join(f"{n} AS (SELECT l_suppkey, unnest([{', '.join(repr(k) for k in METRICS)}]) AS metric, unnest([{', '.join(METRICS.values())}]) AS v FROM lineitem WHERE l_linestatus = '{v}' GROUP BY l_suppkey)" for n, v in (("b", "O"), ("a", "F")))
       + " SELECT b.l_suppkey, b.metric, round(b.v, 4) AS before, round(a.v, 4) AS after, round(a.v - b.v, 4) AS delta, round(CASE WHEN b.v <> 0 THEN (a.v - b.v) / abs(b.v) END, 4) AS relative FROM b JOIN a ON a.l_suppkey = b.l_suppkey AND a.metric = b.metric")
def follow_up_deltas(s, d) -> DataFrame:
    side = lambda v: load(s, d, "lineitem").filter(F.col("l_linestatus") == v).groupBy("l_suppkey").agg(F.avg("l_discount").alias("mean_discount"), F.percentile("l_tax", 0.9).alias("p90_tax"), F.count(F.lit(1)).alias("rows"))
    return ch.follow_up(side("O"), side("F"), "l_suppkey", list(METRICS)).select("l_suppkey", "metric", r("before"), r("after"), r("delta"), r("relative"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'timeout' WHEN n IS NULL THEN 'empty' ELSE 'ok' END AS state, CASE WHEN c_acctbal >= 0 THEN coalesce(n, 0) END AS lines FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def explicit_empty_results(s, d) -> DataFrame:
    c = load(s, d, "customer").select("c_custkey", "c_acctbal")
    return ch.results_with_empty(c, load(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", F.col("c_acctbal") < 0)


@query(f"SELECT substr(sha256(concat_ws(',', 5, p_partkey)), 1, 12) AS task, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY {HASH.format(p='5, p_partkey')}, p_partkey) AS place, p_size, p_retailprice FROM part")
def blind_tasks(s, d) -> DataFrame:
    return ch.blind_tasks(load(s, d, "part"), "p_partkey", ["p_size", "p_retailprice"], ["p_type", "p_name"], 5, ["p_brand"])


@query(f"""WITH e AS (SELECT source, avg(z) FILTER (x <= 5) AS a, avg(z) FILTER (x >= 45) AS b FROM {P} GROUP BY 1), q AS (SELECT p.source, abs(z - (a + (b - a) * greatest(0, least(1, (x - 5) / 40)))) AS r FROM {P} p JOIN e ON e.source = p.source)
SELECT source, count(*) AS n, round(quantile_cont(r, 0.5), 4) AS p50, round(quantile_cont(r, 0.9), 4) AS p90 FROM q GROUP BY 1""")
def transition_residuals(s, d) -> DataFrame:
    c, p = F.col, points(s, d).select("source", F.col("x").alias("s"), "z")
    at = lambda f, x: p.filter(f).groupBy("source").agg(F.avg("z").alias("z")).select("source", F.lit(x).alias("s"), c("z"))
    return ch.transition_residuals(p, at("s <= 5", 5.0).union(at("s >= 45", 45.0)), "source").select("source", "n", r("p50"), r("p90"))


@query("""WITH l AS (SELECT l_suppkey, count(*) FILTER (l_linestatus = 'O') % 8 AS baseline, count(*) FILTER (l_linestatus = 'F') % 8 AS candidate FROM lineitem GROUP BY 1), m AS (SELECT *, least(baseline, candidate) AS matched FROM l),
q AS (SELECT l_suppkey, quantile_cont(l_discount, 0.9) FILTER (l_linestatus = 'O') AS p90, quantile_cont(l_discount, 0.9) FILTER (l_linestatus = 'F') AS n_p90, avg(CASE WHEN l_tax <= 0.04 THEN 1.0 ELSE 0.0 END) FILTER (l_linestatus = 'O') AS coverage, avg(CASE WHEN l_tax <= 0.04 THEN 1.0 ELSE 0.0 END) FILTER (l_linestatus = 'F') AS n_coverage FROM lineitem GROUP BY 1)
SELECT m.l_suppkey, concat_ws(',', CASE WHEN matched <> baseline THEN 'lines_lost' END, CASE WHEN baseline - candidate > 1 THEN 'fewer_lines' END, CASE WHEN (candidate - matched) % 2 <> 0 THEN 'half_pair' END, CASE WHEN NOT (n_p90 <= p90 * 1.05 OR n_p90 <= p90 + 0.0021) THEN 'p90' END, CASE WHEN NOT n_coverage >= coverage THEN 'coverage' END) AS reasons FROM m JOIN q ON q.l_suppkey = m.l_suppkey""")
def production_regression(s, d) -> DataFrame:
    c, li = F.col, load(s, d, "lineitem")
    n = lambda v: F.count(F.when(c("l_linestatus") == v, 1)) % 8
    lines = li.groupBy("l_suppkey").agg(n("O").alias("baseline"), n("F").alias("candidate")).withColumn("matched", F.least("baseline", "candidate"))
    of = lambda v, x: F.when(c("l_linestatus") == v, x)
    hit = F.when(c("l_tax") <= 0.04, 1.0).otherwise(0.0)
    support = li.groupBy("l_suppkey").agg(F.percentile(of("O", c("l_discount")), 0.9).alias("p90"), F.percentile(of("F", c("l_discount")), 0.9).alias("n_p90"), F.avg(of("O", hit)).alias("coverage"), F.avg(of("F", hit)).alias("n_coverage"))
    return ch.regression_guard(lines, support, "l_suppkey", 1, 0.05, 0.0021).select("l_suppkey", "reasons")
