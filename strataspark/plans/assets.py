"""Queries on columns, roofs, wires and masts: parts are candidates, line items points, events stretches along a user's way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assets as ax
from ..sources.tables import load, points
from .catalogue import CHAIN, P, SPANS, V, chained, places, query, r, spans
from .frames import BOX, candidates


@query(f"""SELECT cx, cy, n, round(low, 4) AS low, round(high, 4) AS high, levels, round(levels / (floor(high) - floor(low) + 1), 4) AS ratio FROM
(SELECT floor(x / 2)::BIGINT AS cx, floor(y / 2)::BIGINT AS cy, count(*) AS n, min(z) AS low, max(z) AS high, count(DISTINCT floor(z)) AS levels FROM {P} GROUP BY 1, 2) WHERE n >= 4 AND high - low >= 5""")
def eligible_columns(s, d) -> DataFrame:
    return ax.eligible_columns(points(s, d), 2.0, 4, 5.0, 1.0).select("cx", "cy", "n", r("low"), r("high"), "levels", r("ratio"))


@query(f"SELECT cx, cz, count(*) AS bins, round(count(*) / 50, 4) AS coverage FROM (SELECT DISTINCT floor(x / 2)::BIGINT AS cx, floor(z / 1)::BIGINT AS cz, floor(y / 2)::BIGINT AS cy FROM {P}) GROUP BY 1, 2")
def along_coverage(s, d) -> DataFrame:
    return ax.along_coverage(points(s, d), 2.0, 2.0, 1.0, 100.0).select("cx", "cz", "bins", r("coverage"))


@query(f"SELECT class, floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, count(*) AS n, count(*) FILTER (z >= 0 AND z < 3) AS band_0, count(*) FILTER (z >= 3 AND z < 6) AS band_1, count(*) FILTER (z >= 6 AND z < 11) AS band_2 FROM {P} GROUP BY 1, 2, 3")
def banded_density(s, d) -> DataFrame:
    return ax.banded_density(points(s, d), 5.0, [0.0, 3.0, 6.0, 11.0], ("class",))


@query(f"SELECT source, floor(x / 2)::BIGINT AS row, (floor(x / 2) + 0.5) * 2 AS pos, count(*) AS n, round(quantile_cont(z, 0.2), 4) AS level FROM {P} GROUP BY 1, 2, 3 HAVING count(*) >= 5")
def row_baseline(s, d) -> DataFrame:
    return ax.row_quantiles(points(s, d), ["source"], "x", 2.0, "z", 0.2, 5).select("source", "row", F.col("at").alias("pos"), "n", r("level"))


@query(f"""WITH k AS (SELECT s.*, e.event_type AS kind FROM {SPANS} s JOIN events e ON e.event_id = s.event_id), m AS (SELECT *, CASE WHEN lag(kind) OVER w IS NULL OR lag(kind) OVER w <> kind OR b > max(e) OVER (PARTITION BY user_id ORDER BY b, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 7200 THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY user_id ORDER BY b, e, event_id)),
p AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY b, e, event_id ROWS UNBOUNDED PRECEDING) AS part FROM m)
SELECT user_id, part::BIGINT AS part, kind, round(min(b), 3) AS start, round(max(e), 3) AS stop, string_agg(event_id::VARCHAR, ',' ORDER BY b, e, event_id) AS ids FROM p GROUP BY 1, 2, 3""")
def merged_evidence(s, d) -> DataFrame:
    rows = spans(s, d).select("user_id", "event_id", F.col("b").alias("start"), F.col("e").alias("stop")).join(load(s, d, "events").select("event_id", F.col("event_type").alias("kind")), "event_id")
    return ax.merged_evidence(rows, ["user_id"], "kind", "event_id", 7200.0).select("user_id", "part", "kind", F.round("start", 3).alias("start"), F.round("stop", 3).alias("stop"), "ids")


@query(f"""WITH j AS (SELECT a.id, b.id AS o, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS f, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS g, b.z - a.z AS dz FROM {V} a JOIN {V} b ON a.id % 4 = 0 AND b.id % 4 <> 0),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY g, o) AS rn FROM j WHERE f <= 0.05) SELECT v.id, k.o AS surface_id, round(dz, 6) AS gap, CASE WHEN k.o IS NULL THEN 'no_surface' WHEN abs(dz) <= 0.05 THEN 'contact' ELSE 'gap' END AS state FROM {V} v LEFT JOIN k ON k.id = v.id AND rn = 1 WHERE v.id % 4 = 0""")
def column_roof_contacts(s, d) -> DataFrame:
    p = places(s, d)
    return ax.contacts(p.filter("id % 4 = 0"), p.filter("id % 4 <> 0"), 0.05, 0.05, 0.05).select("id", "surface_id", F.round("gap", 6).alias("gap"), "state")


LINES = "(SELECT * FROM (VALUES ('A'), ('N'), ('R')) c(class), (VALUES (1, 10.0), (2, 40.0), (3, 70.5)) v(line, pos))"


@query(f"""SELECT l.class, line, count(*) FILTER (abs(y - pos) <= 2) AS centre, count(*) FILTER (abs(y - pos) > 2) / 2 AS sides, round(count(*) FILTER (abs(y - pos) <= 2) / greatest(count(*) FILTER (abs(y - pos) > 2) / 2, 1.0), 4) AS contrast,
count(*) FILTER (abs(y - pos) <= 2) / greatest(count(*) FILTER (abs(y - pos) > 2) / 2, 1.0) >= 1.1 AS passed FROM {LINES} l JOIN {P} p ON p.class = l.class AND abs(y - pos) <= 6 GROUP BY 1, 2""")
def strip_contrast(s, d) -> DataFrame:
    lines = load(s, d, "lineitem").select(F.col("l_returnflag").alias("class")).distinct().select("class", F.inline(F.array(*[F.struct(F.lit(i).alias("line"), F.lit(a).alias("at")) for i, a in ((1, 10.0), (2, 40.0), (3, 70.5))])))
    return ax.strip_contrast(points(s, d), lines, "class", 2.0, 1.1).select("class", "line", "centre", "sides", r("contrast"), "passed")


@query(f"""WITH j AS (SELECT a.kind, a.box_id AS id, b.box_id AS o, greatest(a.y0 - b.y1, b.y0 - a.y1) AS g FROM {BOX} a JOIN {BOX} b ON a.kind = b.kind AND a.p_size % 3 = 0 AND b.p_size % 3 <> 0 AND greatest(a.y0 - b.y1, b.y0 - a.y1) <= 3),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY g, o) AS rn FROM j) SELECT b.kind, b.box_id AS id, k.o AS nearest, round(g, 4) AS clearance, coalesce(g >= 0, true) AS passed FROM {BOX} b LEFT JOIN k ON k.id = b.box_id AND rn = 1 WHERE b.p_size % 3 = 0""")
def foundation_clearance(s, d) -> DataFrame:
    b = candidates(s, d).select("kind", F.col("box_id").alias("id"), F.col("y0").alias("low"), F.col("y1").alias("high"), "p_size")
    return ax.signed_clearance(b.filter("p_size % 3 = 0"), b.filter("p_size % 3 <> 0"), "kind", 8.0, 3.0).select("kind", "id", "nearest", r("clearance"), "passed")


@query(f"""WITH m AS (SELECT part_key, sum(z * y) / sum(y) AS m FROM {P} WHERE x > 45 GROUP BY 1) SELECT p.part_key, count(*) AS n, round(any_value(m), 4) AS correction, round(max(z) - min(z), 4) AS spread, round(max(abs(z - m)), 4) AS worst,
max(z) - min(z) <= 7.5 AND max(abs(z - m)) <= 5.05 AS accepted FROM {P} p JOIN m ON m.part_key = p.part_key WHERE x > 45 GROUP BY 1""")
def group_correction(s, d) -> DataFrame:
    return ax.weighted_correction(points(s, d).filter("x > 45"), "part_key", "z", "y", 7.5, 5.05).select("part_key", "n", r("correction"), r("spread"), r("worst"), "accepted")


@query("""WITH e AS (SELECT CASE WHEN l_tax < 0.075 THEN l_discount - 0.05 END AS m, l_tax - 0.035 AS o FROM lineitem)
SELECT CASE WHEN m IS NULL THEN 'data_insufficient' WHEN abs(m) <= 0.0151 AND abs(o) <= 0.0151 THEN 'stable' WHEN abs(m - o) <= 0.0151 THEN 'confirmed' WHEN abs(o) <= 0.0151 THEN 'model_only' WHEN abs(m) <= 0.0151 THEN 'observed_only' ELSE 'conflict' END AS change, count(*) AS n FROM e GROUP BY 1""")
def edge_changes(s, d) -> DataFrame:
    model, seen = F.when(F.col("l_tax") < 0.075, F.col("l_discount") - 0.05), F.col("l_tax") - 0.035
    return load(s, d, "lineitem").groupBy(ax.edge_change(model, seen, 0.0151).alias("change")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH q AS (SELECT part_key, count(*) AS n, quantile_cont(y, 0.01) AS lo, quantile_cont(y, 0.99) AS hi FROM {P} WHERE abs(z - 0.1 * x) <= 1.01 GROUP BY 1)
SELECT k.part_key, coalesce(n, 0) AS n, round(CASE WHEN n >= 5 THEN lo END, 8) AS low, round(CASE WHEN n >= 5 THEN hi END, 8) AS high, CASE WHEN n >= 5 THEN 'supported' ELSE 'data_insufficient' END AS state FROM (SELECT DISTINCT part_key FROM {P}) k LEFT JOIN q ON q.part_key = k.part_key""")
def support_extent(s, d) -> DataFrame:
    out = ax.support_extent(points(s, d), "part_key", "y", F.col("z") - 0.1 * F.col("x"), 1.01, 5)
    return out.select("part_key", "n", F.round("low", 8).alias("low"), F.round("high", 8).alias("high"), "state")


@query(f"""WITH n AS (SELECT *, max(x) OVER (PARTITION BY part_key) AS st FROM {P} WHERE abs(x - 40) <= 9), j AS (SELECT * FROM n WHERE x >= st - 2), p AS (SELECT part_key, st, class, sum(y) AS s, count(*) AS n, max(z) AS top FROM j GROUP BY 1, 2, 3)
SELECT part_key, st AS station, round(sum(s) / sum(n), 10) AS across, round(avg(top), 4) AS top FROM p GROUP BY 1, 2""")
def endpoint_signature(s, d) -> DataFrame:
    p = points(s, d).withColumnRenamed("class", "part")
    return ax.endpoint_signature(p, "part_key", "x", F.lit(40.0), 9.0, 2.0).select("part_key", "station", F.round("across", 10).alias("across"), r("top"))


@query(f"SELECT round_even(y / 0.8, 0)::BIGINT AS ky, round_even(z / 0.8, 0)::BIGINT AS kz, count(*) AS n, round(avg(y), 4) AS y, round(avg(z), 4) AS z FROM {P} GROUP BY 1, 2")
def endpoint_clusters(s, d) -> DataFrame:
    return ax.endpoint_clusters(points(s, d), 0.8).select("ky", "kz", "n", r("y"), r("z"))


@query(f"""WITH n AS (SELECT kind, box_id AS id, lead(box_id) OVER w AS next_id, lead(y0) OVER w - y0 AS spacing, ((lead(y1) OVER w - lead(y0) OVER w) + (y1 - y0)) / 2 AS wd FROM {BOX} WINDOW w AS (PARTITION BY kind ORDER BY y0, box_id))
SELECT kind, id, next_id, spacing, round(greatest(0, wd - spacing), 4) AS overlap, spacing >= 4 AND greatest(0, wd - spacing) <= 0 AS passed FROM n WHERE next_id IS NOT NULL""")
def neighbour_spacing(s, d) -> DataFrame:
    b = candidates(s, d).select("kind", F.col("box_id").alias("id"), "y0", (F.col("y1") - F.col("y0")).alias("width"))
    return ax.neighbour_spacing(b, "kind", "y0", "width", 4.0).select("kind", "id", "next_id", "spacing", r("overlap"), "passed")


@query(f"""WITH c AS (SELECT user_id, quantile_cont(b, 0.2) AS lo, quantile_cont(b, 0.8) AS hi FROM {SPANS} GROUP BY 1)
SELECT s.user_id, s.event_id AS id, round(greatest(b, lo), 3) AS start, round(least(e, hi), 3) AS stop, least(e, hi) - greatest(b, lo) >= 1800 AS kept FROM {SPANS} s JOIN c ON c.user_id = s.user_id""")
def clipped_spans(s, d) -> DataFrame:
    rows = spans(s, d).select("user_id", F.col("event_id").alias("id"), F.col("b").alias("start"), F.col("e").alias("stop"))
    cores = rows.groupBy("user_id").agg(F.percentile("start", 0.2).alias("low"), F.percentile("start", 0.8).alias("high"))
    return ax.clipped_spans(rows, cores, "user_id", 1800.0).select("user_id", "id", F.round("start", 3).alias("start"), F.round("stop", 3).alias("stop"), "kept")


@query(f"""WITH b AS (SELECT user_id, floor(round(chainage_m, 4) / 5)::BIGINT AS bin, count(*) AS n FROM {CHAIN} GROUP BY 1, 2) SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.user_id = b.user_id AND abs(o.bin - b.bin) <= 7 AND (o.n > b.n OR o.n = b.n AND o.bin < b.bin))""")
def attachment_clusters(s, d) -> DataFrame:
    return ax.strongest_apart(chained(s, d).withColumn("chainage_m", F.round("chainage_m", 4)).withColumn("one", F.lit(1)), "user_id", "chainage_m", "one", 5.0, 7)


NODES = "(SELECT 'N' || s_suppkey AS node FROM supplier)"
NAMES = "(SELECT 'N' || l_suppkey || CASE WHEN l_linenumber > 1 THEN '-' || ['shaft', 'foundation', 'insulator', 'arm'][l_partkey % 4 + 1] || '-' || l_orderkey ELSE '' END AS name FROM lineitem WHERE l_quantity > 49)"


@query(f"""WITH g AS (SELECT n.node, count(*) FILTER (upper(name) LIKE '%SHAFT%') AS shaft, count(*) FILTER (upper(name) LIKE '%FOUNDATION%') AS foundation, count(*) FILTER (upper(name) LIKE '%INSULATOR%') AS insulator FROM {NODES} n LEFT JOIN {NAMES} m ON name = node OR name LIKE node || '-%' GROUP BY 1)
SELECT *, CASE WHEN shaft < 1 THEN 'BLOCKED' WHEN foundation >= 1 AND insulator >= 2 THEN 'P0' WHEN (foundation < 1)::INT + (insulator < 2)::INT = 1 THEN 'P1' ELSE 'P2' END AS priority FROM g""")
def detail_inventory(s, d) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(k) for k in ("shaft", "foundation", "insulator", "arm")]), (F.col("l_partkey") % 4 + 1).cast("int"))
    tail = F.when(F.col("l_linenumber") > 1, F.concat(F.lit("-"), kind, F.lit("-"), "l_orderkey")).otherwise("")
    names = load(s, d, "lineitem").filter("l_quantity > 49").select(F.concat(F.lit("N"), "l_suppkey", tail).alias("name"))
    return ax.inventory(load(s, d, "supplier").select(F.concat(F.lit("N"), "s_suppkey").alias("node")), names, {"shaft": 1, "foundation": 1, "insulator": 2})


BANDS = f"(SELECT part_key, floor(y / 3)::BIGINT AS band, quantile_cont(z, 0.5) AS mid FROM {P} GROUP BY 1, 2 HAVING count(*) >= 2)"


@query(f"""WITH m AS (SELECT *, CASE WHEN band - lag(band) OVER w > 2 OR abs(mid - lag(mid) OVER w) > 3.25 THEN 1 ELSE 0 END AS new FROM {BANDS} WINDOW w AS (PARTITION BY part_key ORDER BY band)), g AS (SELECT *, sum(new) OVER (PARTITION BY part_key ORDER BY band) AS part FROM m)
SELECT part_key, part::BIGINT AS part, count(*) AS bands, min(band) AS low, max(band) AS high FROM g GROUP BY 1, 2 HAVING count(*) >= 2""")
def roof_surface_split(s, d) -> DataFrame:
    bands = points(s, d).groupBy("part_key", F.floor(F.col("y") / 3).alias("band")).agg(F.percentile("z", 0.5).alias("mid"), F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return ax.band_groups(bands, "part_key", "band", "mid", 2, 3.25, 2)


KNOT = "(SELECT l_suppkey AS k, l_quantity AS s, avg(l_discount) * 100 AS lc, avg(l_discount) * 100 + 3 AS hc, avg(l_tax) * 100 AS lz, avg(l_tax) * 100 + 1 + l_quantity % 3 AS hz FROM lineitem WHERE l_quantity % 10 = 5 GROUP BY 1, 2)"


@query(f"""WITH p AS (SELECT l_suppkey AS k, l_orderkey, l_linenumber, l_partkey, l_quantity AS s, l_extendedprice / 10000 AS c FROM lineitem), j AS (SELECT p.*, (SELECT max(s) FROM {KNOT} n WHERE n.k = p.k AND n.s <= p.s) AS s0, (SELECT min(s) FROM {KNOT} n WHERE n.k = p.k AND n.s >= p.s) AS s1 FROM p),
i AS (SELECT j.*, CASE WHEN s1 > s0 THEN (j.s - s0) / (s1 - s0) ELSE 0 END AS t, a.lc AS lc0, b.lc AS lc1, a.hc AS hc0, b.hc AS hc1, a.lz AS lz0, b.lz AS lz1, a.hz AS hz0, b.hz AS hz1 FROM j LEFT JOIN {KNOT} a ON a.k = j.k AND a.s = s0 LEFT JOIN {KNOT} b ON b.k = j.k AND b.s = s1)
SELECT l_orderkey, l_linenumber, l_partkey, k, round(lz0 + (lz1 - lz0) * t + greatest(0, least(1, (c - (lc0 + (lc1 - lc0) * t)) / greatest((hc0 + (hc1 - hc0) * t) - (lc0 + (lc1 - lc0) * t), 1e-9))) * ((hz0 + (hz1 - hz0) * t) - (lz0 + (lz1 - lz0) * t)), 8) AS elevation FROM i""")
def section_elevation(s, d) -> DataFrame:
    c, li = F.col, load(s, d, "lineitem")
    knots = li.filter("l_quantity % 10 = 5").groupBy(c("l_suppkey").alias("k"), c("l_quantity").alias("s")).agg((F.avg("l_discount") * 100).alias("low_c"), (F.avg("l_tax") * 100).alias("low_z"))
    knots = knots.withColumn("high_c", c("low_c") + 3).withColumn("high_z", c("low_z") + 1 + c("s") % 3)
    rows = li.select(c("l_suppkey").alias("k"), "l_orderkey", "l_linenumber", "l_partkey", c("l_quantity").alias("s"), (c("l_extendedprice") / 10000).alias("c"))
    return ax.section_elevation(rows, knots, "k").select("l_orderkey", "l_linenumber", "l_partkey", "k", F.round("elevation", 8).alias("elevation"))


@query(f"""WITH a AS (SELECT floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, count(*) AS n FROM {P} WHERE z < 2 GROUP BY 1, 2), b AS (SELECT floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, count(*) AS n FROM {P} WHERE z > 8 GROUP BY 1, 2)
SELECT coalesce(a.cx, b.cx) AS cx, coalesce(a.cy, b.cy) AS cy, coalesce(a.n, 0) AS old, coalesce(b.n, 0) AS new, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'lost' ELSE 'both' END AS change FROM a FULL JOIN b ON a.cx = b.cx AND a.cy = b.cy""")
def density_change(s, d) -> DataFrame:
    p = points(s, d)
    return ax.density_change(p.filter("z < 2"), p.filter("z > 8"), 5.0)


@query(f"""WITH g AS (SELECT box_id, x0 AS s, x1 + 4 AS e, y0 AS c, z0 AS z FROM {BOX} WHERE p_size % 4 = 0), f AS (SELECT box_id, x0 AS s, x1 + 6 AS e, y0 AS c0, y1 AS c1, z1 AS z FROM {BOX} WHERE p_size % 4 <> 0),
j AS (SELECT g.box_id AS id, f.box_id AS o, least(abs(g.c - c0), abs(g.c - c1)) AS ed, abs(g.z - f.z) AS h FROM g JOIN f ON g.s <= f.e AND f.s <= g.e AND least(g.e, f.e) - greatest(g.s, f.s) >= least(5.0, (g.e - g.s) / 2)), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ed, h, o) AS rn FROM j WHERE ed <= 2.1 AND h <= 2.1)
SELECT g.box_id AS id, k.o AS roof_id, CASE WHEN k.o IS NULL THEN 'P1' ELSE 'P2' END AS priority FROM g LEFT JOIN k ON k.id = g.box_id AND rn = 1""")
def linear_gap_matches(s, d) -> DataFrame:
    c, b = F.col, candidates(s, d)
    gaps = b.filter("p_size % 4 = 0").select(c("box_id").alias("span_id"), c("x0").alias("start"), (c("x1") + 4).alias("stop"), c("y0").alias("c"), c("z0").alias("z"))
    roofs = b.filter("p_size % 4 <> 0").select(c("box_id").alias("span_id"), c("x0").alias("start"), (c("x1") + 6).alias("stop"), c("y0").alias("c0"), c("y1").alias("c1"), c("z1").alias("z"))
    return ax.linear_matches(gaps, roofs, 8.0, 2.1, 2.1)


@query("""SELECT a.p_partkey FROM part a WHERE p_partkey % 3 = 0 AND EXISTS (SELECT 1 FROM part b WHERE b.p_partkey % 3 = 1 AND abs(a.p_retailprice - b.p_retailprice) <= 30 AND abs(a.p_size - b.p_size) <= 3 AND abs(a.p_partkey % 10 - b.p_partkey % 10) <= 1 AND abs(a.p_partkey % 7 - b.p_partkey % 7) <= 1)""")
def phenotype_cover(s, d) -> DataFrame:
    p = load(s, d, "part").select("p_partkey", "p_retailprice", "p_size", (F.col("p_partkey") % 10).alias("u"), (F.col("p_partkey") % 7).alias("v"))
    return ax.cover(p.filter("p_partkey % 3 = 0"), p.filter("p_partkey % 3 = 1"), {"p_retailprice": 30.0, "p_size": 3.0, "u": 1.0, "v": 1.0}).select("p_partkey")


DIR = f"(SELECT id, x, y, z, x / sqrt(x * x + y * y + z * z) AS dx, y / sqrt(x * x + y * y + z * z) AS dy, z / sqrt(x * x + y * y + z * z) AS dz, id + 1 AS target FROM {V} WHERE x * x + y * y + z * z > 0)"


@query(f"SELECT a.id, b.id AS other, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2), 6) AS gap FROM {DIR} a JOIN {DIR} b ON a.id <> b.id AND b.id <> a.target AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.06 AND a.dx * b.dx + a.dy * b.dy + a.dz * b.dz >= 0.9")
def alternative_targets(s, d) -> DataFrame:
    c, p = F.col, places(s, d)
    n = F.sqrt(c("x") * c("x") + c("y") * c("y") + c("z") * c("z"))
    v = p.filter(n > 0).select("id", "x", "y", "z", *[(c(a) / n).alias(f"d{a}") for a in "xyz"], (c("id") + 1).alias("target"))
    return ax.alternatives(v, v, 0.06, 0.9).select("id", "other", F.round("gap", 6).alias("gap"))


RULES = [("contact", 0.0, 2.0, 5.0, 3.1), ("messenger", 5.0, 3.0, 8.0, 4.1)]


@query(f"""WITH ru AS (SELECT * FROM (VALUES {', '.join(str(x) for x in RULES)}) v(rule, off, lo, hi, most)), a AS (SELECT part_key, row_key || '-' || row_no AS row_id, x, z FROM {P} WHERE class = 'A'), f AS (SELECT part_key, row_key || '-' || row_no AS found_id, x AS fx, z AS fz FROM {P} WHERE class = 'N')
SELECT a.part_key, row_id, rule, found_id, round(abs(fx - x - off) / most + abs(fz - z - (lo + hi) / 2) / (hi - lo), 4) AS score FROM a, ru, f WHERE f.part_key = a.part_key AND abs(fx - x - off) <= most AND fz - z BETWEEN lo AND hi""")
def conductor_rules(s, d) -> DataFrame:
    c, p = F.col, points(s, d).withColumn("name", F.concat_ws("-", "row_key", "row_no"))
    rules = s.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("rule", "offset", "low", "high", "most"), x)]) for x in RULES])))
    rows = p.filter("class = 'A'").select("part_key", c("name").alias("row_id"), "x", "z")
    found = p.filter("class = 'N'").select("part_key", c("name").alias("found_id"), c("x").alias("fx"), c("z").alias("fz"))
    return ax.rule_join(rows, rules, found, "part_key", 4.1).select("part_key", "row_id", "rule", "found_id", r("score"))
