"""Queries that plan: tiles, ownership, context, samples and queues along users' tracks and over orders and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import boxes as bx
from ..operators import planning as pl
from ..sources.tables import load
from .catalogue import CHAIN, TILES, chained, query, r, user_tiles
from .frames import BOX, candidates

TOTAL = f"(SELECT user_id, max(chainage_m) AS total FROM {CHAIN} GROUP BY 1)"
ZONES = f"(SELECT user_id, total * 0.25 AS start, total * 0.5 AS stop, 30.0 + user_id % 40 AS length FROM {TOTAL} WHERE total > 100)"
PARTS = f"""(SELECT user_id, 0.0 AS a, start AS b, 200.0 AS length FROM {ZONES} UNION ALL SELECT user_id, start, stop, length FROM {ZONES} UNION ALL SELECT t.user_id, coalesce(z.stop, 0.0), total, 200.0 FROM {TOTAL} t LEFT JOIN {ZONES} z ON z.user_id = t.user_id)"""
ZTILES = f"""(SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s) - 1 AS tile, s AS start, e AS stop FROM (SELECT user_id, a + k * length AS s, CASE WHEN k = m - 1 THEN b ELSE a + (k + 1) * length END AS e FROM
(SELECT *, unnest(range(0, m)) AS k FROM (SELECT *, CASE WHEN n >= 2 AND b - a - (n - 1) * length < least(1.0, length * 0.1) THEN n - 1 ELSE n END AS m FROM (SELECT *, ceil((b - a) / length - 1e-9)::BIGINT AS n FROM {PARTS} WHERE b - a > 1e-9)))))"""


def totals(s, d) -> DataFrame:
    return chained(s, d).groupBy("user_id").agg(F.max("chainage_m").alias("total"))


def zone_tiles(s, d) -> DataFrame:
    t = totals(s, d)
    z = t.filter("total > 100").select("user_id", (F.col("total") * 0.25).alias("start"), (F.col("total") * 0.5).alias("stop"), (30.0 + F.col("user_id") % 40).alias("length"))
    return pl.zoned_tiles(t, z, "user_id", "total", 200.0)


@query(f"SELECT user_id, tile, round(start, 4) AS start, round(stop, 4) AS stop FROM {ZTILES}")
def zoned_tiles(s, d) -> DataFrame:
    return zone_tiles(s, d).select("user_id", "tile", r("start"), r("stop"))


@query(f"""SELECT t.user_id, t.tile, printf('s%04d_%04dm', round_even(t.start, 0)::INT, round_even(t.stop, 0)::INT) AS name, count(c.event_id) AS n, round(min(c.chainage_m) - 12, 4) AS low, round(max(c.chainage_m) + 12, 4) AS high
FROM {ZTILES} t LEFT JOIN {CHAIN} c ON c.user_id = t.user_id AND c.chainage_m BETWEEN t.start AND t.stop GROUP BY 1, 2, 3""")
def segment_plan(s, d) -> DataFrame:
    out = pl.members(chained(s, d), zone_tiles(s, d), "user_id", "chainage_m", 12.0, 200.0)
    return out.select("user_id", "tile", "name", "n", r("low"), r("high"))


SRC = f"(SELECT user_id, event_type AS id, min(chainage_m) AS start, max(chainage_m) AS stop, min(event_id) AS priority FROM {CHAIN} GROUP BY 1, 2)"
CORES = f"""(SELECT user_id, id, coalesce(lag(edge) OVER w, 0.0) AS a, coalesce(edge, total) AS b, coalesce(gap, 0.0) AS gap, CASE WHEN edge IS NULL THEN 'end' WHEN nxt > stop THEN 'gap' ELSE 'overlap' END AS status, start, priority FROM
(SELECT s.*, total, lead(start) OVER v AS nxt, (stop + lead(start) OVER v) / 2 AS edge, greatest(0.0, lead(start) OVER v - stop) AS gap FROM {SRC} s JOIN {TOTAL} t ON t.user_id = s.user_id WINDOW v AS (PARTITION BY s.user_id ORDER BY start, priority, id)) WINDOW w AS (PARTITION BY user_id ORDER BY start, priority, id))"""


def source_spans(s, d) -> DataFrame:
    return chained(s, d).groupBy("user_id", F.col("event_type").alias("id")).agg(F.min("chainage_m").alias("start"), F.max("chainage_m").alias("stop"), F.min("event_id").alias("priority"))


@query(f"SELECT user_id, id, round(a, 4) AS core_start, round(b, 4) AS core_stop, round(gap, 4) AS gap, status FROM {CORES}")
def source_ownership(s, d) -> DataFrame:
    return pl.ownership(source_spans(s, d), "user_id", totals(s, d)).select("user_id", "id", r("core_start"), r("core_stop"), r("gap"), "status")


MIDS = f"(SELECT user_id, tile, (start + stop) / 2 AS mid FROM {ZTILES})"


@query(f"""SELECT m.user_id, m.tile, c.id AS owner, round(least(mid - a, b - mid), 6) AS to_border FROM {MIDS} m JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY b DESC, id DESC) = 1 AS last FROM {CORES}) c
ON c.user_id = m.user_id AND mid >= a AND (mid < b OR last AND mid <= b)""")
def segment_owners(s, d) -> DataFrame:
    mids = zone_tiles(s, d).select("user_id", "tile", ((F.col("start") + F.col("stop")) / 2).alias("mid"))
    return pl.owners(mids, pl.ownership(source_spans(s, d), "user_id", totals(s, d)), "user_id", "mid", 200.0).select("user_id", "tile", "owner", F.round("to_border", 6).alias("to_border"))


@query(f"SELECT user_id, tile AS id, round((mid + lag(mid) OVER w) / 2, 6) AS low, round((mid + lead(mid) OVER w) / 2, 6) AS high FROM {MIDS} WINDOW w AS (PARTITION BY user_id ORDER BY mid, tile)")
def midpoint_ownership(s, d) -> DataFrame:
    mids = zone_tiles(s, d).select("user_id", F.col("tile").alias("id"), ((F.col("start") + F.col("stop")) / 2).alias("mid"))
    return pl.middles(mids, "user_id", "mid").select("user_id", "id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(f"SELECT t.user_id, t.tile, count(*) AS n FROM {TILES} t JOIN {CHAIN} c ON c.user_id = t.user_id AND c.chainage_m BETWEEN t.start - 100 AND t.stop + 100 GROUP BY 1, 2")
def context_windows(s, d) -> DataFrame:
    wide = user_tiles(s, d).select("user_id", F.col("tile").alias("span_id"), (F.col("start") - 100).alias("start"), (F.col("stop") + 100).alias("stop"))
    rows = chained(s, d).select("user_id", F.lit(0).alias("span_id"), F.col("chainage_m").alias("start"), F.col("chainage_m").alias("stop"))
    j = bx.span_pairs(wide, rows, 700.0, ("user_id",))
    return j.groupBy(F.col("a_user_id").alias("user_id"), F.col("a_span_id").alias("tile")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT user_id, k AS block, k // 2 AS grp, k * 25.0 AS start, round(least(total, (k + 1) * 25.0), 4) AS stop, greatest(0.0, k * 25.0 - 10) AS context_start, round(least(total, (k + 1) * 25.0 + 10), 4) AS context_stop
FROM (SELECT *, unnest(range(0, ceil(total / 25)::BIGINT)) AS k FROM {TOTAL})""")
def holdout_blocks(s, d) -> DataFrame:
    k, t = F.col("k"), F.col("total")
    b = totals(s, d).filter("total > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(t / 25) - 1)))
    return b.select("user_id", k.alias("block"), F.floor(k / 2).alias("grp"), (k * 25.0).alias("start"), r(F.least(t, (k + 1) * 25.0), "stop"), F.greatest(F.lit(0.0), k * 25.0 - 10).alias("context_start"), r(F.least(t, (k + 1) * 25.0 + 10), "context_stop"))


@query(f"SELECT user_id, tile, round(k * 6.5 + 0.35, 4) AS pos FROM (SELECT user_id, tile, unnest(range(ceil((start - 0.35) / 6.5)::BIGINT, floor((stop - 0.35) / 6.5)::BIGINT + 1)) AS k FROM {ZTILES})")
def sleeper_places(s, d) -> DataFrame:
    return pl.places(zone_tiles(s, d), 6.5, 0.35).select("user_id", "tile", r("at", "pos"))


@query(f"""WITH z AS (SELECT user_id, tile AS id, start, stop FROM {ZTILES}), h AS (SELECT DISTINCT z.user_id, z.id FROM z JOIN {CHAIN} c ON c.user_id = z.user_id AND c.event_type = 'purchase' AND c.chainage_m BETWEEN z.start AND z.stop),
x AS (SELECT user_id, min(chainage_m) AS lo, max(chainage_m) AS hi FROM {CHAIN} WHERE event_type = 'purchase' GROUP BY 1),
g AS (SELECT * FROM (SELECT user_id, lag(chainage_m) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, chainage_m AS b FROM {CHAIN}) WHERE b - a > 40)
SELECT z.user_id, z.id, 'no_pair' AS reason FROM z JOIN x ON x.user_id = z.user_id AND z.start >= lo AND z.stop <= hi WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.user_id = z.user_id AND h.id = z.id)
UNION ALL SELECT DISTINCT z.user_id, z.id, 'gap' FROM z JOIN g ON g.user_id = z.user_id AND z.start >= a - 1e-6 AND z.stop <= b + 1e-6""")
def gap_segments(s, d) -> DataFrame:
    seg = zone_tiles(s, d).select("user_id", F.col("tile").alias("id"), "start", "stop")
    c = chained(s, d)
    bought = c.filter("event_type = 'purchase'")
    spots = bought.select("user_id", F.lit(0).alias("span_id"), F.col("chainage_m").alias("start"), F.col("chainage_m").alias("stop"))
    held = bx.span_pairs(seg.withColumnRenamed("id", "span_id"), spots, 200.0, ("user_id",)).select(F.col("a_user_id").alias("user_id"), F.col("a_span_id").alias("id"))
    extent = bought.groupBy("user_id").agg(F.min("chainage_m").alias("low"), F.max("chainage_m").alias("high"))
    gaps = c.select("user_id", F.lag("chainage_m").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("start"), F.col("chainage_m").alias("stop")).filter("stop - start > 40")
    return pl.uncovered(seg, held, gaps, extent, "user_id", 200.0)


@query(f"SELECT box_id, round(greatest(0, least(x1, 30) - greatest(x0, 12.5)) * (y1 - y0), 4) AS area, CASE WHEN least(x1, 30) - greatest(x0, 12.5) > 0 THEN 4 ELSE 0 END AS corners FROM {BOX}")
def clipped_polygons(s, d) -> DataFrame:
    at = lambda x, y: F.struct(F.col(x).alias("s"), F.col(y).alias("c"))
    quad = F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"))
    cut = candidates(s, d).select("box_id", pl.clip_polygon(quad, 12.5, 30.0).alias("p"))
    return cut.select("box_id", r(pl.polygon_area(F.col("p")), "area"), F.size("p").alias("corners"))


@query("""WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders) SELECT o_orderkey FROM o WHERE i % ceil(n / 400)::BIGINT = 0""")
def systematic_sample(s, d) -> DataFrame:
    return pl.stride(load(s, d, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 400).select("o_orderkey")


HASH = "('0x' || substr(sha256(concat_ws(',', {p})), 1, 8))::BIGINT / 4294967296.0"


@query(f"""SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY {HASH.format(p="11, p_partkey")}, p_partkey) AS first_reviewer, row_number() OVER (PARTITION BY p_brand ORDER BY {HASH.format(p="12, p_partkey")}, p_partkey) AS second_reviewer FROM part""")
def reviewer_orders(s, d) -> DataFrame:
    one = pl.shuffled(load(s, d, "part").select("p_brand", "p_partkey"), "p_partkey", 11, ["p_brand"]).withColumnRenamed("place", "first_reviewer")
    return pl.shuffled(one, "p_partkey", 12, ["p_brand"]).withColumnRenamed("place", "second_reviewer")


TRI = f"(SELECT box_id AS id, x0 AS ax, y0 AS ay, z0 AS az, x1 AS bx, y0 AS by_, z0 AS bz, x0 AS cx, y1 AS cy, z1 AS cz, sqrt((x1 - x0) ** 2 * ((y1 - y0) ** 2 + (z1 - z0) ** 2)) / 2 AS area FROM {BOX})"


@query(f"""SELECT id, k, round(ax + ra * (1 - rb) * (bx - ax) + ra * rb * (cx - ax), 4) AS x, round(ay + ra * rb * (cy - ay), 4) AS y, round(az + ra * rb * (cz - az), 4) AS z FROM
(SELECT *, sqrt({HASH.format(p="3, id, k, 'a'")}) AS ra, {HASH.format(p="3, id, k, 'b'")} AS rb FROM (SELECT *, unnest(range(1, ceil(round(area * 1.5, 6))::BIGINT + 1)) AS k FROM {TRI}))""")
def area_weighted_samples(s, d) -> DataFrame:
    c = candidates(s, d).select(F.col("box_id").alias("id"), *[F.col(f"{a}{i}").alias(f"{k}{a}") for k, a, i in [(k, a, int(k == "b" and a == "x" or k == "c" and a != "x")) for k in "abc" for a in "xyz"]])
    return pl.surface_samples(c, 1.5, 3).select("id", "k", r("x"), r("y"), r("z"))


@query("""WITH o AS (SELECT o_custkey % 50 AS grp, o_orderkey, o_totalprice, o_orderstatus = 'F' AS ok FROM orders)
SELECT 'prefer_pass' AS policy, grp, o_orderkey, row_number() OVER (PARTITION BY grp ORDER BY ok::INT DESC, o_totalprice DESC, o_orderkey) AS place FROM o UNION ALL SELECT 'require_pass', grp, o_orderkey, row_number() OVER (PARTITION BY grp ORDER BY o_totalprice DESC, o_orderkey) FROM o WHERE ok""")
def policy_order(s, d) -> DataFrame:
    o = load(s, d, "orders").select((F.col("o_custkey") % 50).alias("grp"), "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("ok"))
    out = [pl.ordered_by_policy(o, ["grp"], F.col("ok"), "o_totalprice", p, "o_orderkey").select(F.lit(p).alias("policy"), "grp", "o_orderkey", "place") for p in ("prefer_pass", "require_pass")]
    return out[0].union(out[1])


@query("""SELECT event_type, bin, n, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, bin) AS place FROM (SELECT event_type, floor(value / 2)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2)) WHERE place <= 12""")
def top_bins(s, d) -> DataFrame:
    bins = load(s, d, "events").filter("value is not null").groupBy("event_type", F.floor(F.col("value") / 2).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.withColumn("place", F.row_number().over(Window.partitionBy("event_type").orderBy(F.col("n").desc(), "bin"))).filter("place <= 12")


@query("""SELECT source, doc_id, place FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY (length(text) - length(replace(text, '!', ''))) / greatest(1, length(text)) DESC, n_chars, doc_id) AS place FROM documents WHERE text IS NOT NULL) WHERE place <= 6""")
def bounded_review_queue(s, d) -> DataFrame:
    risk = (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))) / F.greatest(F.lit(1), F.length("text"))
    rows = load(s, d, "documents").filter("text is not null").select("source", "doc_id", "n_chars", risk.alias("risk"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(F.col("risk").desc(), "n_chars", "doc_id"))).filter("place <= 6").select("source", "doc_id", "place")


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_size >= 45 THEN 'P0' WHEN p_size >= 30 THEN 'P1' WHEN p_size >= 10 THEN 'P2' ELSE 'P3' END AS priority, p_brand, p_size AS height FROM part)
SELECT priority, printf('GAP-VERTICAL-%04d', row_number() OVER (PARTITION BY p_brand ORDER BY priority, height DESC, p_partkey)) AS name, p_brand, p_partkey FROM t""")
def priority_numbers(s, d) -> DataFrame:
    size = F.col("p_size")
    t = load(s, d, "part").select("p_partkey", F.when(size >= 45, "P0").when(size >= 30, "P1").when(size >= 10, "P2").otherwise("P3").alias("priority"), "p_brand", size.alias("height"))
    n = F.row_number().over(Window.partitionBy("p_brand").orderBy("priority", F.col("height").desc(), "p_partkey"))
    return t.select("priority", F.format_string("GAP-VERTICAL-%04d", n).alias("name"), "p_brand", "p_partkey")
