"""The query catalogue: each query's function and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import fits, gates, grid, intervals, matching, metrics, neighbours, registry, sequences, spatial
from ..sources.tables import intake_profile, load, points, trajectory
from ..streaming import windows

QUERIES: dict = {}
SQL: dict[str, str] = {}
P = "(SELECT l_orderkey AS row_key, l_linenumber AS row_no, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z, l_returnflag AS class, l_linestatus AS source, l_partkey AS part_key FROM lineitem)"
T = "(SELECT user_id, ts, event_id, value AS position, event_type FROM events)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return add


def r(c: Column | str, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4).alias(name or c)


@query(f"SELECT floor(x / 5)::BIGINT AS cx, floor(y / 5)::BIGINT AS cy, count(*) AS n, round(max(z), 4) AS top FROM {P} GROUP BY 1, 2")
def grid_density(s, d) -> DataFrame:
    return grid.cell_stats(points(s, d), 5.0).select("cx", "cy", "n", r("top"))


@query(f"SELECT floor(x / 10)::BIGINT AS cx, floor(y / 10)::BIGINT AS cy, count(*) AS n, round(quantile_cont(z, 0.1), 4) AS p10, round(quantile_cont(z, 0.5), 4) AS p50, round(quantile_cont(z, 0.9), 4) AS p90 FROM {P} GROUP BY 1, 2 HAVING count(*) >= 5")
def grid_percentile_cells(s, d) -> DataFrame:
    return grid.cell_percentiles(points(s, d), 10.0, "z", 5).select("cx", "cy", "n", r("p10"), r("p50"), r("p90"))


@query(f"""WITH c AS (SELECT DISTINCT part_key, floor(x / 5)::BIGINT AS c FROM {P}),
s AS (SELECT *, c - lag(c) OVER (PARTITION BY part_key ORDER BY c) AS step FROM c),
g AS (SELECT *, sum(CASE WHEN step = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY part_key ORDER BY c) AS run FROM s),
q AS (SELECT part_key, run, count(*) AS length, max(step) AS step FROM g GROUP BY 1, 2)
SELECT part_key, sum(length)::BIGINT AS occupied, max(length) AS longest_run, coalesce(max(step) - 1, 0) AS largest_gap FROM q GROUP BY 1""")
def cell_continuity(s, d) -> DataFrame:
    return grid.continuity(points(s, d), 5.0, "part_key")


@query(f"""WITH v AS (SELECT floor(x / 5) AS vx, floor(y / 5) AS vy, floor(z / 2) AS vz, bool_or(source = 'O') AS a, bool_or(source = 'F') AS b FROM {P} GROUP BY 1, 2, 3)
SELECT count(*) FILTER (a) AS in_a, count(*) FILTER (b) AS in_b, count(*) FILTER (a AND b) AS in_both FROM v""")
def voxel_coverage(s, d) -> DataFrame:
    p = points(s, d)
    thin = p.select("source", "x", "y", (F.col("z") * 2.5).alias("z"))  # voxels of 5 x 5 x 2
    return grid.voxel_coverage(thin.filter("source = 'O'"), thin.filter("source = 'F'"), 5.0)


@query(f"""SELECT row_key, row_no, (x - 25) * 0.6 + (y - 30) * 0.8 AS along_m, (y - 30) * 0.6 - (x - 25) * 0.8 AS across_m FROM {P}
WHERE (y - 30) * 0.6 - (x - 25) * 0.8 >= -5 AND (y - 30) * 0.6 - (x - 25) * 0.8 < 5""")
def affine_projection_filter(s, d) -> DataFrame:
    frame = ((25.0, 30.0), (0.6, 0.8))
    side = geo.across(F.col("x"), F.col("y"), *frame)
    return points(s, d).filter(geo.within(side, -5, 5)).select("row_key", "row_no", geo.along(F.col("x"), F.col("y"), *frame).alias("along_m"), side.alias("across_m"))


@query(f"""WITH q AS (SELECT class, quantile_cont(y, 0.1) AS lo, quantile_cont(y, 0.9) AS hi FROM {P} GROUP BY 1)
SELECT p.class, count(*) AS n, round(avg(y), 4) AS mean_y FROM {P} p JOIN q ON p.class = q.class WHERE y >= lo AND y <= hi GROUP BY 1""")
def percentile_height_window(s, d) -> DataFrame:
    p = points(s, d)
    q = p.groupBy("class").agg(F.expr("percentile(y, 0.1)").alias("lo"), F.expr("percentile(y, 0.9)").alias("hi"))
    return p.join(q, "class").filter("y >= lo and y <= hi").groupBy("class").agg(F.count(F.lit(1)).alias("n"), r(F.avg("y"), "mean_y"))


@query("""SELECT CASE WHEN p_type LIKE '%BRASS%' THEN 'metal' WHEN p_type LIKE '%STEEL%' THEN 'metal' WHEN p_name LIKE '%a%' THEN 'named' WHEN p_size > 25 THEN 'large' ELSE 'other' END AS kind, count(*) AS n, min(p_partkey) AS first_part FROM part GROUP BY 1""")
def name_rule_cascade(s, d) -> DataFrame:
    c = F.col
    kind = geo.cascade([(c("p_type").contains("BRASS"), "metal"), (c("p_type").contains("STEEL"), "metal"), (c("p_name").contains("a"), "named"), (c("p_size") > 25, "large")], "other")
    return load(s, d, "part").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("first_part"))


CHAIN = f"(SELECT user_id, ts, event_id, event_type, position, sum(step_m) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS chainage_m FROM (SELECT *, coalesce(abs(position - lag(position) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 0) AS step_m FROM {T}))"


def chained(s, d) -> DataFrame:
    return intervals.chainage(trajectory(s, d), "user_id", ["ts", "event_id"], "position")


@query(f"SELECT user_id, event_id, round(chainage_m, 4) AS chainage_m FROM {CHAIN}")
def trajectory_chainage(s, d) -> DataFrame:
    return chained(s, d).select("user_id", "event_id", r("chainage_m"))


TILES = f"(SELECT user_id, tile, tile * 500.0 AS start, least(total, (tile + 1) * 500.0) AS stop FROM (SELECT user_id, total, unnest(range(0, greatest(1, ceil(total / 500.0))::BIGINT)) AS tile FROM (SELECT user_id, max(chainage_m) AS total FROM {CHAIN} GROUP BY 1)))"


def user_tiles(s, d) -> DataFrame:
    return intervals.tiles(chained(s, d).groupBy("user_id").agg(F.max("chainage_m").alias("total")), "user_id", "total", 500.0)


@query(f"SELECT user_id, tile, round(start, 4) AS start, round(stop, 4) AS stop FROM {TILES}")
def adaptive_tiles(s, d) -> DataFrame:
    return user_tiles(s, d).select("user_id", "tile", r("start"), r("stop"))


@query(f"SELECT t.user_id, tile, count(*) AS n FROM {CHAIN} c JOIN {TILES} t ON c.user_id = t.user_id AND chainage_m >= start AND chainage_m < stop GROUP BY 1, 2")
def segment_membership(s, d) -> DataFrame:
    held = intervals.range_join(chained(s, d).select("user_id", "event_id", "chainage_m"), user_tiles(s, d), "user_id", "chainage_m", "start", "stop", 500.0)
    return held.groupBy("user_id", "tile").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT a.event_id, round(b.value, 4) AS asof_value FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN
(SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def asof_interpolation(s, d) -> DataFrame:
    e = load(s, d, "events")
    seen = e.filter("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return intervals.asof(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), seen, "user_id", "ts", "value").select("event_id", r("asof_value"))


def spans(s, d) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return load(s, d, "events").select("user_id", "event_id", at.alias("b"), (at + 3600 * (1 + F.col("event_id") % 5)).alias("e"))


SPANS = "(SELECT user_id, event_id, epoch_us(ts) / 1e6 AS b, epoch_us(ts) / 1e6 + 3600 * (1 + event_id % 5) AS e FROM events)"
ISLANDS = f"""(SELECT user_id, island, min(b) AS start, max(e) AS stop, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS island FROM
(SELECT *, CASE WHEN b <= max(e) OVER (PARTITION BY user_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM {SPANS})) GROUP BY 1, 2)"""


@query(f"SELECT user_id, round(sum(stop - start), 4) AS covered, count(*) AS parts, round(max(stop), 4) AS last FROM {ISLANDS} GROUP BY 1")
def interval_union_coverage(s, d) -> DataFrame:
    return intervals.coverage(spans(s, d), "user_id", "b", "e").select("user_id", r("covered"), "parts", r("last"))


@query(f"SELECT user_id, island::BIGINT AS island, round(start, 4) AS start, round(stop, 4) AS stop, n FROM {ISLANDS}")
def evidence_interval_merge(s, d) -> DataFrame:
    return intervals.islands(spans(s, d), "user_id", [], "b", "e").select("user_id", "island", r("start"), r("stop"), "n")


@query(f"""WITH g AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g FROM {T}),
q AS (SELECT user_id, event_type, g, count(*) AS run FROM g GROUP BY 1, 2, 3)
SELECT user_id, max(run) AS run, arg_min(event_type, (-run, event_type)) AS value FROM q GROUP BY 1""")
def gaps_islands_longest_run(s, d) -> DataFrame:
    return intervals.longest_run(trajectory(s, d), "user_id", ["ts", "event_id"], "event_type")


@query(f"""SELECT user_id, event_id, round(m, 4) AS median, round(position - m, 4) AS prominence FROM (SELECT *, quantile_cont(position, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM {T})""")
def sliding_median_prominence(s, d) -> DataFrame:
    return intervals.sliding_median(trajectory(s, d), "user_id", ["ts", "event_id"], "position", 2).select("user_id", "event_id", r("median"), r("prominence"))


@query("""WITH b AS (SELECT floor(value / 10)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1),
j AS (SELECT b.bin, b.n, coalesce(l.n, 0) AS l, coalesce(q.n, 0) AS q FROM b LEFT JOIN b l ON l.bin = b.bin - 1 LEFT JOIN b q ON q.bin = b.bin + 1)
SELECT bin, n, round(bin + 0.5 * (l - q) / (l - 2 * n + q), 4) AS position FROM j WHERE n >= 3 AND n > l AND n >= q""")
def local_peaks(s, d) -> DataFrame:
    bins = grid.histogram(load(s, d, "events").filter("value is not null"), F.col("value"), 10.0)
    return grid.local_peaks(bins, 3).select("bin", "n", r("position"))


@query(f"""WITH g AS (SELECT user_id, chainage_m - lag(chainage_m) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM {CHAIN})
SELECT user_id, count(step) AS n, round(quantile_cont(step, 0.5), 4) AS median_step, round(stddev_pop(step) / nullif(avg(step), 0), 4) AS variation FROM g GROUP BY 1 HAVING count(step) >= 3""")
def spacing_regularity(s, d) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    g = chained(s, d).withColumn("step", F.col("chainage_m") - F.lag("chainage_m").over(w))
    out = g.groupBy("user_id").agg(F.count("step").alias("n"), F.expr("percentile(step, 0.5)").alias("median_step"), geo.ratio(F.stddev_pop("step"), F.avg("step")).alias("variation"))
    return out.filter("n >= 3").select("user_id", "n", r("median_step"), r("variation"))


@query("""SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rank, count(*) OVER (PARTITION BY p_brand, p_size) AS ties FROM part""")
def tie_rank_consensus(s, d) -> DataFrame:
    return metrics.ranked_consensus(load(s, d, "part"), ["p_brand"], F.col("p_size"), "p_partkey").select("p_partkey", "p_brand", "rank", "ties")


@query(f"""WITH f AS (SELECT part_key, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM {P} GROUP BY 1 HAVING count(*) >= 5 AND regr_slope(y, x) IS NOT NULL),
e AS (SELECT p.part_key, x, y, abs(y - a * x - b) AS r FROM {P} p JOIN f ON p.part_key = f.part_key),
k AS (SELECT e.part_key, x, y FROM e JOIN (SELECT part_key, quantile_cont(r, 0.5) AS m FROM e GROUP BY 1) m ON e.part_key = m.part_key WHERE r <= 2.5 * 1.4826 * m + 1e-9)
SELECT part_key, count(*) AS n, round(regr_slope(y, x), 4) AS slope FROM k GROUP BY 1 HAVING count(*) >= 2 AND regr_slope(y, x) IS NOT NULL""")
def robust_line_fit(s, d) -> DataFrame:
    return fits.robust_line(points(s, d), "part_key", "x", "y", 5).select("part_key", "n", r("slope"))


@query(f"""SELECT source, count(*) AS n, round(avg(x), 4) AS center_x, round(avg(y), 4) AS center_y, round(0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)), 4) AS angle FROM {P} GROUP BY 1""")
def corridor_frame_pca(s, d) -> DataFrame:
    return fits.principal_frame(points(s, d), "source", "x", "y").select("source", "n", r("center_x"), r("center_y"), r("angle"))


@query(f"""SELECT class, round(avg(abs(y - x)), 4) AS mean_m, round(sqrt(avg((y - x) * (y - x))), 4) AS rms_m, round(quantile_cont(abs(y - x), 0.5), 4) AS p50_m, round(quantile_cont(abs(y - x), 0.9), 4) AS p90_m, round(avg(CASE WHEN abs(y - x) <= 10 THEN 1.0 ELSE 0.0 END), 4) AS within_10 FROM {P} GROUP BY 1""")
def distance_stats(s, d) -> DataFrame:
    p = points(s, d).withColumn("d", F.abs(F.col("y") - F.col("x")))
    return p.groupBy("class").agg(r(F.avg("d"), "mean_m"), r(F.sqrt(F.avg(F.col("d") * F.col("d"))), "rms_m"), r(F.expr("percentile(d, 0.5)"), "p50_m"),
                                  r(F.expr("percentile(d, 0.9)"), "p90_m"), r(F.avg(F.when(F.col("d") <= 10, 1.0).otherwise(0.0)), "within_10"))


@query(f"""SELECT part_key, count(*) AS n, round(sum(x * y) / sum(y), 4) AS center_x, round(sum(y), 4) AS weight FROM {P} GROUP BY 1""")
def weighted_centroid_merge(s, d) -> DataFrame:
    return points(s, d).groupBy("part_key").agg(F.count(F.lit(1)).alias("n"), r(F.sum(F.col("x") * F.col("y")) / F.sum("y"), "center_x"), r(F.sum("y"), "weight"))


@query("""WITH v AS (SELECT p_retailprice AS v, min(p_partkey) AS id FROM part GROUP BY 1), o AS (SELECT o_orderkey, o_totalprice FROM orders),
d AS (SELECT o_orderkey, o_totalprice, v.v, v.id FROM o ASOF LEFT JOIN v ON o.o_totalprice >= v.v), u AS (SELECT o_orderkey, v.v, v.id FROM o ASOF LEFT JOIN v ON o.o_totalprice <= v.v)
SELECT d.o_orderkey, CASE WHEN u.v IS NULL OR d.o_totalprice - d.v <= u.v - d.o_totalprice THEN d.id ELSE u.id END AS nearest_id,
round(CASE WHEN u.v IS NULL OR d.o_totalprice - d.v <= u.v - d.o_totalprice THEN d.o_totalprice - d.v ELSE u.v - d.o_totalprice END, 4) AS distance FROM d JOIN u ON d.o_orderkey = u.o_orderkey""")
def nearest_1d_join(s, d) -> DataFrame:
    o, p = load(s, d, "orders").select("o_orderkey", "o_totalprice"), load(s, d, "part")
    return spatial.nearest_1d(o, p, "o_totalprice", "p_retailprice", "p_partkey").select("o_orderkey", "nearest_id", r("distance"))


@query("""SELECT s_suppkey, count(*) AS n FROM supplier JOIN customer ON c_acctbal >= s_acctbal - 50 AND c_acctbal < s_acctbal + 50 AND c_nationkey = s_nationkey GROUP BY 1""")
def box_overlap_join(s, d) -> DataFrame:
    sup = load(s, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), (F.col("s_acctbal") - 50).alias("lo"), (F.col("s_acctbal") + 50).alias("hi"))
    cus = load(s, d, "customer").select(F.col("c_nationkey").alias("k"), "c_acctbal")
    return intervals.range_join(cus, sup, "k", "c_acctbal", "lo", "hi", 100.0).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE c AS (SELECT floor(x / 2)::BIGINT AS cx, floor(y / 2)::BIGINT AS cy, count(*) AS n FROM {P} WHERE z >= 9 GROUP BY 1, 2),
i AS (SELECT *, (cx + 1000) * 100000 + cy AS id FROM c), l AS (SELECT a.id AS a, b.id AS b FROM i a JOIN i b ON abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1),
w(a, b) AS (SELECT id, id FROM i UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a)
SELECT component, count(*) AS cells FROM (SELECT a, min(b) AS component FROM w GROUP BY 1) GROUP BY 1""")
def connected_cells(s, d) -> DataFrame:
    cells = grid.cell_stats(points(s, d).filter("z >= 9"), 2.0).withColumn("id", (F.col("cx") + 1000) * 100000 + F.col("cy"))
    return spatial.components(spatial.cell_links(cells)).groupBy("component").agg(F.count(F.lit(1)).alias("cells"))


@query("""SELECT l.lang, count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality <> 1 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic <> 1) AS fn, count(*) FILTER (quality <> 1 AND toxic <> 1) AS tn,
round(count(*) FILTER (quality = 1 AND toxic = 1) / nullif(count(*) FILTER (toxic = 1), 0), 4) AS precision, round(count(*) FILTER (quality = 1 AND toxic = 1) / nullif(count(*) FILTER (quality = 1), 0), 4) AS recall
FROM labels JOIN documents l USING (doc_id) GROUP BY 1""")
def prf_metrics(s, d) -> DataFrame:
    j = load(s, d, "labels").join(load(s, d, "documents").select("doc_id", "lang"), "doc_id")
    return metrics.confusion(j, F.col("quality") == 1, F.col("toxic") == 1, ("lang",)).select("lang", "tp", "fp", "fn", "tn", r("precision"), r("recall"))


@query("""SELECT l_returnflag AS class, round(count(*) FILTER (l_discount >= 0.05 AND l_tax >= 0.04) / nullif(count(*) FILTER (l_discount >= 0.05 OR l_tax >= 0.04), 0), 4) AS iou FROM lineitem GROUP BY 1""")
def mask_confusion_iou(s, d) -> DataFrame:
    return metrics.confusion(load(s, d, "lineitem"), F.col("l_discount") >= 0.05, F.col("l_tax") >= 0.04, ("l_returnflag",)).select(F.col("l_returnflag").alias("class"), r("iou"))


@query("""SELECT least(9, floor(l_discount * 10 * 10))::INT AS bin, count(*) AS n, round(avg(l_discount * 10), 4) AS confidence, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM lineitem GROUP BY 1""")
def calibration_ece(s, d) -> DataFrame:
    scored = load(s, d, "lineitem").select((F.col("l_discount") * 10).alias("score"), "l_returnflag")
    return metrics.calibration(scored, "score", F.col("l_returnflag") == "R", 10).select("bin", "n", r("confidence"), r("accuracy"))


@query("""WITH a AS (SELECT count(*) AS rows, avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) AS po FROM labels),
e AS (SELECT sum(x.n * y.n) AS e FROM (SELECT quality AS k, count(*) AS n FROM labels GROUP BY 1) x JOIN (SELECT toxic AS k, count(*) AS n FROM labels GROUP BY 1) y ON x.k = y.k)
SELECT rows, round(po, 4) AS agreement, round((po - e / (rows * rows)) / nullif(1 - e / (rows * rows), 0), 4) AS kappa FROM a, e""")
def kappa_agreement(s, d) -> DataFrame:
    return metrics.kappa(load(s, d, "labels"), "quality", "toxic").select("rows", r("agreement"), r("kappa"))


@query("""WITH f AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 30), w AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_totalprice > 100000),
j AS (SELECT f.k AS a, w.k AS b FROM f FULL JOIN w ON f.k = w.k)
SELECT count(*) FILTER (a = b) AS tp, count(*) FILTER (b IS NULL) AS fp, count(*) FILTER (a IS NULL) AS fn, round(count(*) FILTER (a = b) / nullif(count(a), 0), 4) AS precision, round(count(*) FILTER (a = b) / nullif(count(b), 0), 4) AS recall FROM j""")
def topology_set_prf(s, d) -> DataFrame:
    f = load(s, d, "lineitem").filter("l_quantity > 30").select(F.col("l_orderkey").alias("k"))
    w = load(s, d, "orders").filter("o_totalprice > 100000").select(F.col("o_orderkey").alias("k"))
    return metrics.set_scores(f, w, ["k"]).select("tp", "fp", "fn", r("precision"), r("recall"))


@query("""SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(sum(value) / nullif(count(*) FILTER (value > 50), 0), 4) AS per_find FROM events GROUP BY 1""")
def human_effort(s, d) -> DataFrame:
    return load(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), "total"), r(geo.ratio(F.sum("value"), F.count(F.when(F.col("value") > 50, 1))), "per_find"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS quantity, round(avg(l_discount), 4) AS discount FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_study_report(s, d) -> DataFrame:
    return load(s, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), "quantity"), r(F.avg("l_discount"), "discount"))


@query(f"""WITH k AS (SELECT part_key, sum(y - x) AS d, count(*) AS n FROM {P} GROUP BY 1), u AS (SELECT *, ('0x' || substr(sha256(concat_ws(',', 7, draw, part_key)), 1, 8))::BIGINT / 4294967296.0 AS u FROM k, (SELECT unnest(range(0, 200)) AS draw)),
m AS (SELECT draw, sum(d * t) / sum(n * t) AS m FROM (SELECT *, {' + '.join(f'(u >= {x})::INT' for x in metrics.poisson_steps())} AS t FROM u) GROUP BY 1) SELECT round(avg(m), 4) AS mean, round(quantile_cont(m, 0.025), 4) AS low, round(quantile_cont(m, 0.975), 4) AS high FROM m""")
def paired_bootstrap_ci(s, d) -> DataFrame:
    return metrics.paired_bootstrap(points(s, d), "part_key", "y", "x", 200, 7).select(r("mean"), r("low"), r("high"))


@query("""SELECT p_brand, arg_min(p_partkey, (-p_size, p_partkey)) AS chosen, max(p_size) AS size FROM part WHERE p_retailprice < 1500 GROUP BY 1""")
def guardrail_selection(s, d) -> DataFrame:
    return load(s, d, "part").filter("p_retailprice < 1500").groupBy("p_brand").agg(F.min_by("p_partkey", F.struct(-F.col("p_size"), F.col("p_partkey"))).alias("chosen"), F.max("p_size").alias("size"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 16 = 0")
def stride_sample(s, d) -> DataFrame:
    return load(s, d, "lineitem").filter((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 16 == 0).select("l_orderkey", "l_linenumber")


@query("""SELECT o_orderpriority, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 10""")
def topk_priority_queue(s, d) -> DataFrame:
    ranked = metrics.ranked_consensus(load(s, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"], F.col("o_totalprice"), "o_orderkey")
    return ranked.filter("rank <= 10").select("o_orderpriority", "o_orderkey", "rank")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size + 100 ELSE p_size END AS p_size, p_brand FROM part UNION ALL SELECT -p_partkey - 1, p_size, p_brand FROM part WHERE p_partkey % 10 = 0""")
def registry_upsert(s, d) -> DataFrame:
    base = load(s, d, "part").select("p_partkey", "p_size", "p_brand")
    patch = base.filter("p_partkey % 3 = 0").withColumn("p_size", F.col("p_size") + 100).union(base.filter("p_partkey % 10 = 0").withColumn("p_partkey", -F.col("p_partkey") - 1))
    return registry.upsert(base, patch, "p_partkey")


@query("""WITH h AS (SELECT sha256(p_partkey || '|' || p_name || '|' || p_brand) AS h FROM part), b AS (SELECT substr(h, 1, 2) AS b, sha256(string_agg(h, '' ORDER BY h)) AS d, count(*) AS n FROM h GROUP BY 1)
SELECT sha256(string_agg(d, '' ORDER BY b)) AS digest, sum(n)::BIGINT AS rows FROM b""")
def registry_set_hash(s, d) -> DataFrame:
    return registry.set_hash(load(s, d, "part"), ["p_partkey", "p_name", "p_brand"])


@query("""SELECT 'lineitem' AS child, count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)""")
def referential_integrity(s, d) -> DataFrame:
    pairs = [("lineitem", "orders", "l_orderkey", "o_orderkey"), ("orders", "customer", "o_custkey", "c_custkey"), ("customer", "nation", "c_nationkey", "n_nationkey")]
    out = [gates.orphans(load(s, d, c), load(s, d, p), ck, pk).agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(c).alias("child"), "orphans") for c, p, ck, pk in pairs]
    return out[0].union(out[1]).union(out[2])


@query("""WITH m AS (SELECT count(*) AS n, avg(l_discount) AS a, max(l_quantity) AS q, count(*) FILTER (l_tax IS NULL) AS t FROM lineitem)
SELECT 'rows_present' AS check_name, n > 0 AS passed FROM m UNION ALL SELECT 'mean_discount', a <= 0.06 FROM m UNION ALL SELECT 'quantity_range', q <= 50 FROM m UNION ALL SELECT 'no_null_tax', t = 0 FROM m""")
def gate_checks(s, d) -> DataFrame:
    m = load(s, d, "lineitem").agg(F.count(F.lit(1)).alias("n"), F.avg("l_discount").alias("a"), F.max("l_quantity").alias("q"), F.count(F.when(F.col("l_tax").isNull(), 1)).alias("t"))
    return gates.run_checks(m, {"rows_present": F.col("n") > 0, "mean_discount": F.col("a") <= 0.06, "quantity_range": F.col("q") <= 50, "no_null_tax": F.col("t") == 0})


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'pass' WHEN o_orderstatus = 'O' THEN 'conditional' ELSE 'block' END AS status, count(*) AS n FROM orders GROUP BY 1""")
def scope_ownership_case(s, d) -> DataFrame:
    return load(s, d, "orders").groupBy(gates.status(F.col("o_orderstatus"), ["F"], ["O"]).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'gap' WHEN o_orderkey % 13 = 0 THEN 'duplicate' ELSE 'none' END AS defect, round(o_totalprice * CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 END, 4) AS observed FROM orders
UNION ALL SELECT o_orderkey, 'duplicate', round(o_totalprice, 4) FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0""")
def defect_injection(s, d) -> DataFrame:
    o = load(s, d, "orders")
    kind = geo.cascade([(F.col("o_orderkey") % 11 == 0, "gap"), (F.col("o_orderkey") % 13 == 0, "duplicate")], "none")
    once = o.select("o_orderkey", kind.alias("defect"), r(F.when(kind == "gap", 0.0).otherwise(F.col("o_totalprice")), "observed"))
    return once.union(once.filter("defect = 'duplicate'"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def precedence_ledger(s, d) -> DataFrame:
    return registry.precedence(load(s, d, "orders"), "o_custkey", [F.col("o_orderpriority"), F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(r"""SELECT doc_id, unnest(list_filter([CASE WHEN regexp_matches(text, '(?i)password[ ]*[:=]') THEN 'password' END, CASE WHEN regexp_matches(text, '-----BEGIN [A-Z ]*PRIVATE KEY') THEN 'private_key' END,
CASE WHEN regexp_matches(text, '/home/[a-z]+') THEN 'home_path' END, CASE WHEN regexp_matches(text, 'AKIA[0-9A-Z]{16}') THEN 'access_key' END], lambda x: x IS NOT NULL)) AS finding FROM documents""")
def safety_scan(s, d) -> DataFrame:
    found = {"password": r"(?i)password[ ]*[:=]", "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY", "home_path": "/home/[a-z]+", "access_key": "AKIA[0-9A-Z]{16}"}
    return gates.text_findings(load(s, d, "documents"), "doc_id", "text", found)


@query(" UNION ALL ".join(f"SELECT 'orders' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls FROM orders" for c in (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))
def intake_profile_orders(s, d) -> DataFrame:
    return intake_profile(load(s, d, "orders"), "orders")


@query("""SELECT doc_id, length(text) AS n, CASE WHEN length(text) < 200 THEN 'short' WHEN length(text) - length(replace(text, '!', '')) > 0.02 * length(text) THEN 'shouting' WHEN length(text) > 20000 THEN 'long' ELSE 'keep' END AS triage FROM documents""")
def text_quality_triage(s, d) -> DataFrame:
    n = F.length("text")
    marks = n - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))
    rule = geo.cascade([(n < 200, "short"), (marks > 0.02 * n, "shouting"), (n > 20000, "long")], "keep")
    return load(s, d, "documents").select("doc_id", n.cast("long").alias("n"), rule.alias("triage"))


@query("SELECT (epoch_us(ts) // 3600000000 * 3600)::BIGINT AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(s, d) -> DataFrame:
    return windows.tumbling(load(s, d, "events"), "1 hour").select("start_s", "event_type", "n", r("total"))


@query("SELECT ((epoch_us(ts) // 1800000000 - k) * 1800)::BIGINT AS start_s, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY 1")
def events_sliding(s, d) -> DataFrame:
    return windows.sliding(load(s, d, "events"), "1 hour", "30 minutes")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
q AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM g)
SELECT user_id, (epoch_us(min(ts)) // 1000000)::BIGINT AS start_s, ((epoch_us(max(ts)) + 1800000000) // 1000000)::BIGINT AS stop_s, count(*) AS n FROM q GROUP BY user_id, g""")
def events_session(s, d) -> DataFrame:
    return windows.sessions(load(s, d, "events"), "30 minutes")


@query("SELECT event_type, round(avg((props ->> '$.k')::DOUBLE), 4) AS mean_k, count(props ->> '$.k') AS n FROM events GROUP BY 1")
def json_props_extract(s, d) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return load(s, d, "events").groupBy("event_type").agg(r(F.avg(k.cast("double")), "mean_k"), F.count(k).alias("n"))


@query("SELECT c_mktsegment, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS active, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS idle FROM customer GROUP BY 1")
def semi_anti_membership(s, d) -> DataFrame:
    c, o = load(s, d, "customer"), load(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    a = c.join(o, "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("active"), F.lit(0).cast("long").alias("idle"))
    b = c.join(o, "c_custkey", "left_anti").groupBy("c_mktsegment").agg(F.lit(0).cast("long").alias("active"), F.count(F.lit(1)).alias("idle"))
    return a.union(b).groupBy("c_mktsegment").agg(F.sum("active").alias("active"), F.sum("idle").alias("idle"))


@query("(SELECT s_nationkey AS nation FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9000) UNION (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000 INTERSECT SELECT n_nationkey FROM nation)")
def exact_set_ops(s, d) -> DataFrame:
    sup, cus = load(s, d, "supplier"), load(s, d, "customer")
    a = sup.select(F.col("s_nationkey").alias("nation")).subtract(cus.filter("c_acctbal > 9000").select("c_nationkey"))
    return a.union(sup.filter("s_acctbal > 5000").select("s_nationkey").intersect(load(s, d, "nation").select("n_nationkey"))).distinct()


B = f"(SELECT floor(x / 10)::BIGINT AS cx, floor(y / 20)::BIGINT AS cy, x, y, z FROM {P})"


def plane_sql(rows: str, least: int) -> str:
    return f"""(SELECT *, mz - a * mx - b * my AS c FROM (SELECT *, (sxz * syy - syz * sxy) / det AS a, (syz * sxx - sxz * sxy) / det AS b FROM (SELECT *, sxx * syy - sxy * sxy AS det FROM
(SELECT cx, cy, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS sxx, var_pop(y) AS syy, covar_pop(x, y) AS sxy, covar_pop(x, z) AS sxz, covar_pop(y, z) AS syz
FROM {rows} GROUP BY 1, 2 HAVING count(*) >= {least})) WHERE det > 1e-6))"""


@query(f"""WITH e AS (SELECT q.*, abs(q.z - a * q.x - b * q.y - c) AS r FROM {B} q JOIN {plane_sql(B, 6)} f ON q.cx = f.cx AND q.cy = f.cy),
k AS (SELECT e.* FROM e JOIN (SELECT cx, cy, quantile_cont(r, 0.5) AS m FROM e GROUP BY 1, 2) m ON e.cx = m.cx AND e.cy = m.cy WHERE r <= 2.5 * 1.4826 * m + 1e-9)
SELECT k.cx, k.cy, count(*) AS n, round(any_value(f.a), 4) AS slope_x, round(any_value(f.b), 4) AS slope_y, round(sqrt(avg((k.z - f.a * k.x - f.b * k.y - f.c) ** 2)), 4) AS rms
FROM k JOIN {plane_sql('k', 3)} f ON k.cx = f.cx AND k.cy = f.cy GROUP BY 1, 2""")
def plane_fit_residuals(s, d) -> DataFrame:
    blocks = points(s, d).select(F.floor(F.col("x") / 10).alias("cx"), F.floor(F.col("y") / 20).alias("cy"), "x", "y", "z")
    return fits.robust_plane(blocks, ["cx", "cy"], 6).select("cx", "cy", "n", r("a", "slope_x"), r("b", "slope_y"), r("rms"))


def places(s, d) -> DataFrame:
    """The first three dimensions of each vector as a point."""
    return load(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label", *[F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate("xyz")])


V = "(SELECT vec_id AS id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"
NEAR = f"(SELECT a.id AS query_id, b.id AS id, a.label AS la, b.label AS lb, b.x, b.y, b.z, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS distance FROM {V} a, {V} b)"


@query(f"SELECT query_id, rank, id, round(distance, 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM {NEAR} WHERE query_id <> id) WHERE rank <= 3")
def knn_vectors(s, d) -> DataFrame:
    p = places(s, d)
    return neighbours.knn(p, p, 3, 0.05).select("query_id", "rank", "id", r("distance"))


@query(f"SELECT query_id, count(*) AS n, round(avg(distance), 4) AS mean_distance, round(var_pop(x) + var_pop(y) + var_pop(z), 4) AS scatter FROM {NEAR} WHERE distance <= 0.1 GROUP BY 1")
def radius_features(s, d) -> DataFrame:
    p = places(s, d)
    return neighbours.radius_features(p, p, 0.1).select("query_id", "n", r("mean_distance"), r("scatter"))


@query(f"""WITH RECURSIVE p AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY label DESC, id) AS i FROM {V}), n AS MATERIALIZED (SELECT a.i, list(b.i) AS near FROM p a JOIN p b ON sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.05 GROUP BY 1),
t(i, taken) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.i, CASE WHEN list_has_any(taken, near) THEN taken ELSE list_append(taken, n.i) END FROM t JOIN n ON n.i = t.i + 1), k AS MATERIALIZED (SELECT unnest(taken) AS i FROM (SELECT taken FROM t ORDER BY i DESC LIMIT 1)),
e AS (SELECT i, unnest(near) AS o FROM n), b AS (SELECT e.i, min(k.i) AS seed FROM e JOIN k ON k.i = e.o GROUP BY 1) SELECT p.id, CASE WHEN k.i IS NOT NULL THEN p.id ELSE q.id END AS seed_id FROM p LEFT JOIN k ON k.i = p.i JOIN b ON b.i = p.i JOIN p q ON q.i = b.seed""")
def spatial_dedupe_greedy(s, d) -> DataFrame:
    return neighbours.greedy_dedupe(places(s, d), 0.05, "label")


@query("""WITH RECURSIVE l AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY score, a, b) AS i FROM (SELECT x.p_partkey AS a, y.p_partkey AS b, abs(x.p_retailprice - y.p_retailprice) AS score FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_size = y.p_size AND x.p_partkey < y.p_partkey) WHERE score BETWEEN 1 AND 200),
t(i, used, a, b) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT UNION ALL SELECT l.i, CASE WHEN list_contains(used, l.a) OR list_contains(used, l.b) THEN used ELSE list_append(list_append(used, l.a), l.b) END,
CASE WHEN list_contains(used, l.a) OR list_contains(used, l.b) THEN NULL ELSE l.a END, l.b FROM t JOIN l ON l.i = t.i + 1) SELECT t.a, t.b, round(score, 4) AS score FROM t JOIN l ON l.i = t.i WHERE t.a IS NOT NULL""")
def pair_self_join_greedy(s, d) -> DataFrame:
    pairs = neighbours.value_pairs(load(s, d, "part"), ["p_brand", "p_size"], "p_partkey", "p_retailprice", 1, 200)
    return neighbours.greedy_pairs(pairs).select("a", "b", r("score"))


@query()
def assignment_match(s, d) -> DataFrame:
    p = places(s, d)
    near = neighbours.radius_join(p.filter("id % 2 = 0"), p.filter("id % 2 = 1"), 0.06, ("label",))
    return matching.assign(near.select(F.col("query_id").alias("left"), F.col("id").alias("right"), F.col("distance").alias("cost"))).select("left", "right", r("cost"))


def daily(s, d) -> DataFrame:
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000)
    return load(s, d, "events").select("user_id", day.alias("day"), F.col("event_id").alias("id"), "value", (F.col("value") / 10).alias("cost"))


@query()
def track_identity(s, d) -> DataFrame:
    return sequences.identities(daily(s, d), "user_id", "day", "value", 15.0, 3)


DAYS = "(SELECT user_id, floor(epoch_us(ts) / 86400000000)::BIGINT AS day, event_id AS id, value, value / 10 AS cost FROM events WHERE value IS NOT NULL)"


@query(f"""WITH RECURSIVE s AS (SELECT user_id, day, CASE WHEN day - lag(day) OVER w > 2 THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT user_id, day FROM {DAYS}) WINDOW w AS (PARTITION BY user_id ORDER BY day)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY day)::BIGINT AS run FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY day) AS i FROM g), c AS MATERIALIZED (SELECT e.*, run, i FROM {DAYS} e JOIN k ON k.user_id = e.user_id AND k.day = e.day),
t AS (SELECT user_id, run, i, day, id, value, cost AS total, [id] AS way, [day] AS days FROM c WHERE i = 1 UNION ALL
SELECT user_id, run, i, day, id, value, best.total + cost, list_append(best.way, id), list_append(best.days, day) FROM (SELECT c.user_id, c.run, c.i, c.day, c.id, any_value(c.value) AS value, any_value(c.cost) AS cost,
arg_min({{'total': t.total + 0.5 * abs(t.value - c.value), 'way': t.way, 'days': t.days}}, (t.total + 0.5 * abs(t.value - c.value), t.id)) AS best FROM t JOIN c ON c.user_id = t.user_id AND c.run = t.run AND c.i = t.i + 1 GROUP BY 1, 2, 3, 4, 5)),
z AS (SELECT user_id, run, arg_min({{'way': way, 'days': days, 'total': total}}, (total, id)) AS b FROM t WHERE (user_id, run, i) IN (SELECT user_id, run, max(i) FROM k GROUP BY 1, 2) GROUP BY 1, 2)
SELECT user_id, run, unnest(b.days) AS day, unnest(b.way) AS id, round(b.total, 4) AS total FROM z""")
def dp_sequence(s, d) -> DataFrame:
    return sequences.best_sequence(daily(s, d), "user_id", "day", "value", "cost", 0.5, 2).select("user_id", "run", "day", "id", r("total"))


@query("""WITH e AS (SELECT l_returnflag AS class, CASE WHEN l_linestatus = 'O' THEN 'reference' ELSE 'model' END AS side, abs(l_discount - l_tax) AS distance FROM lineitem),
s AS (SELECT class, t AS threshold, avg(CASE WHEN distance <= t THEN 1.0 ELSE 0.0 END) FILTER (side = 'reference') AS c, avg(CASE WHEN distance <= t THEN 1.0 ELSE 0.0 END) FILTER (side = 'model') AS p FROM e, (VALUES (0.015::DOUBLE), (0.035::DOUBLE), (0.055::DOUBLE)) v(t) GROUP BY 1, 2)
SELECT class, threshold, round(c, 4) AS completeness, round(p, 4) AS precision, round(CASE WHEN c + p = 0 THEN 0 ELSE 2 * c * p / (c + p) END, 4) AS fscore FROM s""")
def threshold_fscore(s, d) -> DataFrame:
    side = F.when(F.col("l_linestatus") == "O", "reference").otherwise("model")
    e = load(s, d, "lineitem").select(F.col("l_returnflag").alias("class"), side.alias("side"), F.abs(F.col("l_discount") - F.col("l_tax")).alias("distance"))
    return metrics.threshold_scores(e, [0.015, 0.035, 0.055], ("class",)).select("class", "threshold", r("completeness"), r("precision"), r("fscore"))


@query(f"""SELECT row_key, row_no, ('0x' || substr(sha256(concat_ws(',', floor(x / 5)::BIGINT, floor(y / 5)::BIGINT, floor(z / 5)::BIGINT)), 1, 8))::BIGINT % 1000000 < 200000 AS holdout FROM {P}""")
def voxel_hash_split(s, d) -> DataFrame:
    return grid.voxel_holdout(points(s, d), 5.0, 0.2).select("row_key", "row_no", "holdout")
