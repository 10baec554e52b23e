"""Queries of gates and registries: orders are reports and assets, line items waivers and claims, parts registered assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import freeze
from ..operators import gating as gt
from ..operators import tracks as tr
from ..sources.tables import load, points
from .catalogue import P, query, r
from .frames import BOX, candidates

STATE = "CASE WHEN o_orderpriority < '2' THEN 'PASS' WHEN o_orderpriority < '3' THEN ' Accepted' WHEN o_orderpriority < '4' THEN 'candidate' WHEN o_orderpriority < '5' THEN NULL ELSE 'PASS_WITH_WAIVER' END"
CHECK = f"(SELECT o_custkey AS gate, o_orderkey AS check_id, {STATE} AS status, o_orderstatus = 'F' AS flag, o_orderkey % 4 > 0 AS waivable FROM orders)"
WAIVER = "(SELECT l_orderkey || l_returnflag AS waiver_id, l_orderkey AS check_id, 's' || l_linenumber AS sha, CASE WHEN l_tax < 0.08 THEN 'r' || l_suppkey ELSE ' ' END AS approver, l_shipdate AS expires, CASE WHEN l_discount > 0.005 THEN 'why' ELSE '' END AS reason FROM lineitem)"
NOW = "1995-06-17 00:00:00"
VALID = f"(SELECT DISTINCT check_id FROM (SELECT waiver_id, check_id FROM {WAIVER} GROUP BY 1, 2 HAVING count(DISTINCT CASE WHEN trim(approver) <> '' THEN trim(approver) END) >= 2 AND bool_and(sha IN ('s1', 's2', 's3', 's4', 's5')) AND min(expires) > TIMESTAMP '{NOW}' AND max(trim(reason)) <> ''))"


def checks(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = F.col
    rows = load(s, d, "orders").select(c("o_custkey").alias("gate"), c("o_orderkey").alias("check_id"), F.expr(STATE).alias("status"), (c("o_orderstatus") == "F").alias("flag"), (c("o_orderkey") % 4 > 0).alias("waivable"))
    w = load(s, d, "lineitem").select(F.concat("l_orderkey", "l_returnflag").alias("waiver_id"), c("l_orderkey").alias("check_id"), F.concat(F.lit("s"), "l_linenumber").alias("sha"),
                                      F.when(c("l_tax") < 0.08, F.concat(F.lit("r"), "l_suppkey")).otherwise(" ").alias("approver"), c("l_shipdate").alias("expires"), F.when(c("l_discount") > 0.005, "why").otherwise("").alias("reason"))
    hashes = s.range(1, 6).select(F.concat(F.lit("s"), "id").alias("sha"))
    return rows, gt.valid_waivers(w, hashes, F.lit(NOW).cast("timestamp_ntz")), hashes


@query(f"SELECT check_id FROM {VALID}")
def valid_waivers(s, d) -> DataFrame:
    return checks(s, d)[1]


PASSED = "CASE WHEN status IS NOT NULL THEN trim(status) IN ('PASS', 'PASS_WITH_WAIVER') OR lower(trim(status)) IN ('pass', 'passed', 'accepted') ELSE coalesce(flag, false) END"


@query(f"""WITH j AS (SELECT gate, {PASSED} AS ok, waivable AND v.check_id IS NOT NULL AS w FROM {CHECK} c LEFT JOIN {VALID} v ON v.check_id = c.check_id),
g AS (SELECT gate, count(*) AS checks, count(*) FILTER (NOT ok AND NOT w) AS failed, count(*) FILTER (NOT ok AND w) AS waived FROM j GROUP BY 1),
a AS (SELECT o_custkey AS gate, count(DISTINCT l_linestatus) AS roles FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_tax <= 0.05 AND l_linestatus IN ('O', 'F') AND l_linenumber <= 5 GROUP BY 1)
SELECT g.gate, checks, failed, waived, 2 - coalesce(roles, 0) AS missing_roles, CASE WHEN failed > 0 OR 2 - coalesce(roles, 0) > 0 THEN 'FAIL' WHEN waived > 0 THEN 'PASS_WITH_WAIVER' ELSE 'PASS' END AS status FROM g LEFT JOIN a ON a.gate = g.gate""")
def quality_gate_v2(s, d) -> DataFrame:
    rows, waived, hashes = checks(s, d)
    c = F.col
    o = load(s, d, "orders").select(c("o_orderkey").alias("l_orderkey"), c("o_custkey").alias("gate"))
    a = load(s, d, "lineitem").join(o, "l_orderkey").select("gate", c("l_linestatus").alias("role"), F.when(c("l_tax") <= 0.05, "approved").otherwise("rejected").alias("decision"), F.concat(F.lit("s"), "l_linenumber").alias("sha"))
    return gt.quality_gate(rows, waived, a, ["O", "F"], hashes)


@query("SELECT l_suppkey, l_returnflag, count(*) AS members, bool_and(l_quantity >= 2 AND l_discount <= 0.1) AS passed FROM lineitem GROUP BY 1, 2")
def fail_closed_aggregate(s, d) -> DataFrame:
    return gt.all_pass(load(s, d, "lineitem"), ["l_suppkey", "l_returnflag"], (F.col("l_quantity") >= 2) & (F.col("l_discount") <= 0.1))


@query("""WITH n AS (SELECT user_id, count(*) FILTER (event_type NOT IN ('view', 'click', 'login') OR event_type = 'login') AS errors, count(*) FILTER (event_type IN ('view', 'click')) AS warnings FROM events WHERE event_id % 7 = 0 OR event_type = 'view' GROUP BY 1)
SELECT *, CASE WHEN errors > 0 THEN 'blocked' WHEN warnings > 0 THEN 'pass_with_warnings' ELSE 'pass' END AS status FROM n""")
def two_tier_audit(s, d) -> DataFrame:
    found = load(s, d, "events").filter("event_id % 7 = 0 or event_type = 'view'")
    return gt.two_tier(found, "user_id", "event_type", ["view", "click", "login"], ["login"])


@query("""WITH a AS (SELECT p_partkey % 1500 AS id, p_brand, CASE WHEN p_size > 45 THEN 'Accepted' WHEN p_size > 30 THEN 'formal' ELSE 'candidate' END AS state, CASE WHEN p_partkey % 9 > 0 THEN sha256(p_name) END AS digest FROM part), l AS (SELECT l_partkey AS a, l_suppkey * 20 AS b FROM lineitem)
SELECT 'duplicate_ids' AS check_id, count(*) AS failures FROM (SELECT id FROM a GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'dangling_from', count(*) FROM l WHERE a NOT IN (SELECT id FROM a) UNION ALL SELECT 'dangling_to', count(*) FROM l WHERE b NOT IN (SELECT id FROM a)
UNION ALL SELECT 'promoted_state', count(*) FROM a WHERE lower(state) IN ('accepted', 'formal') UNION ALL SELECT 'missing_digest', count(*) FROM a WHERE digest IS NULL""")
def release_audit(s, d) -> DataFrame:
    c = F.col
    a = load(s, d, "part").select((c("p_partkey") % 1500).alias("id"), F.when(c("p_size") > 45, "Accepted").when(c("p_size") > 30, "formal").otherwise("candidate").alias("state"), F.when(c("p_partkey") % 9 > 0, F.sha2("p_name", 256)).alias("digest"))
    return gt.release_audit(a, load(s, d, "lineitem").select(c("l_partkey").alias("a"), (c("l_suppkey") * 20).alias("b")), ["accepted", "formal"])


EXT = "min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1"


@query(f"""WITH p AS (SELECT part_key, {EXT} FROM {P} WHERE class <> 'R' GROUP BY 1), m AS (SELECT part_key, {EXT} FROM {P} WHERE class = 'R' GROUP BY 1),
j AS (SELECT p.part_key, {', '.join(f"greatest(0, least(p.{a}1, m.{a}1) - greatest(p.{a}0, m.{a}0)) / greatest(1e-9, m.{a}1 - m.{a}0) AS s{a}, (p.{a}0 + p.{a}1 - m.{a}0 - m.{a}1) / 2 AS d{a}" for a in 'xyz')} FROM p JOIN m ON m.part_key = p.part_key)
SELECT part_key, round(least(sx, sy, sz), 4) AS axis_overlap, round(sx * sy * sz, 4) AS volume_overlap, round(sqrt(dx * dx + dy * dy + dz * dz), 4) AS centre_distance FROM j""")
def coordinate_preflight(s, d) -> DataFrame:
    p = points(s, d)
    return gt.preflight(p.filter("class <> 'R'"), p.filter("class = 'R'"), "part_key").select("part_key", r("axis_overlap"), r("volume_overlap"), r("centre_distance"))


CLAIM = "(SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, ['supports', 'hangs_on', 'touches'][l_linenumber % 3 + 1] AS relation, l_partkey AS a, l_suppkey AS b, ['contact', 'ray', 'proximity', 'guess'][l_quantity::INT % 4 + 1] AS method, CASE WHEN l_tax < 0.075 THEN l_tax END AS residual, CASE WHEN l_returnflag = 'A' THEN 'accepted' ELSE 'candidate' END AS state FROM lineitem)"


@query(f"""WITH j AS (SELECT c.*, CASE relation WHEN 'supports' THEN a WHEN 'hangs_on' THEN b END AS owner FROM {CLAIM} c), o AS (SELECT p_partkey AS k, p_size > 20 AS modelled FROM part WHERE p_partkey % 5 > 0),
q AS (SELECT j.*, o.k, o.modelled FROM j LEFT JOIN o ON o.k = owner)
SELECT id, list_aggregate(list_sort(list_filter([CASE WHEN owner IS NULL THEN 'unknown_relation' END, CASE WHEN owner IS NOT NULL AND k IS NULL THEN 'unregistered_owner' END, CASE WHEN k IS NOT NULL AND NOT modelled THEN 'owner_not_modelled' END, CASE WHEN method = 'proximity' THEN 'proximity_only' END,
CASE WHEN method NOT IN ('contact', 'ray') THEN 'method_not_listed' END, CASE WHEN residual IS NULL OR residual > 0.055 THEN 'residual' END, CASE WHEN state = 'accepted' THEN 'state' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS reasons FROM q
WHERE NOT coalesce(owner IS NOT NULL AND k IS NOT NULL AND modelled AND method IN ('contact', 'ray') AND residual <= 0.055 AND state <> 'accepted', false)""")
def support_claims(s, d) -> DataFrame:
    """Claims that are refused, with the reasons."""
    c = F.col
    pick = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))
    rows = load(s, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), pick(["supports", "hangs_on", "touches"], c("l_linenumber") % 3).alias("relation"), c("l_partkey").alias("a"),
                                         c("l_suppkey").alias("b"), pick(["contact", "ray", "proximity", "guess"], c("l_quantity").cast("int") % 4).alias("method"), F.when(c("l_tax") < 0.075, c("l_tax")).alias("residual"),
                                         F.when(c("l_returnflag") == "A", "accepted").otherwise("candidate").alias("state"))
    owners = load(s, d, "part").filter("p_partkey % 5 > 0").select(c("p_partkey").alias("id"), (c("p_size") > 20).alias("modelled"))
    return gt.claims(rows, owners, {"supports": "a", "hangs_on": "b"}, ["contact", "ray"], 0.055).filter("not accepted").select("id", "reasons")


ASSET = "(SELECT p_partkey AS id, ['mast', 'column', 'sign'][p_partkey % 3 + 1] AS class, p_size % 5 AS views, p_size % 7 > 0 AS shaft, CASE WHEN p_size % 11 > 0 THEN p_size % 2 = 0 END AS base, p_size / 50 AS occupancy, CASE WHEN p_size % 4 > 0 THEN p_size / 10 END AS clearance FROM part)"


@query(f"""SELECT id, class, concat_ws(',', CASE WHEN NOT views >= 2 THEN 'views' END, CASE WHEN NOT shaft THEN 'shaft' END, CASE WHEN NOT coalesce(base, false) THEN 'base' END, CASE WHEN NOT occupancy >= CASE class WHEN 'mast' THEN 0.65 WHEN 'column' THEN 0.65 ELSE 0.4 END THEN 'occupancy' END,
CASE WHEN class = 'mast' AND NOT coalesce(clearance >= 1, false) THEN 'clearance' END) AS reasons FROM {ASSET}""")
def vertical_asset_gate(s, d) -> DataFrame:
    c, n = F.col, F.col("p_size")
    kind = F.element_at(F.array(F.lit("mast"), F.lit("column"), F.lit("sign")), (c("p_partkey") % 3 + 1).cast("int"))
    a = load(s, d, "part").select(c("p_partkey").alias("id"), kind.alias("class"), (n % 5).alias("views"), (n % 7 > 0).alias("shaft"), F.when(n % 11 > 0, n % 2 == 0).alias("base"), (n / 50).alias("occupancy"), F.when(n % 4 > 0, n / 10).alias("clearance"))
    return gt.asset_gate(a, {"mast": 0.65, "column": 0.65, "sign": 0.4}, 1.0).select("id", "class", "reasons")


SCENE = "(SELECT l_suppkey, quantile_cont(l_discount, 0.9) AS p90, avg(CASE WHEN l_discount <= 0.05 THEN 1.0 ELSE 0.0 END) AS coverage, count(*) FILTER (l_discount > 0.09) AS unexplained, count(*) FILTER (l_discount > 0.09 AND l_quantity > 48) AS targets FROM lineitem WHERE l_linestatus = '{v}' GROUP BY 1)"


@query(f"""SELECT b.l_suppkey, coalesce(a.p90 < b.p90, false) AS p90_better, coalesce(a.coverage > b.coverage, false) AS coverage_better, coalesce(a.unexplained < b.unexplained, false) AS unexplained_better, coalesce(b.targets > 0 AND a.targets = 0, false) AS target_gone,
coalesce(a.p90 < b.p90 AND a.coverage > b.coverage AND a.unexplained < b.unexplained AND b.targets > 0 AND a.targets = 0, false) AS passed FROM {SCENE.format(v='O')} b LEFT JOIN {SCENE.format(v='F')} a ON a.l_suppkey = b.l_suppkey""")
def candidate_before_after(s, d) -> DataFrame:
    c = F.col
    n = lambda x: F.count(F.when(x, 1))
    side = lambda v: load(s, d, "lineitem").filter(c("l_linestatus") == v).groupBy("l_suppkey").agg(F.percentile("l_discount", 0.9).alias("p90"), F.avg(F.when(c("l_discount") <= 0.05, 1.0).otherwise(0.0)).alias("coverage"), n(c("l_discount") > 0.09).alias("unexplained"), n((c("l_discount") > 0.09) & (c("l_quantity") > 48)).alias("targets"))
    return gt.before_after(side("O"), side("F"), "l_suppkey")


@query("""WITH dense AS (SELECT l_orderkey AS id, avg(l_discount) AS green FROM lineitem GROUP BY 1), photo AS (SELECT l_orderkey AS id, count(DISTINCT l_suppkey) AS views FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1), attr AS (SELECT l_orderkey AS id, max(l_tax) AS excess FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT o_orderkey AS id, dense.id IS NOT NULL AND photo.id IS NOT NULL AND attr.id IS NOT NULL AS complete, coalesce(green >= 0.05 AND views >= 2 AND excess >= 0.04, false) AS closed FROM orders LEFT JOIN dense ON dense.id = o_orderkey LEFT JOIN photo ON photo.id = o_orderkey LEFT JOIN attr ON attr.id = o_orderkey""")
def residual_closures(s, d) -> DataFrame:
    li, k = load(s, d, "lineitem"), F.col("l_orderkey").alias("id")
    sides = {"dense": li.groupBy(k).agg(F.avg("l_discount").alias("green")), "photo": li.filter("l_returnflag <> 'A'").groupBy(k).agg(F.count_distinct("l_suppkey").alias("views")), "attr": li.filter("l_linestatus = 'O'").groupBy(k).agg(F.max("l_tax").alias("excess"))}
    ok = (F.col("green") >= 0.05) & (F.col("views") >= 2) & (F.col("excess") >= 0.04)
    return gt.closures(load(s, d, "orders").select(F.col("o_orderkey").alias("id")), sides, ok)


@query("SELECT l_linestatus, count(*) AS n, count(*) FILTER (abs(l_discount - 0.05) <= 0.031 AND abs(l_tax) <= 0.051 AND abs(l_quantity - 25) <= 20) AS passed FROM lineitem GROUP BY 1")
def interface_limits(s, d) -> DataFrame:
    m = load(s, d, "lineitem").select("l_linestatus", (F.col("l_discount") - 0.05).alias("spacing"), F.col("l_tax").alias("offset"), (F.col("l_quantity") - 25).alias("gap"))
    ok = gt.within_limits(m, {"spacing": 0.031, "offset": 0.051, "gap": 20.0})
    return m.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(ok, 1)).alias("passed"))


CORNER = [("x0", "y0", "z0"), ("x1", "y0", "z0"), ("x1", "y1", "z0"), ("x0", "y1", "z1"), ("x0", "y0", "z0")]
FACES = [(0, 1, 2), (0, 2, 3), (2, 1, 0), (0, 4, 1), (1, 2, 9)]


@query(f"""SELECT box_id AS object, 5 AS vertices, 0 AS not_finite, 1 AS duplicate_places, CASE WHEN p_size % 2 = 0 THEN 5 ELSE 2 END AS faces, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS bad_index, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS degenerate, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS duplicate_faces,
CASE WHEN p_size % 2 = 0 THEN 6 ELSE 4 END AS open_edges FROM {BOX}""")
def mesh_audit(s, d) -> DataFrame:
    """Parts as small meshes: two triangles that share an edge, and for half of them a repeated, a flat and a broken one."""
    c = candidates(s, d)
    at = lambda i, n: F.struct(F.lit(i).alias("vid"), *[F.col(k).alias(a) for k, a in zip(n, "xyz")])
    v = c.select(F.col("box_id").alias("object"), F.explode(F.array(*[at(i, n) for i, n in enumerate(CORNER)])).alias("v")).select("object", "v.*")
    face = lambda i, f: F.struct(F.lit(i).alias("fid"), *[F.lit(k).alias(a) for k, a in zip(f, "abc")])
    some = F.when(F.col("p_size") % 2 == 0, F.array(*[face(i, f) for i, f in enumerate(FACES)])).otherwise(F.array(*[face(i, f) for i, f in enumerate(FACES[:2])]))
    return gt.mesh_audit(v, c.select(F.col("box_id").alias("object"), F.explode(some).alias("f")).select("object", "f.*"), 1e-9)


@query("""WITH a AS (SELECT p_partkey AS k, sha256(p_name) AS h FROM part WHERE p_partkey % 7 > 0), b AS (SELECT p_partkey AS k, sha256(CASE WHEN p_size = 13 THEN p_type ELSE p_name END) AS h FROM part WHERE p_partkey % 5 > 0)
SELECT CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'added' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS state, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1""")
def lineage_lock(s, d) -> DataFrame:
    p, k = load(s, d, "part"), F.col("p_partkey").alias("k")
    a = p.filter("p_partkey % 7 > 0").select(k, F.sha2("p_name", 256).alias("h"))
    b = p.filter("p_partkey % 5 > 0").select(k, F.sha2(F.when(F.col("p_size") == 13, F.col("p_type")).otherwise(F.col("p_name")), 256).alias("h"))
    return gt.locked(a, b, "k", "h").groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def own(key: str) -> Column:
    """The key of a part as an asset."""
    return F.struct(F.lit(False).alias("made"), F.col(key).alias("id")).alias("asset")


def made(key: str) -> Column:
    """The key of an asset made from a part: its number may be that of a part, so made assets are told apart from those."""
    return F.struct(F.lit(True).alias("made"), (F.col(key) + 1000000).alias("id")).alias("asset")


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN p_partkey ELSE p_partkey END AS p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part UNION ALL SELECT p_partkey + 1000000, p_size FROM part WHERE p_partkey % 6 = 0")
def registry_import(s, d) -> DataFrame:
    base = load(s, d, "part").select(own("p_partkey"), "p_size")
    new = base.filter("asset.id % 4 = 0").withColumn("p_size", F.col("p_size") + 1).union(base.filter("asset.id % 6 = 0").withColumn("asset", made("asset.id")))
    return gt.import_records(base, new, "asset", True).select(F.col("asset.id").alias("p_partkey"), "p_size")


@query("""SELECT p_partkey, CASE WHEN u THEN 'reviewed' ELSE 'candidate' END AS state, CASE WHEN u THEN p_size || ';' || (p_size + 1) || ';' || p_brand ELSE p_size || ';old;' END AS parameters, CASE WHEN u THEN 'a,b' || CASE WHEN p_size % 2 = 0 THEN '' ELSE ',c' END ELSE 'a,b' END AS limits,
CASE WHEN u THEN 'updated' ELSE 'kept' END AS change FROM (SELECT *, p_partkey % 3 = 0 AS u FROM part) UNION ALL SELECT p_partkey + 1000000, 'new', p_size || ';;', '', 'added' FROM part WHERE p_partkey % 10 = 0""")
def additive_patch(s, d) -> DataFrame:
    c, text = F.col, lambda x: x.cast("string")
    p = load(s, d, "part")
    lits = lambda *x: F.array(*[F.lit(v) for v in x])
    base = p.select(own("p_partkey"), F.lit("candidate").alias("state"), F.create_map(F.lit("size"), text(c("p_size")), F.lit("next"), F.lit("old")).alias("parameters"), lits("a", "b").alias("limits"))
    updates = p.filter("p_partkey % 3 = 0").select(own("p_partkey"), F.lit("reviewed").alias("state"), F.create_map(F.lit("next"), text(c("p_size") + 1), F.lit("brand"), c("p_brand")).alias("parameters"),
                                                   F.when(c("p_size") % 2 == 0, lits("b")).otherwise(lits("b", "c")).alias("limits"))
    none = F.array().cast("array<string>").alias("limits")
    fresh = p.filter("p_partkey % 10 = 0").select(made("p_partkey"), F.lit("new").alias("state"), F.create_map(F.lit("size"), text(c("p_size"))).alias("parameters"), none)
    same = base.filter("asset.id % 50 = 1")  # added again: no change
    out = gt.additive_patch(base, updates, fresh.unionByName(same), "asset", ["state"])
    show = F.concat_ws(";", *[F.coalesce(c("parameters")[k], F.lit("")) for k in ("size", "next", "brand")])
    return out.select(c("asset.id").alias("p_partkey"), "state", show.alias("parameters"), F.array_join("limits", ",").alias("limits"), "change")


@query("SELECT p_brand, count(*) AS gaps, count(d.k) AS closed, count(*) - count(d.k) AS open, round(count(d.k) / count(*), 4) AS share FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45 AND l_tax < 0.02) d ON d.k = p_partkey GROUP BY 1")
def gap_completion(s, d) -> DataFrame:
    done = load(s, d, "lineitem").filter("l_quantity > 45 and l_tax < 0.02").select(F.col("l_partkey").alias("p_partkey"))
    return gt.completion(load(s, d, "part"), done, "p_partkey", "p_brand").select("p_brand", "gaps", "closed", "open", r("share"))


FAULTS = {"reversed_frame": "direction", "gauge_drift": "gauge", "crosslevel": "crosslevel", "low_support": "support", "broken_seam": "seams", "track_birth": "termination", "duplicate_track": "duplicates"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS fault, '{v}' AS expected, true AS detected" for k, v in FAULTS.items()) + " UNION ALL SELECT 'none', 'none', true")
def defect_detection(s, d) -> DataFrame:
    """A graph of two tracks that passes everything, and a copy of it with each of seven faults: every fault must fail its check and no other graph may fail."""
    c = F.col
    names = F.explode(F.array(*[F.lit(n) for n in ("none", *FAULTS)])).alias("project")
    base = load(s, d, "nation").select(F.col("n_nationkey").alias("i")).filter("i < 10").select(names, F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("track"), "i")
    base = base.filter("track < 3 or project = 'duplicate_track'")
    first = (c("i") == 4) & (c("track") == 1)
    fault = lambda name, bad, good: F.when((c("project") == name) & first, bad).otherwise(good)
    lat = c("track") * 4.0 - F.when(c("track") == 3, 3.9).otherwise(0.0)
    obs = base.withColumns({"id": F.concat_ws("-", "project", "track", "i"), "c0": c("i") * 10.0, "c1": c("i") * 10.0 + 10, "lat": lat, "lat0": lat, "lat1": fault("broken_seam", lat + 0.6, lat),
                            **{k: F.lit(5.0) for k in ("z", "z0", "z1")}, "gauge": fault("gauge_drift", 1.46, 1.435), "direction": fault("reversed_frame", -0.9, 1.0), "determinant": F.lit(1.0),
                            "crosslevel": fault("crosslevel", 0.08, 0.01), "reported": fault("crosslevel", 0.08, 0.01), "correction": F.lit(0.0), "support": fault("low_support", 0.1, 0.9), "joint": F.lit(0.9), "onesided": F.lit(0.0),
                            "internal_gap": F.lit(0.0), "paired": F.lit(True), "joined": F.lit(True), "evidence": F.lit("observed")})
    obs = obs.filter((c("project") != "track_birth") | (c("track") != 2) | (c("i") >= 4))
    far = obs.select("project").distinct().select("project", F.explode(F.array(F.lit(0.0), F.lit(200.0))).alias("chainage")).withColumn("x", c("chainage")).withColumn("y", F.lit(0.0))
    ends = tr.nodes(obs, far)
    edges = obs.select("project", "track", "id", F.concat("id", F.lit(":start")).alias("from_node"), F.concat("id", F.lit(":end")).alias("to_node"), "c0", "c1", "evidence")
    sources = obs.groupBy("project", "i").agg(F.count(F.lit(1)).alias("pairs")).withColumn("review", F.lit("accepted"))
    found = tr.audit(obs, tr.summaries(obs), ends, edges, tr.seams(obs, ends), sources, obs.select("project", F.lit(False).alias("crossing"))).filter("failures > 0")
    expected = F.coalesce(*[F.when(c("project") == k, v) for k, v in FAULTS.items()], F.lit("none"))
    seen = found.groupBy("project").agg(F.collect_set("check_id").alias("failed"))
    rows = obs.select("project").distinct().join(seen, "project", "left").withColumn("expected", expected)
    hit = F.when(c("expected") == "none", c("failed").isNull()).otherwise(F.coalesce(F.array_contains("failed", c("expected")), F.lit(False)))
    return rows.select(c("project").alias("fault"), "expected", hit.alias("detected"))


@query("""WITH a AS (SELECT o_custkey AS release, 'A' || o_orderkey AS id, NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS ok FROM orders),
g AS (SELECT c_custkey AS release, count(id) AS n_assets, count(*) FILTER (NOT ok) AS n_blocking, coalesce(array_to_string(list_sort(list(id) FILTER (NOT ok))[1:20], ','), '') AS blocking, string_agg(id, chr(10) ORDER BY id) AS ids FROM customer LEFT JOIN a ON release = c_custkey GROUP BY 1)
SELECT release, CASE WHEN n_assets = 0 THEN 'empty' WHEN n_blocking > 0 THEN 'blocked' ELSE 'frozen' END AS state, n_assets, n_blocking, blocking, CASE WHEN n_assets > 0 AND n_blocking = 0 THEN sha256(ids) END AS asset_set_sha256 FROM g""")
def registry_freeze(s, d) -> DataFrame:
    """A customer's orders as the assets of a release; urgent ones that are pending block it."""
    c = F.col
    status = F.when((c("o_orderstatus") == "P") & (c("o_orderpriority") == "1-URGENT"), "candidate").otherwise("accepted")
    assets = load(s, d, "orders").select(c("o_custkey").alias("release"), F.concat(F.lit("A"), "o_orderkey").alias("id"), status.alias("status"))
    return freeze.freeze_releases(load(s, d, "customer").select(c("c_custkey").alias("release")), assets)
