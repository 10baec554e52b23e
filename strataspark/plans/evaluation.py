"""Queries that evaluate: suppliers are truth, customers findings of the same nation, line items measurements and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import metrics
from ..sources.tables import load
from .catalogue import query, r

TRUTH = "(SELECT s_suppkey AS id, s_nationkey AS block, s_acctbal AS center, 't' || s_suppkey % 3 AS type FROM supplier WHERE s_acctbal > 0)"
FOUND = "(SELECT c_custkey AS id, c_nationkey AS block, c_acctbal AS center, 't' || c_custkey % 3 AS type FROM customer WHERE c_mktsegment <> 'MACHINERY')"
PAIRS = f"""(SELECT truth_id, found_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY truth_id ORDER BY distance, found_id) AS a, row_number() OVER (PARTITION BY found_id ORDER BY distance, truth_id) AS b FROM
(SELECT t.id AS truth_id, f.id AS found_id, abs(t.center - f.center) AS distance FROM {TRUTH} t JOIN {FOUND} f ON t.block = f.block AND abs(t.center - f.center) <= 400)) WHERE a = 1 AND b = 1)"""


def sides(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    kind = lambda k: F.concat(F.lit("t"), F.col(k) % 3)
    t = load(s, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("block"), F.col("s_acctbal").alias("center"), kind("s_suppkey").alias("type"))
    f = load(s, d, "customer").filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("block"), F.col("c_acctbal").alias("center"), kind("c_custkey").alias("type"))
    return t, f, ev.mutual_matches(t, f, 400.0)


@query(f"SELECT truth_id, found_id, round(distance, 4) AS distance FROM {PAIRS}")
def mutual_block_matches(s, d) -> DataFrame:
    return sides(s, d)[2].select("truth_id", "found_id", r("distance"))


PRF = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall"
F1 = "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END AS f1"


@query(f"""WITH j AS (SELECT t.id AS ti, t.type AS tt, f.id AS fi, f.type AS ft FROM {TRUTH} t FULL JOIN {PAIRS} p ON p.truth_id = t.id FULL JOIN {FOUND} f ON f.id = p.found_id),
x AS (SELECT 'detection' AS label, (ti IS NOT NULL AND fi IS NOT NULL)::INT AS tp, (ti IS NULL)::INT AS fp, (fi IS NULL)::INT AS fn FROM j UNION ALL SELECT tt, (fi IS NOT NULL AND tt = ft)::INT, 0, (fi IS NULL OR tt <> ft)::INT FROM j WHERE ti IS NOT NULL
UNION ALL SELECT ft, 0, 1, 0 FROM j WHERE fi IS NOT NULL AND (ti IS NULL OR tt <> ft)), n AS (SELECT label, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM x GROUP BY 1), q AS (SELECT *, {PRF} FROM n), k AS (SELECT *, {F1} FROM q)
SELECT label, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM k UNION ALL SELECT 'macro', NULL, NULL, NULL, NULL, NULL, round(avg(f1), 4) FROM k WHERE label <> 'detection'""")
def asset_matching_mutual(s, d) -> DataFrame:
    t, f, p = sides(s, d)
    return ev.matched_scores(t, f, p).select("label", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


REL = "(SELECT 'next' AS type, id AS a, nxt AS b FROM (SELECT id, lead(id) OVER (PARTITION BY block ORDER BY {o}) AS nxt FROM {t}) WHERE nxt IS NOT NULL)"
TREL, FREL = REL.format(o="center, id", t=TRUTH), REL.format(o="center, id", t=f"(SELECT f.* FROM {FOUND} f WHERE id IN (SELECT found_id FROM {PAIRS}) OR id % 5 = 0)")


@query(f"""WITH g AS (SELECT DISTINCT r.type, coalesce('t' || x.truth_id, 'f' || r.a) AS a, coalesce('t' || y.truth_id, 'f' || r.b) AS b, x.truth_id IS NOT NULL AND y.truth_id IS NOT NULL AS known FROM {FREL} r LEFT JOIN {PAIRS} x ON x.found_id = r.a LEFT JOIN {PAIRS} y ON y.found_id = r.b),
t AS (SELECT DISTINCT type, 't' || a AS a, 't' || b AS b, a IN (SELECT truth_id FROM {PAIRS}) AND b IN (SELECT truth_id FROM {PAIRS}) AS held FROM {TREL}),
j AS (SELECT t.a IS NOT NULL AS real, coalesce(held, false) AS held, g.a IS NOT NULL AS guess, coalesce(known, false) AS known FROM g FULL JOIN t ON g.type = t.type AND g.a = t.a AND g.b = t.b),
n AS (SELECT 'end_to_end' AS scope, count(*) FILTER (real AND guess) AS tp, count(*) FILTER (guess AND NOT real) AS fp, count(*) FILTER (real AND NOT guess) AS fn FROM j
UNION ALL SELECT 'conditional', count(*) FILTER (real AND held AND guess AND known), count(*) FILTER (guess AND known AND NOT (real AND held)), count(*) FILTER (real AND held AND NOT (guess AND known)) FROM j), q AS (SELECT *, {PRF} FROM n)
SELECT scope, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM (SELECT *, {F1} FROM q)""")
def topology_metrics_v2(s, d) -> DataFrame:
    t, f, p = sides(s, d)
    after = F.lead("id").over(Window.partitionBy("block").orderBy("center", "id"))
    rel = lambda x: x.select(F.lit("next").alias("type"), F.col("id").alias("a"), after.alias("b")).filter("b is not null")
    held = f.join(p.select(F.col("found_id").alias("id"), F.lit(True).alias("in")), "id", "left").filter("in or id % 5 = 0")
    return ev.topology_scores(rel(t), rel(held), p).select("scope", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


STATUS = "CASE WHEN o_orderpriority < '2' THEN 'supported' WHEN o_orderpriority < '3' THEN 'confirmed_false' WHEN o_orderpriority < '5' THEN 'unsupported' ELSE 'unverifiable' END"
NAMES = ["supported", "confirmed_false", "unsupported", "unverifiable"]


@query(f"""WITH n AS (SELECT o_orderstatus AS status, count(*) AS predictions, count(*) FILTER (o_totalprice > 100000) AS released, {', '.join(f"count(*) FILTER (o_totalprice > 100000 AND {STATUS} = '{k}') AS {k}" for k in NAMES)} FROM orders GROUP BY 1)
SELECT status, predictions, released, round(released / predictions, 4) AS coverage, {', '.join(f"round({k} / nullif(released, 0), 4) AS {k}_rate" for k in NAMES)} FROM n""")
def evidence_release_rates(s, d) -> DataFrame:
    o = load(s, d, "orders").withColumn("status", F.col("o_orderstatus"))
    out = ev.release_rates(o, F.col("o_totalprice") > 100000, F.expr(STATUS), NAMES, ("status",))
    return out.select("status", "predictions", "released", r("coverage"), *[r(f"{k}_rate") for k in NAMES])


@query("""WITH m AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'raw' ELSE 'constrained' END AS stage, abs(l_discount - 0.045) AS e, l_tax AS c, CASE WHEN l_quantity > 5 THEN 0.03 END AS tol FROM lineitem)
SELECT stage, count(*) AS n, round(avg(e), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse, round(quantile_cont(e, 0.9), 4) AS p90, round(avg(c), 4) AS mean_correction, round(count(*) FILTER (e <= tol + 1e-12) / nullif(count(tol), 0), 4) AS within_tolerance FROM m GROUP BY 1""")
def gauge_measurements(s, d) -> DataFrame:
    m = load(s, d, "lineitem").select(F.when(F.col("l_linestatus") == "O", "raw").otherwise("constrained").alias("stage"), F.abs(F.col("l_discount") - 0.045).alias("e"),
                                      F.col("l_tax").alias("c"), F.when(F.col("l_quantity") > 5, 0.03).alias("tol"))
    return m.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), r(F.avg("e"), "mae"), r(F.sqrt(F.avg(F.col("e") * F.col("e"))), "rmse"), r(F.expr("percentile(e, 0.9)"), "p90"), r(F.avg("c"), "mean_correction"),
                                  r(ev.ratio(F.count(F.when(F.col("e") <= F.col("tol") + 1e-12, 1)), F.count("tol")), "within_tolerance"))


@query("""WITH c AS (SELECT l_discount * 9.7 AS p, l_returnflag = 'R' AS ok, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
b AS (SELECT least(9, floor(p * 10)) AS bin, count(*) AS n, avg(p) AS conf, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS acc FROM c GROUP BY 1),
k AS (SELECT row_number() OVER w AS i, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER w AS e, count(*) OVER () AS n FROM c WINDOW w AS (ORDER BY p DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING))
SELECT (SELECT count(*) FROM c) AS n, (SELECT round(avg((p - ok::INT) * (p - ok::INT)), 4) FROM c) AS brier, (SELECT round(sum(n * abs(conf - acc)) / sum(n), 4) FROM b) AS ece, round(avg(e / i), 4) AS aurc, round(max(e / i) FILTER (i = (n + 1) // 2), 4) AS risk_at_half FROM k""")
def calibration_summary(s, d) -> DataFrame:
    c = load(s, d, "lineitem").select((F.col("l_discount") * 9.7).alias("p"), (F.col("l_returnflag") == "R").alias("ok"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = ev.confidence_summary(c, "p", F.col("ok"), [F.col(k) for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return out.select("n", r("brier"), r("ece"), r("aurc"), r("risk_at_half"))


V1 = "(SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus END AS t, CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderpriority < '3' THEN 'F' WHEN o_orderpriority < '5' THEN 'O' ELSE 'P' END END AS g FROM orders)"


@query(f"""WITH x AS (SELECT 'detection' AS label, count(*) FILTER (t IS NOT NULL AND g IS NOT NULL) AS tp, count(*) FILTER (t IS NULL AND g IS NOT NULL) AS fp, count(*) FILTER (t IS NOT NULL AND g IS NULL) AS fn FROM {V1}
UNION ALL SELECT k, count(*) FILTER (t = k AND g = k), count(*) FILTER (g = k AND t IS DISTINCT FROM k), count(*) FILTER (t = k AND g IS DISTINCT FROM k) FROM {V1}, (VALUES ('F'), ('O'), ('P')) v(k) GROUP BY 1),
q AS (SELECT *, {PRF} FROM x), y AS (SELECT *, {F1} FROM q)
SELECT label, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, CASE WHEN label = 'detection' THEN round(fp / nullif(tp + fp, 0), 4) END AS hallucination FROM y
UNION ALL SELECT 'macro', NULL, NULL, NULL, NULL, NULL, round(avg(f1), 4), NULL FROM y WHERE label <> 'detection'""")
def detection_metrics(s, d) -> DataFrame:
    """Truth and guess of one row each, either of which may be missing."""
    c = F.col
    guess = F.when(c("o_orderpriority") < "3", "F").when(c("o_orderpriority") < "5", "O").otherwise("P")
    o = load(s, d, "orders").select(c("o_orderkey").alias("id"), F.when(c("o_orderkey") % 7 > 0, c("o_orderstatus")).alias("t"), F.when(c("o_orderkey") % 5 > 0, guess).alias("g"))
    side = lambda k: o.filter(f"{k} is not null").select("id", c(k).alias("type"))
    both = o.filter("t is not null and g is not null").select(c("id").alias("truth_id"), c("id").alias("found_id"))
    out = ev.matched_scores(side("t"), side("g"), both)
    wrong = F.when(c("label") == "detection", ev.ratio(c("fp"), c("tp") + c("fp")))
    return out.select("label", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"), r(wrong, "hallucination"))


@query("""WITH n AS (SELECT event_type, count(*) FILTER (value > 80 AND user_id % 2 = 0) AS tp, count(*) FILTER (value > 80 AND user_id % 2 = 1) AS fp, count(*) FILTER (value <= 80 AND user_id % 10 = 0) AS fn FROM events GROUP BY 1)
SELECT event_type, tp, fp, fn, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 4) AS f1 FROM n""")
def count_form_scores(s, d) -> DataFrame:
    n = lambda c: F.count(F.when(F.expr(c), 1))
    e = load(s, d, "events").groupBy("event_type").agg(n("value > 80 and user_id % 2 = 0").alias("tp"), n("value > 80 and user_id % 2 = 1").alias("fp"), n("value <= 80 and user_id % 10 = 0").alias("fn"))
    return ev.count_scores(e).select("event_type", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


MASK = "count(*) FILTER (t AND g) AS tp, count(*) FILTER (g AND NOT t) AS fp, count(*) FILTER (t AND NOT g) AS fn, count(*) FILTER (NOT t AND NOT g) AS tn"


@query(f"""WITH m AS (SELECT l_discount >= 0.05 AS t, l_tax >= 0.04 AS g, l_returnflag <> 'N' AS annotated FROM lineitem), n AS (SELECT 'all_points' AS scope, {MASK} FROM m UNION ALL SELECT 'annotated_only', {MASK} FROM m WHERE annotated)
SELECT scope, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall, round(tp / nullif(tp + fp + fn, 0), 4) AS iou FROM n""")
def mask_scopes(s, d) -> DataFrame:
    li = load(s, d, "lineitem")
    scope = F.explode(F.when(F.col("l_returnflag") != "N", F.array(F.lit("all_points"), F.lit("annotated_only"))).otherwise(F.array(F.lit("all_points"))))
    out = metrics.confusion(li.withColumn("scope", scope), F.col("l_discount") >= 0.05, F.col("l_tax") >= 0.04, ("scope",))
    return out.select("scope", "tp", "fp", "fn", "tn", r("precision"), r("recall"), r("iou"))


@query("""WITH t AS (SELECT DISTINCT l_partkey AS e, l_returnflag AS k FROM lineitem WHERE l_quantity > 48), f AS (SELECT l_partkey AS e, CASE WHEN l_tax < 0.06 THEN l_returnflag ELSE 'R' END AS k FROM lineitem WHERE l_quantity > 47 AND l_discount > 0.02),
x AS (SELECT 'diagnosis' AS level, t.e IS NOT NULL AS t, m FROM t FULL JOIN (SELECT e, k, count(*) AS m FROM f GROUP BY 1, 2) f ON t.e = f.e AND t.k = f.k UNION ALL SELECT 'detection', t.e IS NOT NULL, m FROM (SELECT DISTINCT e FROM t) t FULL JOIN (SELECT e, count(*) AS m FROM f GROUP BY 1) f ON t.e = f.e),
n AS (SELECT level, count(*) FILTER (t AND m IS NOT NULL) AS tp, coalesce(sum(CASE WHEN t THEN m - 1 ELSE m END), 0)::BIGINT AS fp, count(*) FILTER (m IS NULL) AS fn FROM x GROUP BY 1)
SELECT level, tp, fp, fn, round(tp / nullif(tp + fp, 0), 4) AS precision, round(tp / nullif(tp + fn, 0), 4) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 4) AS f1 FROM n""")
def strict_entity_match(s, d) -> DataFrame:
    li = load(s, d, "lineitem")
    t = li.filter("l_quantity > 48").select(F.col("l_partkey").alias("e"), F.col("l_returnflag").alias("k")).distinct()
    f = li.filter("l_quantity > 47 and l_discount > 0.02").select(F.col("l_partkey").alias("e"), F.when(F.col("l_tax") < 0.06, F.col("l_returnflag")).otherwise("R").alias("k"))
    out = [ev.strict_matches(t, f, keys).withColumn("level", F.lit(n)) for n, keys in (("diagnosis", ["e", "k"]), ("detection", ["e"]))]
    return ev.count_scores(out[0].union(out[1])).select("level", "tp", "fp", "fn", r("precision"), r("recall"), r("f1"))


@query("""WITH c AS (SELECT l_returnflag AS truth, CASE WHEN l_tax >= 0.07 THEN 'abstain' WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS said FROM lineitem)
SELECT truth, said, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY truth), 4) AS share, round(sum(CASE WHEN truth = said THEN count(*) ELSE 0 END) OVER () / sum(CASE WHEN said <> 'abstain' THEN count(*) ELSE 0 END) OVER (), 4) AS selective_accuracy FROM c GROUP BY 1, 2""")
def abstention_diagnosis(s, d) -> DataFrame:
    c = F.col
    said = F.when(c("l_tax") >= 0.07, "abstain").when(c("l_discount") < 0.03, "A").when(c("l_discount") < 0.07, "N").otherwise("R")
    cells = load(s, d, "lineitem").groupBy(c("l_returnflag").alias("truth"), said.alias("said")).agg(F.count(F.lit(1)).alias("n"))
    whole = cells.agg((F.sum(F.when(c("truth") == c("said"), c("n")).otherwise(0)) / F.sum(F.when(c("said") != "abstain", c("n")).otherwise(0))).alias("a"))
    return cells.withColumn("share", c("n") / F.sum("n").over(Window.partitionBy("truth"))).crossJoin(whole).select("truth", "said", "n", r("share"), r("a", "selective_accuracy"))  # one row


TIMES = " + ".join(f"(u >= {x})::INT" for x in ev.poisson_steps())


@query(f"""WITH k AS (SELECT l_suppkey, avg(l_discount * 2 - l_tax - 0.059) AS d FROM lineitem GROUP BY 1), u AS (SELECT *, ('0x' || substr(sha256(concat_ws(',', 7, draw, l_suppkey)), 1, 8))::BIGINT / 4294967296.0 AS u FROM k, (SELECT unnest(range(0, 400)) AS draw)),
m AS (SELECT draw, sum(d * t) / nullif(sum(t), 0) AS m FROM (SELECT *, {TIMES} AS t FROM u) GROUP BY 1)
SELECT (SELECT count(*) FROM k) AS n, (SELECT round(avg(d), 6) FROM k) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high, round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 4) AS better, (SELECT min(d) = max(d) FROM k) AS degenerate FROM m""")
def layout_interval(s, d) -> DataFrame:
    rows = load(s, d, "lineitem").select("l_suppkey", (F.col("l_discount") * 2 - F.col("l_tax") - 0.059).alias("d"))
    return ev.paired_interval(rows, "l_suppkey", "d", 400, 7).select("n", F.round("mean", 6).alias("mean"), F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), r("better"), "degenerate")


VAR = "(SELECT p_brand, p_partkey, p_size, p_retailprice AS cost, p_partkey % 11 AS recall, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1 AS base FROM part)"


@query(f"""WITH b AS (SELECT p_brand, recall AS br, cost AS bc FROM {VAR} WHERE base) SELECT v.p_brand, arg_min(p_partkey, (p_size, p_partkey)) AS chosen, min(p_size) AS p_size, count(*) AS passing FROM {VAR} v JOIN b ON v.p_brand = b.p_brand WHERE recall >= br - 2 AND cost <= bc + 50 GROUP BY 1""")
def guardrail_variant_choice(s, d) -> DataFrame:
    c = F.col
    v = load(s, d, "part").select("p_brand", "p_partkey", "p_size", c("p_retailprice").alias("cost"), (c("p_partkey") % 11).alias("recall"))
    v = v.withColumn("base", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) == 1)
    return ev.guarded_choice(v, "p_brand", "p_partkey", c("base"), "p_size", {"recall": 2}, {"cost": 50})


COUNTS = "(SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem WHERE {w} GROUP BY 1)"


@query(f"""SELECT x.l_suppkey, (y.a > x.a)::INT + (y.b > x.b)::INT + (y.c > x.c)::INT AS regressed, (y.c < x.c)::INT AS improved, y.a <= x.a AND y.b <= x.b AND y.c < x.c AS accepted
FROM {COUNTS.format(w="l_linestatus = 'O'")} x JOIN {COUNTS.format(w="l_linestatus = 'F'")} y ON x.l_suppkey = y.l_suppkey""")
def pareto_acceptance(s, d) -> DataFrame:
    n = lambda f: F.count(F.when(F.col("l_returnflag") == f, 1))
    side = lambda v: load(s, d, "lineitem").filter(F.col("l_linestatus") == v).groupBy("l_suppkey").agg(n("A").alias("a"), n("N").alias("b"), n("R").alias("c"))
    return ev.no_worse(side("O"), side("F"), "l_suppkey", ["a", "b"], ["c"])


@query("""WITH x AS (SELECT l_partkey, avg(l_discount) AS m FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), y AS (SELECT l_partkey, avg(l_discount) AS m FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT CASE WHEN abs(y.m - x.m) < 1e-9 THEN 'tie' WHEN y.m < x.m THEN 'trial' ELSE 'base' END AS winner, count(*) AS n, round(avg(y.m - x.m), 4) + 0 AS delta FROM x JOIN y ON x.l_partkey = y.l_partkey GROUP BY 1""")
def paired_winner(s, d) -> DataFrame:
    side = lambda v: load(s, d, "lineitem").filter(F.col("l_linestatus") == v).groupBy("l_partkey").agg(F.round(F.avg("l_discount"), 9).alias("m"))
    return ev.paired_winner(side("O"), side("F"), "l_partkey", "m").groupBy("winner").agg(F.count(F.lit(1)).alias("n"), (F.round(F.avg("delta"), 4) + 0).alias("delta"))


RATE = "SELECT quality AS a, toxic AS b, doc_id FROM labels"


@query(f"""SELECT 'consensus' AS split, a::VARCHAR AS rating, count(*) AS n FROM ({RATE}) WHERE a = b GROUP BY 2 UNION ALL SELECT 'disagreement', a || '/' || b, count(*) FROM ({RATE}) WHERE a <> b GROUP BY 2
UNION ALL SELECT 'incomplete', 'null', count(*) FROM ({RATE}) WHERE a IS NULL OR b IS NULL HAVING count(*) > 0""")
def consensus_split(s, d) -> DataFrame:
    a, b = F.col("quality"), F.col("toxic")
    split = F.when(a.isNull() | b.isNull(), "incomplete").when(a == b, "consensus").otherwise("disagreement")
    text = F.when(split == "incomplete", "null").when(a == b, a.cast("string")).otherwise(F.concat_ws("/", a, b))
    return load(s, d, "labels").groupBy(split.alias("split"), text.alias("rating")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) FILTER (a.k IS NULL) AS only_second, count(*) FILTER (b.k IS NULL) AS only_first, count(*) FILTER (a.k = b.k) AS both, count(*) FILTER (a.k IS NULL OR b.k IS NULL) = 0 AS equal
FROM (SELECT DISTINCT doc_id AS k FROM labels) a FULL JOIN (SELECT DISTINCT doc_id AS k FROM documents WHERE doc_id % 3 > 0) b ON a.k = b.k""")
def task_set_equality(s, d) -> DataFrame:
    a = load(s, d, "labels").select(F.col("doc_id").alias("k")).distinct().withColumn("a", F.lit(True))
    b = load(s, d, "documents").filter("doc_id % 3 > 0").select(F.col("doc_id").alias("k")).distinct().withColumn("b", F.lit(True))
    n = lambda c: F.count(F.when(c, 1))
    out = a.join(b, "k", "full").agg(n(F.col("a").isNull()).alias("only_second"), n(F.col("b").isNull()).alias("only_first"), n(F.col("a") & F.col("b")).alias("both"))
    return out.withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))
