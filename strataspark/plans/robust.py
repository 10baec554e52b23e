"""Queries of robust fits: traces in a supplier's prices over quantities, and spans of a part's orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import robust
from ..sources.tables import load
from .catalogue import query, r

TRACES = robust.TraceLimits(cell=0.05, hypotheses=32, least_apart=5, steepest=3, tolerance=0.3, least_points=8, least_span=8, bin=2, removed=0.6, traces=3)
SAG = robust.SagLimits(bin=2, margin=0.6, least_points=1, least_bins=10, rounds=4, tightest=0.035, widest=0.15, least_kept=0.7, most_p90=0.1, least_sag=0.05)


def traces_sql(t: robust.TraceLimits) -> str:
    """The rounds written out one below the other."""
    off = "abs(l.z - {a}.slope * l.u - {a}.intercept)"
    parts = [f"""l1 AS MATERIALIZED (SELECT k, cu, cz, u, z FROM (SELECT *, row_number() OVER (PARTITION BY k, cu, cz ORDER BY u, z) AS i FROM
(SELECT l_suppkey AS k, l_quantity AS u, l_extendedprice / 1000 AS z, floor(l_quantity / {t.cell}::DOUBLE + 0.5)::BIGINT AS cu, floor(l_extendedprice / 1000 / {t.cell}::DOUBLE + 0.5)::BIGINT AS cz FROM lineitem)) WHERE i = 1)"""]
    for n in range(1, t.traces + 1):
        parts.append(f"""m{n} AS (SELECT *, ('0x' || substr(mark, 1, 6))::BIGINT % {t.hypotheses} AS h FROM (SELECT *, md5(concat_ws('|', '{n}', k, cu, cz)) AS mark FROM l{n})),
e{n} AS (SELECT k, h, min_by(u, mark) AS ua, min_by(z, mark) AS za, max_by(u, mark) AS ub, max_by(z, mark) AS zb FROM m{n} GROUP BY k, h),
h{n} AS MATERIALIZED (SELECT *, za - slope * ua AS intercept FROM (SELECT k, h, ua, za, (zb - za) / (ub - ua) AS slope FROM e{n} WHERE abs(ub - ua) >= {t.least_apart}) WHERE abs(slope) <= {t.steepest}),
v{n} AS (SELECT h.k, h.h, any_value(h.slope) AS slope, any_value(h.intercept) AS intercept, count(*) AS n, quantile_cont(l.u, 0.05) AS u05, quantile_cont(l.u, 0.95) AS u95, count(DISTINCT floor(l.u / {t.bin})) AS bins
  FROM l{n} l JOIN h{n} h ON h.k = l.k AND {off.format(a='h')} <= {t.tolerance} GROUP BY h.k, h.h),
s{n} AS (SELECT *, bins / greatest(1, ceil(round(u95 - u05, 9) / {t.bin}) + 1) AS coverage FROM v{n} WHERE n >= {t.least_points} AND round(u95 - u05, 9) >= {t.least_span}),
b{n} AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(round(u95 - u05, 9) * coverage * sqrt(n), 9) DESC, h) AS i FROM s{n}) WHERE i = 1),
f{n} AS MATERIALIZED (SELECT b.k, {n} AS trace, count(*) AS n, any_value(b.u05) AS u05, any_value(b.u95) AS u95, any_value(b.coverage) AS coverage, regr_slope(l.z, l.u) AS slope, regr_intercept(l.z, l.u) AS intercept,
  sqrt(greatest(regr_syy(l.z, l.u) - regr_slope(l.z, l.u) ** 2 * regr_sxx(l.z, l.u), 0) / count(*)) AS rmse FROM l{n} l JOIN b{n} b ON b.k = l.k AND {off.format(a='b')} <= {t.tolerance} GROUP BY b.k),
l{n + 1} AS MATERIALIZED (SELECT l.* FROM l{n} l JOIN f{n} f ON f.k = l.k AND {off.format(a='f')} > {t.removed})""")
    every = " UNION ALL ".join(f"SELECT * FROM f{n}" for n in range(1, t.traces + 1))
    return f"WITH {', '.join(parts)} SELECT k AS supplier, trace, n, {', '.join(f'round({v}, 4) AS {v}' for v in ('u05', 'u95', 'slope', 'intercept', 'rmse', 'coverage'))} FROM ({every})"


@query(traces_sql(TRACES))
def supplier_line_traces(s, d) -> DataFrame:
    items = load(s, d, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("u"), (F.col("l_extendedprice") / 1000).alias("z"))
    return robust.line_traces(items, "supplier", TRACES).select("supplier", "trace", "n", *[r(v) for v in ("u05", "u95", "slope", "intercept", "rmse", "coverage")])


def sag_sql(t: robust.SagLimits) -> str:
    """Line by the engine's regression, parabola by the inverse of its moments around the mean; a round is four selections."""
    parts = [f"""p AS (SELECT l_partkey AS part, l_quantity AS s, l_extendedprice / 1000 + l_discount AS c, l_quantity * l_extendedprice / 50000 + l_tax AS z FROM lineitem WHERE l_quantity >= {t.margin} AND l_quantity <= 51 - {t.margin}),
r0 AS MATERIALIZED (SELECT part, quantile_cont(s, 0.5) - 25.5 AS u, quantile_cont(c, 0.5) AS y, quantile_cont(z, 0.5) AS z, true AS keep FROM p GROUP BY part, floor(s / {t.bin}) HAVING count(*) >= {t.least_points})"""]
    for n in range(t.rounds + 1):
        parts.append(f"""q{n} AS (SELECT part, regr_slope(y, u) AS a1, regr_intercept(y, u) AS a0, avg(u) AS mu, avg(u * u) AS mv, avg(z) AS mz, var_pop(u) AS uu, var_pop(u * u) AS vv, covar_pop(u, u * u) AS uv, covar_pop(u, z) AS uz, covar_pop(u * u, z) AS vz FROM r{n} WHERE keep GROUP BY part),
c{n} AS (SELECT *, mz - b1 * mu - b2 * mv AS b0 FROM (SELECT *, (uz * vv - vz * uv) / nullif(uu * vv - uv * uv, 0) AS b1, (vz * uu - uz * uv) / nullif(uu * vv - uv * uv, 0) AS b2 FROM q{n})),
o{n} AS MATERIALIZED (SELECT r.*, a1, b2, sqrt((y - a0 - a1 * u) ** 2 + (z - b0 - b1 * u - b2 * u * u) ** 2) AS off FROM r{n} r JOIN c{n} USING (part))""")
        if n < t.rounds:
            parts.append(f"""d{n} AS (SELECT *, quantile_cont(off, 0.5) FILTER (keep) OVER (PARTITION BY part) AS mid FROM o{n}),
g{n} AS (SELECT *, quantile_cont(abs(off - mid), 0.5) FILTER (keep) OVER (PARTITION BY part) AS spread FROM d{n}),
t{n} AS (SELECT *, coalesce(off <= least({t.widest}, greatest({t.tightest}, mid + {t.deviations} * spread)), false) AS ok FROM g{n}),
r{n + 1} AS MATERIALIZED (SELECT part, u, y, z, CASE WHEN sum(ok::INT) OVER (PARTITION BY part) >= {max(4, t.least_bins)} THEN ok ELSE keep END AS keep FROM t{n})""")
    return f"""WITH {', '.join(parts)}, x AS (SELECT part, count(*) AS bins, count(*) FILTER (keep) AS kept, any_value(a1) AS slope, any_value(b2) AS curvature, any_value(b2) * 25.5 * 25.5 AS sag, quantile_cont(off, 0.9) FILTER (keep) AS p90 FROM o{t.rounds} GROUP BY part)
SELECT part, bins, CASE WHEN bins < 4 THEN 0 ELSE kept END AS kept, {', '.join(f'CASE WHEN bins >= 4 THEN round({v}, {k}) END AS {v}' for v, k in (('slope', 4), ('curvature', 6), ('sag', 4), ('p90', 4)))},
coalesce(bins >= {t.least_bins} AND kept / bins >= {t.least_kept} AND p90 <= {t.most_p90} AND curvature > 0 AND sag >= {t.least_sag}, false) AS passed FROM x"""


@query(sag_sql(SAG))
def sagged_wires(s, d) -> DataFrame:
    """A part's line items as a span over quantities: price across, quantity times price as height."""
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    items = load(s, d, "lineitem").select(F.col("l_partkey").alias("part"), q.alias("s"), (p / 1000 + F.col("l_discount")).alias("c"), (q * p / 50000 + F.col("l_tax")).alias("z"), F.lit(0.0).alias("start"), F.lit(51.0).alias("stop"))
    return robust.sag_fits(items, "part", SAG).select("part", "bins", "kept", r("slope"), F.round("curvature", 6).alias("curvature"), r("sag"), r("p90"), "passed")
