"""Queries of planes by votes and of clusters beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import density
from .catalogue import V, places, query, r

LIMITS = density.PlaneLimits(hypotheses=32, tolerance=0.015, least_points=10, planes=2)
FREE = density.PlaneLimits(hypotheses=32, tolerance=0.015, least_points=10, planes=1)


def planes_sql(name: str, points: str, seed: int) -> str:
    """Common table expressions ``name``_t (triples), ``name``_b (best planes) and ``name``_l (points on none) of ``points``."""
    dot = lambda p: f"(n.nx * {p}.x + n.ny * {p}.y + n.nz * {p}.z)"
    return f"""{name}_m AS MATERIALIZED (SELECT label, id, x, y, z, md5('{seed}|' || id) AS mark, ('0x' || md5('{seed}|' || id)[1:6])::BIGINT % 32 AS h FROM {points}),
{name}_t AS MATERIALIZED (SELECT label, h, a, b, d, (b.y - a.y) * (d.z - a.z) - (b.z - a.z) * (d.y - a.y) AS cx, (b.z - a.z) * (d.x - a.x) - (b.x - a.x) * (d.z - a.z) AS cy, (b.x - a.x) * (d.y - a.y) - (b.y - a.y) * (d.x - a.x) AS cz FROM
(SELECT label, h, arg_min({{'x': x, 'y': y, 'z': z}}, mark) AS a, arg_max({{'x': x, 'y': y, 'z': z}}, mark) AS b, arg_min({{'x': x, 'y': y, 'z': z}}, reverse(mark)) AS d FROM {name}_m GROUP BY 1, 2)),
{name}_u AS MATERIALIZED (SELECT label, h, a, cx / sqrt(cx * cx + cy * cy + cz * cz) AS nx, cy / sqrt(cx * cx + cy * cy + cz * cz) AS ny, cz / sqrt(cx * cx + cy * cy + cz * cz) AS nz FROM {name}_t WHERE sqrt(cx * cx + cy * cy + cz * cz) > 1e-9),
{name}_n AS MATERIALIZED (SELECT *, nx * a.x + ny * a.y + nz * a.z AS o FROM {name}_u),
{name}_v AS (SELECT n.label, n.h, n.nx, n.ny, n.nz, n.o, count(*) AS n FROM {name}_m p JOIN {name}_n n ON n.label = p.label AND abs({dot('p')} - n.o) <= 0.015 GROUP BY ALL HAVING count(*) >= 10),
{name}_b AS MATERIALIZED (SELECT * FROM {name}_v QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, h) = 1),
{name}_l AS MATERIALIZED (SELECT label, id, x, y, z FROM {name}_m p WHERE NOT EXISTS (SELECT 1 FROM {name}_b n WHERE n.label = p.label AND abs({dot('p')} - n.o) <= 0.015))"""


SHOWN = "label, n, round(nx, 4) AS nx, round(ny, 4) AS ny, round(nz, 4) AS nz, round(o, 4) AS plane_offset"


@query(f"WITH {planes_sql('p', V, 1)}, {planes_sql('q', 'p_l', 2)} SELECT 1 AS plane, {SHOWN} FROM p_b UNION ALL SELECT 2, {SHOWN} FROM q_b")
def plane_segments(s, d) -> DataFrame:
    """The two planes of most points of each label, the second among the points that the first leaves."""
    found, _ = density.plane_segments(places(s, d), "label", LIMITS)
    return found.select("plane", "label", "n", r("nx"), r("ny"), r("nz"), r("offset", "plane_offset"))


@query(f"""WITH RECURSIVE {planes_sql('p', V, 1)}, n AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p_l a JOIN p_l b ON a.label = b.label AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.1), k AS MATERIALIZED (SELECT a FROM n GROUP BY 1 HAVING count(*) >= 6),
l AS MATERIALIZED (SELECT n.a, n.b FROM n JOIN k ON k.a = n.a JOIN k q ON q.a = n.b), w(a, b) AS (SELECT a, a FROM k UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a), c AS (SELECT a, min(b) AS component FROM w GROUP BY 1),
e AS (SELECT n.a, min(component) AS component FROM n JOIN c ON c.a = n.b WHERE n.a NOT IN (SELECT a FROM k) GROUP BY 1)
SELECT v.label, v.id, coalesce(c.component, e.component) AS cluster, c.a IS NOT NULL AS core FROM p_l v LEFT JOIN c ON c.a = v.id LEFT JOIN e ON e.a = v.id""")
def plane_free_clusters(s, d) -> DataFrame:
    """Each label's points off its plane of most points, clustered by density."""
    _, rest = density.plane_segments(places(s, d), "label", FREE)
    return density.density_clusters(rest, 0.1, 6, "label")
