"""Queries of several best ways through candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import paths
from .catalogue import DAYS, daily, query, r


@query(f"""WITH RECURSIVE s AS (SELECT user_id, day, CASE WHEN day - lag(day) OVER w > 2 THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT user_id, day FROM {DAYS}) WINDOW w AS (PARTITION BY user_id ORDER BY day)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY day)::BIGINT AS run FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY day) AS i FROM g), c AS MATERIALIZED (SELECT e.*, run, i FROM {DAYS} e JOIN k ON k.user_id = e.user_id AND k.day = e.day),
t AS (SELECT user_id, run, i, id, value, 1::BIGINT AS choice, cost AS total, [id] AS way, [day] AS days, [false] AS seams FROM c WHERE i = 1 UNION ALL
SELECT user_id, run, i, id, value, p, best[p].total + cost, list_append(best[p].way, id), list_append(best[p].days, day), list_append(best[p].seams, best[p].seam) FROM (SELECT c.user_id, c.run, c.i, c.day, c.id, any_value(c.value) AS value, any_value(c.cost) AS cost,
list_sort(list({{'total': t.total + CASE WHEN abs(t.value - c.value) <= 20 THEN 0.5 * abs(t.value - c.value) ELSE 15 END, 'before': t.id, 'choice': t.choice, 'way': t.way, 'days': t.days, 'seams': t.seams, 'seam': abs(t.value - c.value) > 20}}))[1:3] AS best
FROM t JOIN c ON c.user_id = t.user_id AND c.run = t.run AND c.i = t.i + 1 GROUP BY 1, 2, 3, 4, 5), (VALUES (1::BIGINT), (2::BIGINT), (3::BIGINT)) v(p) WHERE p <= len(best)),
z AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY total, id, choice) AS path FROM t WHERE (user_id, run, i) IN (SELECT user_id, run, max(i) FROM k GROUP BY 1, 2) QUALIFY path <= 3)
SELECT user_id, run, path, unnest(days) AS day, unnest(way) AS id, round(total, 4) AS total, unnest(seams) AS seam FROM z""")
def k_best_sequences(s, d) -> DataFrame:
    """The three cheapest ways through each user's events, one a day, with seams where the value moves by more than 20."""
    return paths.k_best_sequences(daily(s, d), "user_id", "day", "value", "cost").select("user_id", "run", "path", "day", "id", r("total"), "seam")
