"""Queries that read and write strictly: profiles, intake, reviews, split tables, digests of files, and streams that resume."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grid import voxel_holdout
from ..operators.lineage import shared_folder
from ..sources import intake as io
from ..sources.tables import load, points
from ..streaming import identity, windows
from .catalogue import P, query, r


def fresh(s, name: str) -> str:
    return f"{shared_folder(s)}/{name}-{uuid.uuid4().hex}"


COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM customer" for c in COLS))
def column_profile(s, d) -> DataFrame:
    return io.profile(load(s, d, "customer").select(*COLS))


@query(f"""SELECT count(*) AS rows, 0 AS not_finite, count(*) FILTER (NOT (x BETWEEN 1.75 AND 50.25 AND y BETWEEN -0.25 AND 95.25 AND z BETWEEN -0.25 AND 10.25)) AS outside, (SELECT string_agg(class || '=' || n, ',' ORDER BY class) FROM (SELECT class, count(*) AS n FROM {P} GROUP BY 1)) AS classes,
count(*) > 0 AND count(*) FILTER (NOT (x BETWEEN 1.75 AND 50.25 AND y BETWEEN -0.25 AND 95.25 AND z BETWEEN -0.25 AND 10.25)) = 0 AS accepted FROM {P}""")
def strict_intake(s, d) -> DataFrame:
    return io.intake(points(s, d), ["x", "y", "z"], "class", 10 ** 12, {"x": 2.0, "y": 0.0, "z": 0.0}, {"x": 50.0, "y": 95.0, "z": 10.0}, 0.5)


@query("""WITH n AS (SELECT o_custkey, count(*) AS n, min(lower(trim(substr(o_orderpriority, 3)))) AS value FROM orders WHERE o_totalprice > 150000 GROUP BY 1)
SELECT o_custkey, value, CASE WHEN n > 1 THEN 'duplicate' WHEN value NOT IN ('urgent', 'high', 'low') THEN 'invalid' ELSE 'ok' END AS state FROM n""")
def review_validation(s, d) -> DataFrame:
    o = load(s, d, "orders").filter("o_totalprice > 150000").select("o_custkey", F.expr("substr(o_orderpriority, 3)").alias("v"))
    return io.reviews(o, "o_custkey", "v", ["urgent", "high", "low"])


@query(f"SELECT count(*) AS n, round(sum(y), 2) AS total FROM {P} WHERE z BETWEEN 2 AND 6 AND x * 0.6 + y * 0.8 BETWEEN 20 AND 50 AND row_key % 3 = 0")
def windowed_sample(s, d) -> DataFrame:
    along = F.col("x") * 0.6 + F.col("y") * 0.8
    return io.window(points(s, d), (2.0, 6.0), (along, 20.0, 50.0), 3, F.col("row_key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("total"))


@query(f"SELECT source, CASE WHEN ('0x' || substr(sha256(concat_ws(',', floor(x / 5)::BIGINT, floor(y / 5)::BIGINT, floor(z / 5)::BIGINT)), 1, 8))::BIGINT % 1000000 < 200000 THEN 'holdout' ELSE 'train' END AS role, count(*) AS n, round(sum(x), 2) AS total FROM {P} GROUP BY 1, 2")
def split_write(s, d) -> DataFrame:
    """Points written once into a folder for each source and role, and read again."""
    path = fresh(s, "split")
    rows = voxel_holdout(points(s, d), 5.0, 0.2).withColumn("role", F.when(F.col("holdout"), "holdout").otherwise("train")).drop("holdout")
    io.write_split(rows, path, ["source", "role"])
    return s.read.parquet(path).groupBy("source", "role").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 2).alias("total"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 5000)")
def filtered_csv(s, d) -> DataFrame:
    """The rows that a selection names, written as CSV with a header and read back strictly."""
    path = fresh(s, "csv")
    held = load(s, d, "customer").filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("n_nationkey"))
    io.write_report(load(s, d, "nation").join(held, "n_nationkey", "left_semi"), path, "csv")
    return io.strict_csv(s, path, {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"})


@query("SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def json_report(s, d) -> DataFrame:
    path = fresh(s, "report")
    io.write_report(load(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r(F.avg("value"), "mean")), path)
    return s.read.schema("event_type string, n long, mean double").json(path)


@query("SELECT * FROM (VALUES ('same', true), ('unlisted', true), ('missing', true)) v(state, seen)")
def file_digests(s, d) -> DataFrame:
    """A folder of files against the digests that were taken of it, one file added and one name added since."""
    path = fresh(s, "files")
    io.write_report(load(s, d, "region").coalesce(1), path)
    taken = s.read.format("binaryFile").load(f"{path}/part-*").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    taken = taken.union(s.range(1).select(F.lit("gone"), F.lit(1).cast("long"), F.lit("0")))
    list_ = fresh(s, "digests")
    taken.write.parquet(list_)
    load(s, d, "nation").coalesce(1).write.mode("append").json(path)
    return io.verify_files(s, f"{path}/part-*", s.read.parquet(list_)).groupBy("state").agg((F.count(F.lit(1)) > 0).alias("seen"))


@query()
def stream_identity(s, d) -> DataFrame:
    """Users' events of a day tied to their tracks of the last three days, over a stream that stops after the earlier half of the time and goes on from its checkpoint; days that the
    watermark, half a day behind, has not passed are still open."""
    e = load(s, d, "events").select("user_id", "ts", F.col("event_id").alias("id"), "value")
    ends = e.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("a"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("b")).first()
    base, half = fresh(s, "identity"), ((ends.a or 0) + (ends.b or 0)) // 2
    for first in (True, False):
        e.filter((F.unix_micros(F.col("ts").cast("timestamp")) < half) == first).write.mode("append").parquet(f"{base}/in")
        identity.tie_available(s, f"{base}/in", e.schema, f"{base}/out", f"{base}/state", key="user_id", at="ts", value="value", length_ms=86_400_000, late="12 hours", gate=15.0, most=3)
    return s.read.schema("user_id long, batch long, id long, track_id long").parquet(f"{base}/out")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def resumed_stream(s, d) -> DataFrame:
    """Events that come in two lots: a stream reads the first, stops, and goes on from its checkpoint with the second; no row is lost or read twice."""
    e = load(s, d, "events")
    base, lot = fresh(s, "stream"), F.pmod("event_id", F.lit(2))
    for i in (0, 1):
        e.filter(lot == i).select("event_id", "event_type", "value").write.mode("append").parquet(f"{base}/in")
        windows.copy_available(s, f"{base}/in", e.select("event_id", "event_type", "value").schema, f"{base}/out", f"{base}/state")
    return s.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), "total"))
