"""Continuous lines through a track's observations: evidence pieces, bounded gaps, and stations on cubic Hermite curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col
TRACK = ["project", "track"]


def knots(obs: DataFrame) -> DataFrame:
    """(project, track, c, lat, z): the ends of observations (project, track, c0, c1, lat0, lat1, z0, z1); where several meet at one chainage, their mean."""
    ends = obs.select(*TRACK, F.explode(F.array(*[F.struct(c(f"c{i}").alias("c"), c(f"lat{i}").alias("lat"), c(f"z{i}").alias("z")) for i in (0, 1)])).alias("e")).select(*TRACK, "e.*")
    return ends.groupBy(*TRACK, "c").agg(F.avg("lat").alias("lat"), F.avg("z").alias("z"))


def segments(obs: DataFrame, bounded: float) -> DataFrame:
    """(project, track, c, c_next, evidence, and for lat and z the values v, v_next and tangents t, t_next): the stretches between neighbouring knots.

    Tangents are differences over both neighbours, at a track's ends over the one there is. The evidence of a stretch is that of the observation over it which reaches furthest, ``gap_inferred`` where none
    is and the whole gap is at most ``bounded``, else ``gap_open``. Knots and starts of observations go through one window along a track.
    """
    w = Window.partitionBy(*TRACK).orderBy("c")

    def tangent(v: str) -> Column:
        before, after = F.lag(v).over(w), F.lead(v).over(w)
        run = F.coalesce(F.lead("c").over(w), c("c")) - F.coalesce(F.lag("c").over(w), c("c"))
        return F.when(run > 0, (F.coalesce(after, c(v)) - F.coalesce(before, c(v))) / run).otherwise(0.0)

    spans = obs.groupBy(*TRACK, c("c0").alias("c")).agg(F.max(F.struct(c("c1").alias("stop"), "evidence")).alias("s"))
    k = knots(obs).join(spans, [*TRACK, "c"], "left")
    k = k.withColumns({"t_lat": tangent("lat"), "t_z": tangent("z"), "reach": F.max("s").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    k = k.withColumns({f"{v}_next": F.lead(v).over(w) for v in ("c", "lat", "z", "t_lat", "t_z")}).filter("c_next is not null")
    covered = c("reach.stop") >= c("c_next")
    # nothing lies over the stretch, so it is the gap itself: knots are the ends of observations, and none ends within a gap
    label = F.when(covered, c("reach.evidence")).when(c("c_next") - c("c") <= bounded, "gap_inferred").otherwise("gap_open")
    return k.withColumn("evidence", label).drop("s", "reach")


def pieces(stretches: DataFrame) -> DataFrame:
    """(project, track, piece, evidence, c0, c1): neighbouring stretches of one evidence as one piece, numbered along the track from 1."""
    w = Window.partitionBy(*TRACK).orderBy("c")
    new = F.coalesce((c("evidence") != F.lag("evidence").over(w)).cast("long"), F.lit(1).cast("long"))
    marked = stretches.withColumn("__new", new).withColumn("piece", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*TRACK, "piece", "evidence").agg(F.min("c").alias("c0"), F.max("c_next").alias("c1"))


def hermite(u: Column, run: Column, a: Column, b: Column, ta: Column, tb: Column) -> tuple[Column, Column]:
    """Value and slope at the share ``u`` of a stretch of length ``run`` from a to b with slopes ta and tb at its ends."""
    value = (2 * u - 3) * u * u * (a - b) + a + run * u * (u - 1) * ((u - 1) * ta + u * tb)
    slope = 6 * u * (u - 1) * (a - b) / run + (u - 1) * (3 * u - 1) * ta + u * (3 * u - 2) * tb
    return value, slope


def stations(stretches: DataFrame, step: float) -> DataFrame:
    """(project, track, station, evidence, lat, z, slope_lat, slope_z): a row at every knot that begins a stretch and at every multiple of ``step``, but not over open gaps. A
    stretch emits its own rows, so nothing is joined."""
    inside = F.sequence(F.floor(c("c") / step) + 1, F.ceil(c("c_next") / step) - 1)
    grid = F.when(F.floor(c("c") / step) + 1 <= F.ceil(c("c_next") / step) - 1, inside).otherwise(F.array().cast("array<bigint>"))
    at = F.explode(F.concat(F.array(c("c")), F.transform(grid, lambda k: k * step)))
    rows = stretches.filter("evidence <> 'gap_open'").withColumn("station", at)
    run = c("c_next") - c("c")
    u = (c("station") - c("c")) / run
    (lat, s_lat), (z, s_z) = (hermite(u, run, c(v), c(f"{v}_next"), c(f"t_{v}"), c(f"t_{v}_next")) for v in ("lat", "z"))
    return rows.select(*TRACK, "station", "evidence", lat.alias("lat"), z.alias("z"), s_lat.alias("slope_lat"), s_z.alias("slope_z"))
