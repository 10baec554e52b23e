"""Columns, roofs, wires and masts as tables: contacts, contrasts, clearances, seams, inventories, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cell
from ..functions.scores import clamp
from . import intervals
from .boxes import alike, best, box_pairs, span_pairs


def eligible_columns(points: DataFrame, size: float, least: int, span: float, layer: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cx, cy, n, low, high, levels, ratio) of the cells with ``least`` points and ``span`` of height: levels are the occupied layers, ratio their part of
    all between the lowest and highest."""
    c = F.col
    by = [*keys, cell(c("x"), size).alias("cx"), cell(c("y"), size).alias("cy")]
    g = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("z").alias("low"), F.max("z").alias("high"), F.count_distinct(cell(c("z"), layer)).alias("levels"))
    all_ = cell(c("high"), layer) - cell(c("low"), layer) + 1
    return g.filter((c("n") >= least) & (c("high") - c("low") >= span)).withColumn("ratio", c("levels") / all_)


def along_coverage(points: DataFrame, across: float, along: float, layer: float, length: float) -> DataFrame:
    """(cx, cz, bins, coverage): for each cell of x and z the distinct bins along y and their part of ``length``: points in one voxel count once."""
    v = points.select(cell(F.col("x"), across).alias("cx"), cell(F.col("z"), layer).alias("cz"), cell(F.col("y"), along).alias("cy")).distinct()
    return v.groupBy("cx", "cz").agg(F.count(F.lit(1)).alias("bins")).withColumn("coverage", F.col("bins") / max(1, round(length / along)))


def banded_density(points: DataFrame, size: float, bands: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, cx, cy, n, band_0, band_1, ...): points of each cell, and of each half-open band of height in it."""
    c = F.col
    counts = [F.count(F.when((c("z") >= a) & (c("z") < b), 1)).alias(f"band_{i}") for i, (a, b) in enumerate(zip(bands, bands[1:]))]
    return points.groupBy(*keys, cell(c("x"), size).alias("cx"), cell(c("y"), size).alias("cy")).agg(F.count(F.lit(1)).alias("n"), *counts)


def row_quantiles(points: DataFrame, keys: list[str], along: str, size: float, value: str, q: float, least: int) -> DataFrame:
    """(keys, row, at, n, level): the quantile of a value in each bin along with ``least`` rows, at the bin's middle."""
    out = points.groupBy(*keys, cell(F.col(along), size).alias("row")).agg(F.count(F.lit(1)).alias("n"), F.percentile(value, q).alias("level"))
    return out.filter(F.col("n") >= least).select(*keys, "row", ((F.col("row") + 0.5) * size).alias("at"), "n", "level")


def merged_evidence(spans: DataFrame, key: list[str], kind: str, id_col: str, slack: float) -> DataFrame:
    """(key, part, kind, start, stop, ids): spans in order, one part where neighbours are of one kind and the next starts within ``slack`` of the end so far; its ids are
    kept, comma-joined in order."""
    c, w = F.col, Window.partitionBy(*key).orderBy("start", "stop", id_col)
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.lag(kind).over(w).isNull() | (F.lag(kind).over(w) != c(kind)) | (c("start") > before + slack)
    d = spans.withColumn("__n", new.cast("int")).withColumn("part", F.sum("__n").over(w))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "stop", c(id_col).alias("i")))), lambda x: x["i"].cast("string")), ",")
    return d.groupBy(*key, "part", kind).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), ids.alias("ids"))


def contacts(tops: DataFrame, surface: DataFrame, size: float, reach: float, slack: float) -> DataFrame:
    """(id, surface_id, gap, state): each column top (id, x, y, z) with the nearest surface point within ``reach`` in the plane, by distance; ``contact`` where the vertical gap is
    within ``slack``, ``gap`` else, ``no_surface`` where there is none."""
    c = F.col
    box = lambda d: d.select(c("id").alias("box_id"), *[c(a).alias(f"{a}{n}") for a in "xyz" for n in (0, 1)])
    j = box_pairs(box(tops), box(surface), size, reach)
    flat = F.sqrt((c("a_x0") - c("b_x0")) ** 2 + (c("a_y0") - c("b_y0")) ** 2)
    near = best(j.withColumn("__d", flat).filter(c("__d") <= reach), "a_box_id", [c("gap"), c("b_box_id")])
    found = near.select(c("a_box_id").alias("id"), c("b_box_id").alias("surface_id"), (c("b_z0") - c("a_z0")).alias("dz"))
    state = F.when(c("surface_id").isNull(), "no_surface").when(F.abs("dz") <= slack, "contact").otherwise("gap")
    return tops.select("id").join(found, "id", "left").select("id", "surface_id", c("dz").alias("gap"), state.alias("state"))


def strip_contrast(points: DataFrame, lines: DataFrame, key: str, half: float, least: float) -> DataFrame:
    """(key, line, centre, sides, contrast, passed): points within ``half`` of a line (key, line, at) across against the mean of the two strips of that width beside it."""
    c = F.col
    reach = lines.select(key, "line", "at", F.explode(F.sequence(cell(c("at") - 3 * half, 2 * half), cell(c("at") + 3 * half, 2 * half))).alias("__c"))
    j = points.withColumn("__c", cell(c("y"), 2 * half)).join(reach, [key, "__c"]).withColumn("__o", F.abs(c("y") - c("at"))).filter(c("__o") <= 3 * half)
    g = j.groupBy(key, "line").agg(F.count(F.when(c("__o") <= half, 1)).alias("centre"), (F.count(F.when(c("__o") > half, 1)) / 2).alias("sides"))
    out = g.withColumn("contrast", c("centre") / F.greatest(c("sides"), F.lit(1.0)))
    return out.withColumn("passed", c("contrast") >= least)


def signed_clearance(a: DataFrame, b: DataFrame, key: str, size: float, reach: float) -> DataFrame:
    """(key, id, nearest, clearance, passed): the signed gap of each interval (key, id, low, high) to the others of its key within ``reach``: the distance, or where they overlap the negative
    of how far one reaches into the other; the least counts and passes if it is not negative. An interval with none in reach passes."""
    c = F.col
    span = [key, "low", "high"]
    once = alike(a, "id", *span)
    wide = once.select(key, c("id").alias("span_id"), (c("low") - reach).alias("start"), (c("high") + reach).alias("stop"))
    j = span_pairs(wide, alike(b, "id", *span).select(key, c("id").alias("span_id"), c("low").alias("start"), c("high").alias("stop")), size, (key,))
    gap = F.greatest(c("a_start") + reach - c("b_stop"), c("b_start") - (c("a_stop") - reach))
    g = j.groupBy(c(f"a_{key}").alias(key), c("a_span_id").alias("id")).agg(F.min(F.struct(gap.alias("g"), c("b_span_id").alias("o"))).alias("m"))
    out = a.select("id", *span).join(once.join(g, [key, "id"]).select(*span, "m"), span, "left")
    return out.select(key, "id", c("m.o").alias("nearest"), c("m.g").alias("clearance"), F.coalesce(c("m.g") >= 0, F.lit(True)).alias("passed"))


def weighted_correction(df: DataFrame, key: str, value: str, weight: str, spread: float, residual: float) -> DataFrame:
    """(key, n, correction, spread, worst, accepted): the common correction of a group, weighted by support, accepted where its members' values lie within ``spread`` of each
    other and within ``residual`` of it."""
    c, w = F.col, Window.partitionBy(key)
    d = df.withColumn("__m", F.sum(c(value) * c(weight)).over(w) / F.sum(weight).over(w))
    g = d.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("__m").alias("correction"), (F.max(value) - F.min(value)).alias("spread"), F.max(F.abs(c(value) - c("__m"))).alias("worst"))
    return g.withColumn("accepted", (c("spread") <= spread) & (c("worst") <= residual))


def edge_change(model: Column, observed: Column, slack: float) -> Column:
    """What became of an edge by the change that the model and the points show."""
    return (F.when(model.isNull() | observed.isNull(), "data_insufficient").when((F.abs(model) <= slack) & (F.abs(observed) <= slack), "stable").when(F.abs(model - observed) <= slack, "confirmed")
            .when(F.abs(observed) <= slack, "model_only").when(F.abs(model) <= slack, "observed_only").otherwise("conflict"))


def support_extent(points: DataFrame, key: str, at: str, line: Column, most: float, least: int) -> DataFrame:
    """(key, n, low, high, state): the 1st and 99th percentiles along of the points near a predicted line; too few are ``data_insufficient``."""
    near = points.filter(F.abs(line) <= most).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.percentile(at, 0.01).alias("low"), F.percentile(at, 0.99).alias("high"))
    j = points.select(key).distinct().join(near, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    enough = F.col("n") >= least
    return j.select(key, "n", F.when(enough, F.col("low")).alias("low"), F.when(enough, F.col("high")).alias("high"), F.when(enough, "supported").otherwise("data_insufficient").alias("state"))


def endpoint_signature(points: DataFrame, key: str, at: str, seam: Column, within: float, edge: float) -> DataFrame:
    """(key, station, across, top): near a seam the extreme place reached, the mean place across of the points within ``edge`` of it and the mean of the highest of each part
    (column ``part``)."""
    c = F.col
    near = points.filter(F.abs(c(at) - seam) <= within)
    far = near.groupBy(key).agg(F.max(at).alias("station"))
    j = near.join(far, key).filter(c(at) >= c("station") - edge)
    parts = j.groupBy(key, "station", "part").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n"), F.max("z").alias("top"))
    return parts.groupBy(key, "station").agg((F.sum("s") / F.sum("n")).alias("across"), F.avg("top").alias("top"))


def endpoint_clusters(points: DataFrame, size: float) -> DataFrame:
    """(ky, kz, n, y, z): ends whose rounded place across and height agree, with their means."""
    k = lambda a: F.bround(F.col(a) / size).cast("long")
    return points.groupBy(k("y").alias("ky"), k("z").alias("kz")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), F.avg("z").alias("z"))


def neighbour_spacing(df: DataFrame, group: str, at: str, width: str, least: float) -> DataFrame:
    """(group, id, next_id, spacing, overlap, passed) of neighbours across: their distance and how far their beds (of ``width``) overlap."""
    c, w = F.col, Window.partitionBy(group).orderBy(at, "id")
    d = df.select(group, "id", F.lead("id").over(w).alias("next_id"), (F.lead(at).over(w) - c(at)).alias("spacing"), ((F.lead(width).over(w) + c(width)) / 2).alias("__w")).filter("next_id is not null")
    over = F.greatest(F.lit(0.0), c("__w") - c("spacing"))
    return d.select(group, "id", "next_id", "spacing", over.alias("overlap"), ((c("spacing") >= least) & (over <= 0)).alias("passed"))


def clipped_spans(spans: DataFrame, cores: DataFrame, key: str, least: float) -> DataFrame:
    """(key, id, start, stop, kept): spans cut to their key's core (key, low, high); what is shorter than ``least`` is reported, not kept; gaps are never bridged."""
    c = F.col
    j = spans.join(cores, key).withColumn("start", F.greatest("start", "low")).withColumn("stop", F.least("stop", "high"))
    return j.select(key, "id", "start", "stop", (c("stop") - c("start") >= least).alias("kept"))


def strongest_apart(df: DataFrame, key: str, at: str, weight: str, size: float, reach: int) -> DataFrame:
    """(key, bin, n): bins along with their weight, of which none within ``reach`` bins is stronger (ties: the earlier)."""
    b = df.groupBy(key, cell(F.col(at), size).alias("bin")).agg(F.sum(weight).alias("n"))
    top = F.max(F.struct("n", (-F.col("bin")).alias("m"))).over(Window.partitionBy(key).orderBy("bin").rangeBetween(-reach, reach))
    return b.withColumn("__t", top).filter((F.col("__t.n") == F.col("n")) & (F.col("__t.m") == -F.col("bin"))).drop("__t")


def inventory(parents: DataFrame, names: DataFrame, parts: dict[str, int]) -> DataFrame:
    """(node, counts of each part, priority): the objects of each parent, whose names are the node itself or begin with it and a dash; BLOCKED without the first part, P0 with all
    parts in number, P1 where one is missing, else P2. Names are cut at their dashes, so the prefix join is an equi-join."""
    c = F.col
    bits = F.split("name", "-")
    heads = F.transform(F.sequence(F.lit(1), F.size(bits)), lambda i: F.array_join(F.slice(bits, F.lit(1), i), "-"))
    j = names.select("name", F.explode(heads).alias("node")).join(parents, "node")
    n = lambda p: F.count(F.when(F.upper("name").contains(p.upper()), 1)).alias(p)
    g = parents.select("node").join(j.groupBy("node").agg(*[n(p) for p in parts]), "node", "left").fillna(0, list(parts))
    missing = sum(((c(p) < k).cast("int") for p, k in parts.items()), F.lit(0))
    first = next(iter(parts))
    return g.withColumn("priority", F.when(c(first) < parts[first], "BLOCKED").when(missing == 0, "P0").when(missing == 1, "P1").otherwise("P2"))


def band_groups(bands: DataFrame, key: str, at: str, level: str, gap: float, jump: float, least: int) -> DataFrame:
    """(key, part, bands, low, high): bands in order, a new group where the next is further than ``gap`` or its level jumps by more than ``jump``; groups of fewer than ``least`` bands go."""
    c, w = F.col, Window.partitionBy(key).orderBy(at)
    new = (c(at) - F.lag(at).over(w) > gap) | (F.abs(c(level) - F.lag(level).over(w)) > jump)
    d = bands.withColumn("__n", F.coalesce(new, F.lit(False)).cast("int")).withColumn("part", F.sum("__n").over(w))
    return d.groupBy(key, "part").agg(F.count(F.lit(1)).alias("bands"), F.min(at).alias("low"), F.max(at).alias("high")).filter(c("bands") >= least)


def section_elevation(points: DataFrame, knots: DataFrame, key: str) -> DataFrame:
    """``points`` (key, s, c) with ``elevation`` of a surface given by sections (key, s, low_c, high_c, low_z, high_z): all four are interpolated along, then the height across
    between the clipped edges; null beyond the first and last section."""
    c = F.col
    ends = knots.groupBy(key).agg(F.min("s").alias("__s0"), F.max("s").alias("__s1"))
    at = intervals.interpolate(points, knots.withColumnRenamed("s", "__s"), key, "s", "__s", "low_c", "high_c", "low_z", "high_z").join(ends, key, "left")
    share = clamp((c("c") - c("low_c")) / F.greatest(c("high_c") - c("low_c"), F.lit(1e-9)))
    inside = c("s").between(c("__s0"), c("__s1"))
    return at.withColumn("elevation", F.when(inside, c("low_z") + share * (c("high_z") - c("low_z")))).drop("low_c", "high_c", "low_z", "high_z", "__s0", "__s1")


def density_change(old: DataFrame, new: DataFrame, size: float) -> DataFrame:
    """(cx, cy, old, new, change) of two clouds on one grid, cells of either."""
    g = lambda d, n: d.groupBy(cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy")).agg(F.count(F.lit(1)).alias(n))
    j = g(old, "old").join(g(new, "new"), ["cx", "cy"], "full").fillna(0, ["old", "new"])
    return j.withColumn("change", F.when(F.col("old") == 0, "added").when(F.col("new") == 0, "lost").otherwise("both"))


def linear_matches(gaps: DataFrame, roofs: DataFrame, size: float, edge: float, height: float) -> DataFrame:
    """(id, roof_id, priority): gaps (span_id, start, stop, c, z) with the roof (span_id, start, stop, c0, c1, z) that they overlap by at least the smaller of 5 and half of their length, near its edge and
    height; the nearest by (edge, height); matched ones are demoted to P2."""
    c = F.col
    shape = ["start", "stop", "c", "z"]
    once, tops = alike(gaps, "span_id", *shape), alike(roofs, "span_id", "start", "stop", "c0", "c1", "z")
    j = span_pairs(once.select("span_id", "start", "stop"), tops.select("span_id", "start", "stop"), size)
    j = j.join(once.select(c("span_id").alias("a_span_id"), c("c").alias("gc"), c("z").alias("gz")), "a_span_id").join(tops.select(c("span_id").alias("b_span_id"), "c0", "c1", c("z").alias("rz")), "b_span_id")
    j = j.withColumn("e", F.least(F.abs(c("gc") - c("c0")), F.abs(c("gc") - c("c1")))).withColumn("h", F.abs(c("gz") - c("rz")))
    enough = c("overlap") >= F.least(F.lit(5.0), (c("a_stop") - c("a_start")) / 2)
    near = best(j.filter(enough & (c("e") <= edge) & (c("h") <= height)), "a_span_id", [c("e"), c("h"), c("b_span_id")])
    found = once.join(near.select(c("a_span_id").alias("span_id"), c("b_span_id").alias("roof_id")), "span_id").select(*shape, "roof_id")
    return gaps.select(c("span_id").alias("id"), *shape).join(found, shape, "left").select("id", "roof_id", F.when(c("roof_id").isNull(), "P1").otherwise("P2").alias("priority"))


def cover(candidates: DataFrame, examples: DataFrame, limits: dict[str, float]) -> DataFrame:
    """``candidates`` that some example is like in every feature of ``limits``: an equi-join on cells of the first feature, then all differences."""
    first, most = next(iter(limits.items()))
    wide = examples.select(*[F.col(k).alias(f"__{k}") for k in limits], F.explode(F.sequence(cell(F.col(first) - most, most), cell(F.col(first) + most, most))).alias("__c"))
    ok = F.lit(True)
    for k, m in limits.items():
        ok = ok & (F.abs(F.col(k) - F.col(f"__{k}")) <= m)
    return candidates.withColumn("__cell", cell(F.col(first), most)).join(wide, (F.col("__cell") == F.col("__c")) & ok, "left_semi").drop("__cell")


def alternatives(ends: DataFrame, starts: DataFrame, radius: float, cosine: float) -> DataFrame:
    """(id, other, gap): for each end (id, target, x, y, z, dx, dy, dz) the starts of other tracks, not its own and not its target, within ``radius`` whose unit direction agrees by ``cosine``."""
    c = F.col
    box = lambda d: d.select(c("id").alias("box_id"), *[c(a).alias(f"{a}{n}") for a in "xyz" for n in (0, 1)])
    j = box_pairs(box(ends), box(starts), radius * 2, radius).filter(c("gap") <= radius)
    way = lambda d, p: d.select(c("id").alias(f"{p}_box_id"), *[c(f"d{a}").alias(f"{p}d{a}") for a in "xyz"], *([c("target")] if p == "a" else []))
    j = j.join(way(ends, "a"), "a_box_id").join(way(starts, "b"), "b_box_id")
    dot = sum((c(f"ad{a}") * c(f"bd{a}") for a in "xyz"), F.lit(0.0))
    return j.filter((c("a_box_id") != c("b_box_id")) & ~c("b_box_id").eqNullSafe(c("target")) & (dot >= cosine)).select(c("a_box_id").alias("id"), c("b_box_id").alias("other"), "gap")


def rule_join(rows: DataFrame, rules: DataFrame, found: DataFrame, key: str, size: float) -> DataFrame:
    """(key, row_id, rule, found_id, score): every row with every rule (rule, offset, low, high, most; few, broadcast) and the candidates of its key within the rule's limits: the difference of place and of
    height from the middle of the rule's range, each over its limit. ``size`` is the largest ``most``: rows and candidates meet by cells of that width."""
    c = F.col
    asked = rows.join(F.broadcast(rules)).withColumn("__at", c("x") + c("offset"))  # rules are a handful of literals
    asked = asked.withColumn("__c", F.explode(F.sequence(cell(c("__at"), size) - 1, cell(c("__at"), size) + 1)))
    j = asked.join(found.withColumn("__c", cell(c("fx"), size)), [key, "__c"])
    dx, h = F.abs(c("fx") - c("__at")), c("fz") - c("z")
    ok = (dx <= c("most")) & h.between(c("low"), c("high"))
    return j.filter(ok).select(key, "row_id", "rule", "found_id", (dx / c("most") + F.abs(h - (c("low") + c("high")) / 2) / (c("high") - c("low"))).alias("score"))
