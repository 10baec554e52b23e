"""Chains of operators: linear candidates, platform surfaces, gap audits, model support, small assets, and the closing steps around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cascade, cell, ratio
from . import assets, boxes, fits, graphs, grid, intervals, morphology, neighbours, planning
from .spatial import components

HALF = 1 << 20


def cell_id(x: str, y: str) -> Column:
    return ((F.col(x) + HALF) * (1 << 21) + F.col(y) + HALF).cast("long")


def linear_candidates(points: DataFrame, size: float, least: int, span: float, layer: float, ratio_: float) -> DataFrame:
    """(component, cells, n, x0, x1, y0, y1, low, high): tall columns of cells, joined where at most two empty cells lie between them along the axes (cells grown by one step touch by a face), with
    their extents."""
    c = F.col
    cols = assets.eligible_columns(points, size, least, span, layer).filter(c("ratio") >= ratio_).withColumn("id", cell_id("cx", "cy"))
    steps = [(i, j) for i in range(-3, 4) for j in range(-3, 4) if abs(i) + abs(j) <= 3 and (i, j) >= (0, 0)]
    ahead = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])).alias("s")
    moved = cols.select(c("id").alias("a"), "cx", "cy", ahead).select("a", (c("cx") + c("s.i")).alias("cx"), (c("cy") + c("s.j")).alias("cy"))
    parts = cols.join(components(moved.join(cols.select(c("id").alias("b"), "cx", "cy"), ["cx", "cy"]).select("a", "b")), "id")
    return parts.groupBy("component").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), *[f(v).alias(k) for k, f, v in (
        ("x0", F.min, c("cx") * size), ("x1", F.max, (c("cx") + 1) * size), ("y0", F.min, c("cy") * size), ("y1", F.max, (c("cy") + 1) * size), ("low", F.min, "low"), ("high", F.max, "high"))])


def platform_surfaces(points: DataFrame, size: float, least: int, flat: float, step: float) -> DataFrame:
    """(component, cells, n, a, b, c, rms): cells of ``least`` points whose heights spread by at most ``flat`` (10th to 90th percentile), grown together over touching cells whose medians differ by at most
    ``step``, and the least-squares plane through each region's cell medians."""
    c = F.col
    cells = grid.cell_percentiles(points, size, "z", least).filter(c("p90") - c("p10") <= flat).select(cell_id("cx", "cy").alias("id"), "cx", "cy", "n", c("p50").alias("z"))
    parts = cells.join(components(morphology.level_links(cells, "z", step)), "id").withColumn("x", (c("cx") + 0.5) * size).withColumn("y", (c("cy") + 0.5) * size)
    plane = fits.plane(parts.select("component", "x", "y", "z"), ["component"], 3).select("component", "a", "b", "c")
    j = parts.join(plane, "component", "left").withColumn("r", c("z") - c("a") * c("x") - c("b") * c("y") - c("c"))
    return j.groupBy("component").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n"), *[F.first(k).alias(k) for k in "abc"], F.sqrt(F.avg(c("r") * c("r"))).alias("rms"))


def gap_candidates(points: DataFrame, model: DataFrame, size: float, least: int, span: float, layer: float, reach: float, limits: DataFrame) -> DataFrame:
    """(cx, cy, n, height, nearest, gap, scope, priority): tall columns that no box of the model explains (none within ``reach``, or one that shares no height), where they lie to the segment (low, high
    along x; one row) and their priority by height and points."""
    c = F.col
    cols = assets.eligible_columns(points, size, least, span, layer).withColumn("box_id", cell_id("cx", "cy"))
    box = cols.select("box_id", (c("cx") * size).alias("x0"), ((c("cx") + 1) * size).alias("x1"), (c("cy") * size).alias("y0"), ((c("cy") + 1) * size).alias("y1"), c("low").alias("z0"), c("high").alias("z1"))
    near = boxes.best(boxes.box_pairs(box, model, size * 2, reach).filter(c("gap") <= reach), "a_box_id", [c("gap"), c("b_box_id")]).select(c("a_box_id").alias("box_id"), c("b_box_id").alias("nearest"), "gap")
    j = cols.join(near, "box_id", "left").filter("nearest is null or gap > 0").crossJoin(F.broadcast(limits))  # one row
    at = (c("cx") + 0.5) * size
    scope = F.when(at < c("low_x"), "previous").when(at > c("high_x"), "next").otherwise("within")
    tall = c("high") - c("low")
    priority = cascade([(F.lit(True) & (scope != "within"), "P3"), ((tall >= 8) & (c("n") >= 12), "P0"), (tall >= 7, "P1")], "P2")
    return j.select("cx", "cy", "n", tall.alias("height"), "nearest", "gap", scope.alias("scope"), priority.alias("priority"))


def model_support(triangles: DataFrame, points: DataFrame, density: float, seed: int, size: float, near: float) -> DataFrame:
    """(samples, mean, p50, p90, coverage): distances from samples of a model's surfaces, spread by area, to the nearest points, and the share within ``near``."""
    s = planning.surface_samples(triangles, density, seed).select((F.col("id") * 100_000 + F.col("k")).alias("id"), "x", "y", "z")
    far = neighbours.knn(s, points.select((-F.col("id") - 1).alias("id"), "x", "y", "z"), 1, size)
    return far.agg(F.count(F.lit(1)).alias("samples"), F.avg("distance").alias("mean"), F.percentile("distance", 0.5).alias("p50"), F.percentile("distance", 0.9).alias("p90"), F.avg((F.col("distance") <= near).cast("double")).alias("coverage"))


def seam_distances(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """(side, n, p50, p90, most): nearest distances both ways between the points (id, x, y, z) of two sides; ids of the sides must differ."""
    out = None
    for name, q, p in (("a_to_b", a, b), ("b_to_a", b, a)):
        d = neighbours.knn(q, p, 1, size).agg(F.count(F.lit(1)).alias("n"), F.percentile("distance", 0.5).alias("p50"), F.percentile("distance", 0.9).alias("p90"), F.max("distance").alias("most")).select(F.lit(name).alias("side"), "n", "p50", "p90", "most")
        out = d if out is None else out.union(d)
    return out


def small_assets(points: DataFrame, model: DataFrame, size: float, least_voxel: int, least_points: int, most: float, reach: float, green: Column) -> DataFrame:
    """(component, voxels, n, kind) of the points' connected voxels: ``too_small`` or ``too_large``, ``existing_residual`` within ``reach`` of a box of the model, ``vegetation`` where most points are green,
    else ``candidate``."""
    c = F.col
    v = graphs.voxel_components(graphs.voxels(points, size, least_voxel)).select("component", "vx", "vy", "vz", "n")
    tint = points.withColumn("__g", green.cast("int")).groupBy(*[cell(c(a), size).alias("v" + a) for a in "xyz"]).agg(F.sum("__g").alias("g"))
    g = v.join(tint, ["vx", "vy", "vz"]).groupBy("component").agg(F.count(F.lit(1)).alias("voxels"), F.sum("n").alias("n"), F.sum("g").alias("g"), *[f((c(f"v{a}") + k) * size).alias(f"{a}{k}") for a in "xyz" for k, f in ((0, F.min), (1, F.max))])
    near = boxes.box_pairs(g.withColumnRenamed("component", "box_id"), model, size * 4, reach).filter(c("gap") <= reach).select(c("a_box_id").alias("component")).distinct().withColumn("known", F.lit(True))
    wide = F.greatest(*[c(f"{a}1") - c(f"{a}0") for a in "xyz"])
    kind = cascade([(c("n") < least_points, "too_small"), (wide > most, "too_large"), (c("known").isNotNull(), "existing_residual"), (c("g") * 2 > c("n"), "vegetation")], "candidate")
    return g.join(near, "component", "left").select("component", "voxels", "n", kind.alias("kind"))


def plane_shape(df: DataFrame, key: str, flat: float, shallow: float) -> DataFrame:
    """(key, n, a, b, p90, shape) of a plane through each key's points: planar, shallow or curved by the 90th percentile of the residuals."""
    c = F.col
    plane = fits.plane(df, [key], 3).select(key, "a", "b", "c")
    j = df.join(plane, key).withColumn("r", F.abs(c("z") - c("a") * c("x") - c("b") * c("y") - c("c")))
    g = j.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("a").alias("a"), F.first("b").alias("b"), F.percentile("r", 0.9).alias("p90"))
    return g.withColumn("shape", F.when(c("p90") <= flat, "planar").when(c("p90") <= shallow, "shallow").otherwise("curved"))


def row_alignment(columns: DataFrame, candidates: DataFrame, key: str, along: float, low: float, high: float, least: int, most: float) -> DataFrame:
    """(key, matches, delta, mad, coherent): each candidate (key, s, c) votes with its difference across to the column (key, s, c) nearest along, if within ``along`` and [low, high]; a row moves by the median
    of ``least`` votes or more whose median absolute deviation is at most ``most``."""
    c = F.col
    left = candidates.select(key, c("s").alias("u"), c("c").alias("v")).withColumn("__c", F.explode(F.sequence(cell(c("u"), along) - 1, cell(c("u"), along) + 1)))
    j = left.join(columns.select(key, c("s").alias("p"), c("c").alias("q"), cell(c("s"), along).alias("__c")), [key, "__c"]).withColumn("d", F.abs(c("u") - c("p")))
    near = j.withColumn("rn", F.row_number().over(Window.partitionBy(key, "u", "v").orderBy("d", "p", "q"))).filter((c("rn") == 1) & (c("d") <= along)).withColumn("e", c("v") - c("q")).filter(c("e").between(low, high))
    w = Window.partitionBy(key)
    d = near.withColumn("m", F.expr("percentile(e, 0.5)").over(w))
    g = d.groupBy(key).agg(F.count(F.lit(1)).alias("matches"), F.first("m").alias("delta"), F.percentile(F.abs(c("e") - c("m")), 0.5).alias("mad"))
    return g.withColumn("coherent", (c("matches") >= least) & (c("mad") <= most))


def levels_visible(samples: DataFrame, key: str, level: str, distance: str, near: float, share: float) -> DataFrame:
    """(key, levels, seen, longest, decision): the nearest sample of every level counts as seen within ``near``; the longest run of levels that are not; confirmed where a ``share`` of them is seen."""
    from .profiles import longest_false

    c = F.col
    g = samples.groupBy(key, level).agg(F.min(distance).alias("d")).withColumn("ok", F.coalesce(c("d") <= near, F.lit(False)))
    out = longest_false(g, [key], level, "ok")
    return out.select(key, c("bins").alias("levels"), F.round(c("share") * c("bins")).cast("long").alias("seen"), "longest", F.when(c("share") >= share, "confirmed").when(c("share") > 0, "partial").otherwise("unseen").alias("decision"))


def overlaid(predictions: DataFrame, reviews: DataFrame, key: str, least: float) -> DataFrame:
    """``predictions`` (key, class, score) with what a review says of them, which they never become: seed where it accepts, or where no review stands and the score is high enough."""
    c = F.col
    j = predictions.join(reviews.select(key, c("decision").alias("review")), key, "left")
    return j.withColumn("seed", F.when(c("review").isNotNull(), c("review") == "accepted").otherwise(c("score") >= least))


def profile_runs(df: DataFrame, key: str, at: str, across: str, height: str, gap: float, shift: float, step: float) -> DataFrame:
    """(key, runs, kept, dropped, splits): profiles along, a new run where they are apart by more than ``gap`` or move by more than ``shift`` across or ``step`` in height; runs of one are dropped."""
    c, w = F.col, Window.partitionBy(key).orderBy(at)
    far = lambda v, m: F.abs(c(v) - F.lag(v).over(w)) > m
    d = df.withColumn("__n", F.coalesce(far(at, gap) | far(across, shift) | far(height, step), F.lit(False)).cast("int")).withColumn("run", F.sum("__n").over(w))
    runs = d.groupBy(key, "run").agg(F.count(F.lit(1)).alias("m"))
    return runs.groupBy(key).agg(F.count(F.lit(1)).alias("runs"), F.count(F.when(c("m") > 1, 1)).alias("kept"), F.count(F.when(c("m") == 1, 1)).alias("dropped"), (F.count(F.lit(1)) - 1).alias("splits"))


def same_station(rows: DataFrame, templates: DataFrame, key: str, at: str, most: float) -> DataFrame:
    """(key, id, template): for each row the template of its key nearest along, within ``most`` (ties to the smaller id)."""
    c = F.col
    left = rows.select(key, c(at).alias("u")).distinct().withColumn("__c", F.explode(F.sequence(cell(c("u"), most) - 1, cell(c("u"), most) + 1)))
    once = boxes.alike(templates.select(key, "id", c(at).alias("v")), "id", key, "v")  # of templates at one place the smallest id is nearest
    j = left.join(once.select(key, c("id").alias("template"), "v", cell(c("v"), most).alias("__c")), [key, "__c"]).withColumn("d", F.abs(c("u") - c("v"))).filter(c("d") <= most)
    near = j.withColumn("rn", F.row_number().over(Window.partitionBy(key, "u").orderBy("d", "template"))).filter("rn = 1").select(key, "u", "template")
    return rows.select(key, "id", c(at).alias("u")).join(near, [key, "u"], "left").select(key, "id", "template")


def follow_up(before: DataFrame, after: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """(key, metric, before, after, delta, relative) of the metrics of two runs, long form; the relative change is null from zero."""
    long = lambda d, n: d.select(key, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("x")).select(key, "x.metric", F.col("x.v").alias(n))
    j = long(before, "before").join(long(after, "after"), [key, "metric"])
    delta = F.col("after") - F.col("before")
    return j.withColumn("delta", delta).withColumn("relative", ratio(delta, F.abs("before")))


def results_with_empty(wanted: DataFrame, found: DataFrame, key: str, timed_out: Column) -> DataFrame:
    """(key, state, lines): a record for every case: ``ok`` with its lines, ``empty`` with none and ``timeout`` with nothing at all; no result is made up."""
    n = found.groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    state = F.when(timed_out, "timeout").when(F.col("m").isNull(), "empty").otherwise("ok")
    return wanted.join(n, key, "left").select(key, state.alias("state"), F.when(~timed_out, F.coalesce("m", F.lit(0))).alias("lines"))


def blind_tasks(rows: DataFrame, key: str, show: list[str], hide: list[str], seed: int, groups: list[str]) -> DataFrame:
    """Tasks for annotators: only the columns in ``show``, under names that the seed makes, in an order that it decides; columns of ``hide`` must not be among them."""
    leak = sorted(set(show) & set(hide))
    if leak:
        raise ValueError(f"columns would give the answer away: {leak}")
    named = planning.shuffled(rows, key, seed, groups)
    return named.select(F.substring(F.sha2(F.concat_ws(",", F.lit(seed).cast("string"), F.col(key).cast("string")), 256), 1, 12).alias("task"), *groups, "place", *show)


def transition_residuals(points: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """(key, n, p50, p90): how far points (key, s, z) lie from the straight way between two sections' heights (key, s, z)."""
    at = intervals.interpolate(points.withColumnRenamed("z", "__z"), ends.select(key, F.col("s").alias("__s"), "z"), key, "s", "__s", "z")
    return at.withColumn("r", F.abs(F.col("__z") - F.col("z"))).groupBy(key).agg(F.count("r").alias("n"), F.percentile("r", 0.5).alias("p50"), F.percentile("r", 0.9).alias("p90"))


def regression_guard(lines: DataFrame, support: DataFrame, key: str, lost: int, relative: float, absolute: float) -> DataFrame:
    """(key, passed, reasons) of a candidate against its baseline: ``lines`` (key, baseline, candidate, matched) must keep every line and lose at most ``lost``, extra lines must form pairs; ``support`` (key, p90, n_p90, coverage,
    n_coverage): p90 may grow by a share or an amount, coverage may not fall."""
    c = F.col
    j = lines.join(support, key)
    miss = lambda ok, name: F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
    reasons = F.array_compact(F.array(miss(c("matched") == c("baseline"), "lines_lost"), miss(c("baseline") - c("candidate") <= lost, "fewer_lines"), miss((c("candidate") - c("matched")) % 2 == 0, "half_pair"),
                                      miss((c("n_p90") <= c("p90") * (1 + relative)) | (c("n_p90") <= c("p90") + absolute), "p90"), miss(c("n_coverage") >= c("coverage"), "coverage")))
    return j.select(key, F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("passed"))
