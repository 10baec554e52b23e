"""Planes of most points by hypotheses and votes, and clusters by density without pairs of dense cells' points."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import cell
from .lineage import cut, discard
from .robust import SMALL, determinant
from .spatial import components

c = F.col
AXES = "xyz"


def finite(*names: str) -> Column:
    """Neither null nor NaN nor infinite."""
    ok = F.lit(True)
    for n in names:
        ok = ok & F.coalesce(F.abs(c(n)) < float("inf"), F.lit(False))
    return ok


@dataclass(frozen=True)
class PlaneLimits:
    """Limits of ``plane_segments``; fixed values of the method, in the unit of the points."""

    hypotheses: int = 64  # triples of points a key and round
    tolerance: float = 0.035
    least_points: int = 10
    planes: int = 1


def triples(points: DataFrame, key: str, seed: int, limits: PlaneLimits) -> DataFrame:
    """(key, h, nx, ny, nz, offset): planes n p = offset through triples of a key's points. A hash of the id deals points to buckets, of which the least and the greatest by that hash
    and the least by the hash read backwards are a triple: one aggregation, and the same triples however the points lie."""
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), c("id").cast("string")).cast("binary"))
    rows = points.withColumn("mark", mark).withColumn("h", F.conv(F.substring("mark", 1, 6), 16, 10).cast("long") % limits.hypotheses).withColumn("p", F.struct(*AXES))
    t = rows.groupBy(key, "h").agg(F.min_by("p", "mark").alias("a"), F.max_by("p", "mark").alias("b"), F.min_by("p", F.reverse("mark")).alias("d"))
    u, v = ([c(f"{k}.{a}") - c(f"a.{a}") for a in AXES] for k in "bd")
    across = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    size = F.sqrt(across[0] * across[0] + across[1] * across[1] + across[2] * across[2])
    t = t.withColumn("size", size).filter("size > 1e-9").select(key, "h", "a", *[(n / c("size")).alias(f"n{a}") for n, a in zip(across, AXES)])
    return t.select(key, "h", "nx", "ny", "nz", (c("nx") * c("a.x") + c("ny") * c("a.y") + c("nz") * c("a.z")).alias("offset"))


def off() -> Column:
    return F.abs(c("nx") * c("x") + c("ny") * c("y") + c("nz") * c("z") - c("offset"))


def fitted(sums: DataFrame) -> DataFrame:
    """``sums`` with the least eigenvalue of the symmetric matrix of moments (mxx .. mzz), ``least``, and a unit vector of it (fx, fy, fz), in closed form, step by step as columns."""
    at = lambda i, j: "m" + AXES[min(i, j)] + AXES[max(i, j)]
    cross = lambda u, v: [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    df = sums.withColumn("mid", (c("mxx") + c("myy") + c("mzz")) / 3)
    spread = sum(((c(at(i, i)) - c("mid")) ** 2 for i in range(3)), F.lit(0.0)) + 2 * (c("mxy") ** 2 + c("mxz") ** 2 + c("myz") ** 2)
    df = df.withColumn("p", F.sqrt(spread / 6))
    df = df.withColumn("half", determinant([[c(at(i, j)) - c("mid") if i == j else c(at(i, j)) for j in range(3)] for i in range(3)]) / (2 * c("p") ** 3))
    turn = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c("half")))) / 3 + 2 * math.pi / 3
    df = df.withColumn("least", F.greatest(F.lit(0.0), F.when(c("p") > 0, c("mid") + 2 * c("p") * F.cos(turn)).otherwise(c("mid"))))
    rows = [[c(at(i, j)) - c("least") if i == j else c(at(i, j)) for j in range(3)] for i in range(3)]
    df = df.withColumns({f"w{k}{a}": v for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))) for a, v in zip(AXES, cross(rows[i], rows[j]))})
    norm = lambda k: F.sqrt(sum((c(f"w{k}{a}") ** 2 for a in AXES), F.lit(0.0)))
    df = df.withColumn("w", F.greatest(*[F.struct(norm(k).alias("n"), *[c(f"w{k}{a}").alias(a) for a in AXES]) for k in range(3)]))
    return df.withColumns({f"f{a}": F.when(c("w.n") > 0, c(f"w.{a}") / c("w.n")) for a in AXES})


def plane_segments(points: DataFrame, key: str, limits: PlaneLimits = PlaneLimits()) -> tuple[DataFrame, DataFrame]:
    """Planes (key, plane, n, nx, ny, nz, offset, rms, fx, fy, fz) of points (key, id, x, y, z), and the points that lie on none.

    Every round counts the points within ``tolerance`` of each hypothesis for all keys at once, takes each key's plane of most points (ties: the lower hypothesis), fits its points by their
    moments (f: normal of least squares, rms: distance from that plane) and removes them. Votes are counted where the points lie; a key's points never come together, whatever their number.
    Keys without a plane of ``least_points`` keep all their points. Null, NaN and infinite coordinates take no part in either result; ids should be unique.
    """
    left = cut(points.filter(finite(*AXES) & c(key).isNotNull() & c("id").isNotNull()).select(key, "id", *AXES))
    found = None
    for plane in range(1, limits.planes + 1):
        lines = cut(triples(left, key, plane, limits))
        votes = left.join(F.broadcast(lines) if lines.count() <= SMALL else lines, key).filter(off() <= limits.tolerance).groupBy(key, "h", "nx", "ny", "nz", "offset").agg(F.count(F.lit(1)).alias("n"))
        best = votes.filter(c("n") >= limits.least_points).groupBy(key).agg(F.min_by(F.struct("n", "nx", "ny", "nz", "offset"), F.struct(-c("n"), c("h"))).alias("b"))
        best = cut(best.select(key, "b.*"))
        discard(lines)
        some = best.count()
        if not some:
            break
        near = F.broadcast(best) if some <= SMALL else best
        on = left.join(near, key).filter(off() <= limits.tolerance)
        # moments about the plane's foot, so that far-away places lose no digits
        part = {a: c(a) - c(f"n{a}") * c("offset") for a in AXES}
        two = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
        sums = on.groupBy(key).agg(F.first(F.struct("n", "nx", "ny", "nz", "offset")).alias("b"), *[F.sum(part[a]).alias(f"s{a}") for a in AXES], *[F.sum(part[a] * part[b]).alias(f"s{a}{b}") for a, b in two])
        sums = cut(sums.select(key, "b.*", *[(c(f"s{a}{b}") - c(f"s{a}") * c(f"s{b}") / c("b.n")).alias(f"m{a}{b}") for a, b in two]))
        fits = cut(fitted(sums).select(key, F.lit(plane).alias("plane"), "n", "nx", "ny", "nz", "offset", F.sqrt(c("least") / c("n")).alias("rms"), *[f"f{a}" for a in AXES]))
        discard(sums)
        found = fits if found is None else found.unionByName(fits)
        gone = left.join(near, key, "left").filter(c("nx").isNull() | (off() > limits.tolerance))
        before, left = left, cut(gone.select(key, "id", *AXES))
        discard(before)
        discard(best)
    if found is None:
        kind = dict(points.dtypes)[key]
        found = points.sparkSession.createDataFrame([], f"{key} {kind}, plane int, n long, nx double, ny double, nz double, offset double, rms double, fx double, fy double, fz double")
    return found, left


LEVELS = 3  # halvings of a dense cell before its points are compared


def steps(ahead: bool) -> Column:
    near = [(i, j, k) for i in range(-2, 3) for j in range(-2, 3) for k in range(-2, 3) if not ahead or (i, j, k) > (0, 0, 0)]
    return F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(s, "ijk")]) for s in near])).alias("s")


def distance(a: str, b: str) -> Column:
    return F.sqrt(sum(((c(f"{a}{x}") - c(f"{b}{x}")) ** 2 for x in AXES), F.lit(0.0)))


def box_links(dense: DataFrame, pairs: DataFrame, radius: float, side: float, links: DataFrame) -> DataFrame:
    """``links`` and those of ``pairs`` (a, b) of dense cells with points within ``radius``: the bounds of their halves, quarters, ... decide most pairs for or against, and pairs whose cells
    are joined by others are not followed. What is open after LEVELS halvings is decided by its points."""
    at = [F.floor(c(x) / side).alias(f"s{x}") for x in AXES]
    lo, hi = [f"lo{x}" for x in AXES], [f"hi{x}" for x in AXES]
    open_pairs = pairs.select("a", "b")
    if not open_pairs.limit(1).count():
        return links
    for level in range(LEVELS + 1):
        if level:
            at = [F.floor(c(x) / (side / 2**level)).alias(f"s{x}") for x in AXES]
        ends = open_pairs.select(c("a").alias("node")).union(open_pairs.select(c("b").alias("node"))).distinct()
        boxes = dense.join(ends, "node", "left_semi").groupBy("node", *at).agg(*[f(x).alias(n + x) for n, f in (("lo", F.min), ("hi", F.max)) for x in AXES])
        side_of = lambda p: boxes.select(c("node").alias(p), *[c(f"s{x}").alias(f"{p}s{x}") for x in AXES], *[F.shiftright(f"s{x}", 1).alias(f"{p}u{x}") for x in AXES], *[c(n).alias(p + n) for n in (*lo, *hi)])
        on = lambda p: [p] if level < 1 else [p, *[f"{p}u{x}" for x in AXES]]
        j = open_pairs.join(side_of("a"), on("a")).join(side_of("b"), on("b"))
        gap = [F.greatest(F.lit(0.0), c(f"alo{x}") - c(f"bhi{x}"), c(f"blo{x}") - c(f"ahi{x}")) for x in AXES]
        far = [F.greatest(c(f"ahi{x}") - c(f"blo{x}"), c(f"bhi{x}") - c(f"alo{x}")) for x in AXES]
        size = lambda v: F.sqrt(sum((w ** 2 for w in v), F.lit(0.0)))
        keep = ["a", "b", *[f"{p}s{x}" for p in "ab" for x in AXES]]
        j = cut(j.withColumn("sure", size(far) <= radius).filter(size(gap) <= radius).select(*keep, "sure"))
        links = links.union(j.filter("sure").select("a", "b").distinct())
        if not j.filter("not sure").limit(1).count():
            return links
        parts = components(links)
        part = lambda p: parts.select(c("id").alias(p), c("component").alias(f"{p}_part"))
        rest = j.filter("not sure").join(part("a"), "a").join(part("b"), "b").filter("a_part <> b_part")
        open_pairs = cut(rest.select("a", "b", *[c(f"{p}s{x}").alias(f"{p}u{x}") for p in "ab" for x in AXES]))
        if not open_pairs.limit(1).count():
            return links
    one = lambda p: dense.select(c("node").alias(p), *[a.alias(f"{p}u{x}") for a, x in zip(at, AXES)], *[c(x).alias(p + x) for x in AXES]).distinct()
    met = open_pairs.join(one("a"), on("a")).join(one("b"), on("b")).filter(distance("a", "b") <= radius)
    return links.union(met.select("a", "b")).distinct()


def density_clusters(points: DataFrame, radius: float, least: int, key: str | None = None) -> DataFrame:
    """(key, id, cluster, core): points (key, id, x, y, z) with ``least`` or more within ``radius`` (themselves included) are cores and join each other there; a border point goes to the
    smallest cluster it touches, others have none. A cluster is named by its smallest core.

    Cells have a diagonal of ``radius``: a cell of ``least`` points is all core and needs no pairs of its own, and dense cells meet by the bounds of their parts. Pairs of points are formed
    only for the fewer than ``least`` points of a sparse cell with their surroundings, so their number goes with the points, not with their density. Null, NaN and infinite
    coordinates give points without a cluster; ids should be unique.
    """
    keys = [key] if key else []
    side = radius / math.sqrt(3) * (1 - 1e-9)
    at = [*keys, *[f"v{x}" for x in AXES]]
    p = points.filter(finite(*AXES)).select(*keys, "id", *AXES, *[cell(c(x), side).alias(f"v{x}") for x in AXES])
    cells = cut(p.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low")))
    p = cut(p.join(cells, at))
    target = lambda df, ahead, *more: df.select(*at, *more, steps(ahead)).select(*keys, *more, *[c(f"v{x}").alias(f"w{x}") for x in AXES], *[(c(f"v{x}") + c(f"s.{n}")).alias(f"v{x}") for x, n in zip(AXES, "ijk")])
    around = target(cells.filter(c("n") < least), False).join(cells.select(*at), at)
    own = p.filter(c("n") < least).select(*keys, c("id").alias("a"), *[c(x).alias(f"a{x}") for x in AXES], *[c(f"v{x}").alias(f"w{x}") for x in AXES])
    seen = own.join(around, [*keys, *[f"w{x}" for x in AXES]]).join(p.select(*at, c("id").alias("b"), *[c(x).alias(f"b{x}") for x in AXES]), at)
    near = cut(seen.filter(distance("a", "b") <= radius).select("a", "b"))
    full = c("n") >= least
    some = near.groupBy(c("a").alias("id")).agg(F.count(F.lit(1)).alias("k")).filter(c("k") >= least).select("id")
    thin = p.filter(~full).join(some, "id", "left_semi")
    # one node a cell with cores, its smallest core; all cores of a cell lie within the radius
    nodes = cut(thin.groupBy(*at).agg(F.min("id").alias("node")).unionByName(cells.filter(full).select(*at, c("low").alias("node"))))
    dense = cut(p.filter(full).select("id", c("low").alias("node"), *AXES))
    cores = cut(dense.select("id", "node").unionByName(thin.join(nodes, at).select("id", "node")))
    name = lambda k: cores.select(c("id").alias(k), c("node").alias(f"{k}_node"))
    met = near.join(name("a"), "a").join(name("b"), "b").select(c("a_node").alias("a"), c("b_node").alias("b"))
    links = cut(nodes.select(c("node").alias("a"), c("node").alias("b")).union(met).distinct())
    whole = cells.filter(full)
    pairs = target(whole, True, "low").select(*at, c("low").alias("a")).join(whole.select(*at, c("low").alias("b")), at).select("a", "b")
    parts = components(box_links(dense, cut(pairs), radius, side, links))
    named = cores.join(parts.withColumnRenamed("id", "node"), "node").select("id", c("component").alias("cluster"), F.lit(True).alias("core"))
    border = near.join(cores.select(c("id").alias("a")), "a", "left_anti").join(named.select(c("id").alias("b"), "cluster"), "b").groupBy(c("a").alias("id")).agg(F.min("cluster").alias("cluster"))
    named = named.unionByName(border.withColumn("core", F.lit(False)))
    return points.select(*keys, "id").join(named, "id", "left").select(*keys, "id", "cluster", F.coalesce("core", F.lit(False)).alias("core"))
