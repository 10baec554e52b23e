"""Gates over reports, registries, releases and candidates: a missing or unknown value blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import ratio

# Report states that pass.
PASSING = ["pass", "passed", "accepted"]
EXACT = ["PASS", "PASS_WITH_WAIVER"]


def report_passed(status: Column, flag: Column) -> Column:
    """Whether a report passes: by its explicit state if it has one, else by its flag; nothing at all does not."""
    return F.when(status.isNotNull(), F.trim(status).isin(EXACT) | F.lower(F.trim(status)).isin(PASSING)).otherwise(F.coalesce(flag, F.lit(False)))


def valid_waivers(waivers: DataFrame, hashes: DataFrame, now: Column) -> DataFrame:
    """(check_id) of the waivers (waiver_id, check_id, sha, approver, expires, reason), one row for each artifact and approver, that hold: every artifact is a current
    one, two different approvers signed, it has not expired and gives a reason."""
    known = hashes.select(F.col("sha"), F.lit(True).alias("__known")).distinct()
    w = waivers.join(known, "sha", "left")
    name = F.when(F.trim("approver") != "", F.trim("approver"))
    g = w.groupBy("waiver_id", "check_id").agg(F.count_distinct(name).alias("n"), F.bool_and(F.coalesce("__known", F.lit(False))).alias("bound"), F.min("expires").alias("expires"), F.max(F.trim("reason")).alias("reason"))
    return g.filter((F.col("n") >= 2) & F.col("bound") & (F.col("expires") > now) & (F.col("reason") != "")).select("check_id").distinct()


def quality_gate(checks: DataFrame, waived: DataFrame, approvals: DataFrame, roles: list[str], hashes: DataFrame) -> DataFrame:
    """(gate, checks, failed, waived, missing_roles, status). ``checks`` (gate, check_id, status, flag, waivable); ``approvals`` (gate, role, decision, sha): a role
    counts where an approval is bound to current artifacts. A gate without checks fails, as does one with a failing check that no waiver
    covers or a missing role; with waivers it passes with waiver."""
    c = F.col
    j = checks.join(waived.withColumn("__w", F.lit(True)), "check_id", "left").withColumn("ok", report_passed(c("status"), c("flag")))
    saved = ~c("ok") & c("waivable") & F.coalesce("__w", F.lit(False))
    sums = j.groupBy("gate").agg(F.count(F.lit(1)).alias("checks"), F.count(F.when(~c("ok") & ~saved, 1)).alias("failed"), F.count(F.when(saved, 1)).alias("waived"))
    bound = approvals.filter((c("decision") == "approved") & c("role").isin(roles)).join(hashes.select("sha").distinct(), "sha", "left_semi")
    signed = bound.groupBy("gate").agg(F.count_distinct("role").alias("__roles"))
    out = sums.join(signed, "gate", "left").withColumn("missing_roles", len(roles) - F.coalesce("__roles", F.lit(0)))
    status = F.when((c("checks") == 0) | (c("failed") > 0) | (c("missing_roles") > 0), "FAIL").when(c("waived") > 0, "PASS_WITH_WAIVER").otherwise("PASS")
    return out.select("gate", "checks", "failed", "waived", "missing_roles", status.alias("status"))


def all_pass(df: DataFrame, key: list[str], ok: Column) -> DataFrame:
    """(key, members, passed): passing only if there are members and all pass; null fails."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.bool_and(F.coalesce(ok, F.lit(False))).alias("passed"))


def two_tier(findings: DataFrame, key: str, code: str, soft: list[str], never: list[str]) -> DataFrame:
    """(key, errors, warnings, status): codes of the allow-list are warnings, but those in ``never`` stay errors whatever the list says."""
    mild = F.col(code).isin(soft) & ~F.col(code).isin(never)
    out = findings.groupBy(key).agg(F.count(F.when(~F.coalesce(mild, F.lit(False)), 1)).alias("errors"), F.count(F.when(mild, 1)).alias("warnings"))
    return out.withColumn("status", F.when(F.col("errors") > 0, "blocked").when(F.col("warnings") > 0, "pass_with_warnings").otherwise("pass"))


def release_audit(assets: DataFrame, relations: DataFrame, promoted: list[str]) -> DataFrame:
    """(check_id, failures) of a release: ids that come twice, relations whose ends are unknown, assets in a promoted state, assets without a digest."""
    ids = assets.select(F.col("id").alias("k")).distinct()
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_id"), "failures")
    loose = lambda end: relations.join(ids, relations[end] == ids.k, "left_anti")
    parts = [n(assets.groupBy("id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "duplicate_ids"), n(loose("a"), "dangling_from"), n(loose("b"), "dangling_to"),
             n(assets.filter(F.lower("state").isin(promoted)), "promoted_state"), n(assets.filter(F.col("digest").isNull() | (F.length("digest") != 64)), "missing_digest")]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def preflight(points: DataFrame, model: DataFrame, key: str, axes: str = "xyz") -> DataFrame:
    """(key, axis_overlap, volume_overlap, centre_distance): how the extents of points and of a model of each key fit: the least overlap of an axis as a part of the model's
    extent, the shared volume as a part of the model's, the distance of the centres."""
    ends = lambda df, p: df.groupBy(key).agg(*[f(a).alias(f"{p}{a}{n}") for a in axes for n, f in (("0", F.min), ("1", F.max))])
    j = ends(points, "p").join(ends(model, "m"), key)
    c = F.col
    share = [F.greatest(F.lit(0.0), F.least(f"p{a}1", f"m{a}1") - F.greatest(f"p{a}0", f"m{a}0")) / F.greatest(F.lit(1e-9), c(f"m{a}1") - c(f"m{a}0")) for a in axes]
    volume = share[0]
    for x in share[1:]:
        volume = volume * x
    apart = [(c(f"p{a}0") + c(f"p{a}1") - c(f"m{a}0") - c(f"m{a}1")) / 2 for a in axes]
    return j.select(key, F.least(*share).alias("axis_overlap"), volume.alias("volume_overlap"), F.sqrt(sum((x * x for x in apart), F.lit(0.0))).alias("centre_distance"))


def claims(df: DataFrame, owners: DataFrame, kinds: dict[str, str], methods: list[str], most: float) -> DataFrame:
    """(id, reasons, accepted) of claims (id, relation, a, b, method, residual, state) that one asset carries another: the owner is the end that the relation's kind names
    (``kinds``: relation -> end), must be registered and modelled (owners: id, modelled), and the evidence must be a direct contact
    of a listed method with a finite residual within ``most``. Nearness alone and accepted or formal states are refused."""
    c = F.col
    side = None
    for relation, end in kinds.items():
        side = F.when(c("relation") == relation, c(end)) if side is None else side.when(c("relation") == relation, c(end))
    j = df.withColumn("__owner", side).join(owners.select(c("id").alias("__owner"), c("modelled"), F.lit(True).alias("__known")), "__owner", "left")
    rule = lambda bad, name: F.when(F.coalesce(bad, F.lit(True)), F.lit(name))
    reasons = F.array_compact(F.array(
        F.when(c("__owner").isNull(), F.lit("unknown_relation")), F.when(c("__owner").isNotNull() & c("__known").isNull(), F.lit("unregistered_owner")),
        F.when(c("__known") & ~F.coalesce("modelled", F.lit(False)), F.lit("owner_not_modelled")), rule(c("method") == "proximity", "proximity_only"), rule(~c("method").isin(methods), "method_not_listed"),
        rule(c("residual").isNull() | F.isnan("residual") | (c("residual") > most), "residual"), rule(c("state").isin("accepted", "formal"), "state")))
    return j.select("id", F.array_join(F.array_sort(reasons), ",").alias("reasons"), (F.size(reasons) == 0).alias("accepted"))


def asset_gate(df: DataFrame, minimum: dict[str, float], clearance: float) -> DataFrame:
    """(id, class, reasons, passed) of assets (id, class, views, shaft, base, occupancy, clearance): two trusted views, a visible shaft, a supported base, the occupancy that its
    class asks for, and for the first class of ``minimum`` a clearance of at least ``clearance``; a missing value fails."""
    c = F.col
    need = None
    for kind, low in minimum.items():
        need = F.when(c("class") == kind, low) if need is None else need.when(c("class") == kind, low)
    miss = lambda ok, name: F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
    free = (c("class") != next(iter(minimum))) | (c("clearance") >= clearance)
    reasons = F.array_compact(F.array(miss(c("views") >= 2, "views"), miss(c("shaft"), "shaft"), miss(c("base"), "base"), miss(c("occupancy") >= need, "occupancy"), miss(free, "clearance")))
    return df.select("id", "class", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("passed"))


def before_after(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, p90_better, coverage_better, unexplained_better, target_gone, passed) of scenes measured before and after (key, p90, coverage, unexplained, targets): everything
    must get better and a target that was there must be gone."""
    c = F.col
    j = before.join(after.select(key, *[c(x).alias(f"n_{x}") for x in ("p90", "coverage", "unexplained", "targets")]), key, "left")
    tests = {"p90_better": c("n_p90") < c("p90"), "coverage_better": c("n_coverage") > c("coverage"), "unexplained_better": c("n_unexplained") < c("unexplained"), "target_gone": (c("targets") > 0) & (c("n_targets") == 0)}
    out = j.select(key, *[F.coalesce(v, F.lit(False)).alias(k) for k, v in tests.items()])
    return out.withColumn("passed", c("p90_better") & c("coverage_better") & c("unexplained_better") & c("target_gone"))


def closures(gaps: DataFrame, sides: dict[str, DataFrame], ok: Column, key: str = "id") -> DataFrame:
    """(id, complete, closed): gaps joined with every kind of evidence; a gap that lacks one is not complete and never closed."""
    j = gaps.select(key)
    for name, df in sides.items():
        j = j.join(df.withColumn(f"__{name}", F.lit(True)), key, "left")
    whole = F.lit(True)
    for name in sides:
        whole = whole & F.coalesce(f"__{name}", F.lit(False))
    return j.select(key, whole.alias("complete"), (whole & F.coalesce(ok, F.lit(False))).alias("closed"))


def within_limits(df: DataFrame, limits: dict[str, float]) -> Column:
    """Whether every metric is within its limit of the same name; null fails."""
    ok = F.lit(True)
    for name, most in limits.items():
        ok = ok & F.coalesce(F.abs(F.col(name)) <= most, F.lit(False))
    return ok


def mesh_audit(vertices: DataFrame, faces: DataFrame, least_area: float) -> DataFrame:
    """(object, vertices, faces, not_finite, bad_index, degenerate, duplicate_faces, duplicate_places, open_edges) of meshes: vertices (object, vid, x, y, z), faces (object, fid, a, b, c) of
    vertex ids. An edge is open if it has one face."""
    c = F.col
    bad = F.lit(False)
    for a in "xyz":
        bad = bad | c(a).isNull() | F.isnan(a) | (F.abs(a) == float("inf"))
    place = vertices.groupBy("object", "x", "y", "z").agg(F.count(F.lit(1)).alias("m"))
    v = vertices.groupBy("object").agg(F.count(F.lit(1)).alias("vertices"), F.count(F.when(bad, 1)).alias("not_finite")).join(
        place.groupBy("object").agg(F.sum(c("m") - 1).alias("duplicate_places")), "object")
    corner = faces.select("object", "fid", F.posexplode(F.array("a", "b", "c")).alias("k", "vid"))
    j = corner.join(vertices.select("object", "vid", "x", "y", "z"), ["object", "vid"], "left")
    at = lambda k, a: F.max(F.when(c("k") == k, c(a)))
    f = j.groupBy("object", "fid").agg(F.count("x").alias("found"), F.array_sort(F.collect_list("vid")).alias("ids"), *[at(k, a).alias(f"{a}{k}") for k in range(3) for a in "xyz"])
    u, w = [c(f"{a}1") - c(f"{a}0") for a in "xyz"], [c(f"{a}2") - c(f"{a}0") for a in "xyz"]
    area = F.sqrt((u[1] * w[2] - u[2] * w[1]) ** 2 + (u[2] * w[0] - u[0] * w[2]) ** 2 + (u[0] * w[1] - u[1] * w[0]) ** 2) / 2
    again = F.row_number().over(Window.partitionBy("object", "ids").orderBy("fid")) > 1
    f = f.withColumn("again", again).withColumn("area", area)
    sums = f.groupBy("object").agg(F.count(F.lit(1)).alias("faces"), F.count(F.when(c("found") < 3, 1)).alias("bad_index"), F.count(F.when((c("found") == 3) & (c("area") <= least_area), 1)).alias("degenerate"),
                                   F.count(F.when(c("again"), 1)).alias("duplicate_faces"))
    ends = faces.select("object", F.explode(F.array(*[F.struct(F.least(p, q).alias("p"), F.greatest(p, q).alias("q")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))])).alias("e"))
    open_ = ends.groupBy("object", "e").agg(F.count(F.lit(1)).alias("m")).groupBy("object").agg(F.count(F.when(c("m") == 1, 1)).alias("open_edges"))
    return v.join(sums, "object", "left").join(open_, "object", "left")


def locked(before: DataFrame, now: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state): ``same``, ``changed``, ``missing`` or ``added`` against a lock of digests."""
    a, b = before.select(key, F.col(digest).alias("__a")), now.select(key, F.col(digest).alias("__b"))
    j = a.join(b, key, "full")
    return j.select(key, F.when(F.col("__b").isNull(), "missing").when(F.col("__a").isNull(), "added").when(F.col("__a") == F.col("__b"), "same").otherwise("changed").alias("state"))


def import_records(base: DataFrame, incoming: DataFrame, key: str, replace: bool) -> DataFrame:
    """The registry after an import. Ids that come twice in the import are an error, as are ids that exist unless ``replace``; counted before
    anything is joined in."""
    twice = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the import holds the id {twice[0][key]!r} more than once")
    if not replace:
        clash = base.join(incoming.select(key), key, "left_semi").limit(1).collect()
        if clash:
            raise ValueError(f"the id {clash[0][key]!r} exists: ask for replacement")
    return base.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def additive_patch(base: DataFrame, updates: DataFrame, additions: DataFrame, key: str, sets: list[str]) -> DataFrame:
    """(key, sets, parameters, limits, change): assets (key, sets, parameters map, limits array) after a patch: columns in ``sets`` that an update gives are set, its parameters
    win in the map, its limits are appended unless they are there; additions that equal an asset change nothing, others that meet one are an
    error, as are updates of unknown ids."""
    c = F.col
    unknown = updates.join(base.select(key), key, "left_anti").limit(1).collect()
    if unknown:
        raise ValueError(f"the patch updates the unknown id {unknown[0][key]!r}")
    same = lambda p: F.sha2(F.to_json(F.struct(*[F.col(f"{p}.{x}") for x in sets], F.array_sort(F.map_entries(F.col(f"{p}.parameters"))).alias("p"), F.col(f"{p}.limits"))), 256)
    met = base.alias("o").join(additions.alias("n"), key)
    clash = met.filter(same("o") != same("n")).limit(1).collect()
    if clash:
        raise ValueError(f"the addition {clash[0][key]!r} differs from the asset of that id")
    u = updates.select(key, *[c(x).alias(f"__{x}") for x in (*sets, "parameters", "limits")], F.lit(True).alias("__u"))
    j = base.join(u, key, "left")
    empty_map, empty_list = F.create_map().cast("map<string,string>"), F.array().cast("array<string>")
    old, new = F.coalesce("parameters", empty_map), F.coalesce("__parameters", empty_map)
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    more = F.concat(F.coalesce("limits", empty_list), F.array_except(F.coalesce("__limits", empty_list), F.coalesce("limits", empty_list)))
    out = j.select(key, *[F.coalesce(f"__{x}", x).alias(x) for x in sets], F.when(c("__u"), merged).otherwise(c("parameters")).alias("parameters"), F.when(c("__u"), more).otherwise(c("limits")).alias("limits"),
                   F.when(c("__u"), "updated").otherwise("kept").alias("change"))
    fresh = additions.join(base.select(key), key, "left_anti").select(key, *sets, "parameters", "limits", F.lit("added").alias("change"))
    return out.unionByName(fresh)


def completion(gaps: DataFrame, done: DataFrame, key: str, group: str) -> DataFrame:
    """(group, gaps, closed, open, share): how many gaps of each group have a disposition."""
    j = gaps.join(done.select(key, F.lit(True).alias("__done")).distinct(), key, "left")
    out = j.groupBy(group).agg(F.count(F.lit(1)).alias("gaps"), F.count("__done").alias("closed"))
    return out.select(group, "gaps", "closed", (F.col("gaps") - F.col("closed")).alias("open"), ratio(F.col("closed"), F.col("gaps")).alias("share"))
