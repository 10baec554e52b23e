"""Column expressions: frames, predicates on shapes, projections to images, ramps and rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def world(along: Column, across: Column, origin: tuple[float, float], axis: tuple[float, float]) -> tuple[Column, Column]:
    """The inverse of ``geometry.along`` and ``geometry.across``."""
    return F.lit(origin[0]) + along * axis[0] - across * axis[1], F.lit(origin[1]) + along * axis[1] + across * axis[0]


def in_box(low: dict[str, float], high: dict[str, float]) -> Column:
    """Membership of a closed box in any number of axes."""
    test = F.lit(True)
    for axis in low:
        test = test & F.col(axis).between(low[axis], high[axis])
    return test


def in_convex(x: Column, y: Column, hull: list[tuple[float, float]]) -> Column:
    """Whether a point lies in or on a convex polygon whose corners go counterclockwise: left of or on every edge."""
    test = F.lit(True)
    for (ax, ay), (bx, by) in zip(hull, hull[1:] + hull[:1]):
        test = test & ((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0)
    return test


def in_triangle(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Whether a point lies in or on a triangle of either orientation: no two edge tests of opposite sign."""
    tests = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1])]
    return ~(F.least(*tests) < 0) | ~(F.greatest(*tests) > 0)


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def ramp(value: Column, start: float, span: float) -> Column:
    """0 up to ``start``, 1 from ``start + span`` on."""
    return clamp((value - start) / span)


def falloff(value: Column, span: float) -> Column:
    return F.lit(1.0) - clamp(value / span)


def smoothstep(value: Column, start: float, stop: float) -> Column:
    if start >= stop:
        raise ValueError("a transition must start before it stops")
    t = clamp((value - start) / (stop - start))
    return t * t * (3.0 - 2.0 * t)


def equirectangular(x: Column, y: Column, z: Column, width: int, height: int) -> tuple[Column, Column]:
    """Pixel (u, v) of a viewing direction; null for directions shorter than 1e-12. u wraps round, v is clipped."""
    length = F.sqrt(x * x + y * y + z * z)
    turn = (F.atan2(x, z) / (2 * math.pi) + 0.5) * width
    u = turn - F.floor(turn / width) * width
    v = clamp((0.5 - F.asin(clamp(y / length, -1.0, 1.0)) / math.pi) * height, 0.0, float(height - 1))
    return F.when(length > 1e-12, u), F.when(length > 1e-12, v)


def colour_features(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """Excess green, saturation, darkness and dominance of green of one colour."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    one = F.lit(1.0)
    return {"excess_green": (2 * g - r - b) / F.greatest(r + g + b, one), "saturation": (top - low) / F.greatest(top, one),
            "dark": (top < 60).cast("double"), "green": ((g > r * 1.05) & (g > b * 1.05)).cast("double")}


def scope(station: Column, low: Column, high: Column, slack: float) -> Column:
    """Which segment a station belongs to."""
    return F.when(station < low - slack, "previous").when(station > high + slack, "next").otherwise("within")


def span_scope(start: Column, stop: Column, low: Column, high: Column, slack: float) -> Column:
    """How a span lies to a segment."""
    return (F.when((start >= low - slack) & (stop <= high + slack), "within")
            .when((stop < low - slack) | (start > high + slack), "outside").otherwise("crosses"))


def overlap_ratio(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """The overlap of two intervals as a part of the shorter one."""
    both = F.greatest(F.lit(0.0), F.least(high_a, high_b) - F.greatest(low_a, low_b))
    return both / F.least(F.greatest(F.lit(1e-9), high_a - low_a), F.greatest(F.lit(1e-9), high_b - low_b))


def best_class(scores: dict[str, Column]) -> dict[str, Column]:
    """Scores that add up to 1, the best class (ties to the earlier one), its margin to the second and a confidence."""
    total = F.greatest(sum(scores.values(), F.lit(0.0)), F.lit(1e-12))
    share = {k: v / total for k, v in scores.items()}
    ranked = F.array_sort(F.array(*[F.struct((-v).alias("s"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, v) in enumerate(share.items())]))
    top, margin = -ranked[0]["s"], ranked[1]["s"] - ranked[0]["s"]
    sure = F.when((top >= 0.55) & (margin >= 0.20), "high").when((top >= 0.40) & (margin >= 0.08), "medium").otherwise("low")
    return {"predicted": ranked[0]["k"], "top_score": top, "margin": margin, "confidence": sure}
