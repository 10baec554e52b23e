"""Curves through observations: values and slopes meet at knots, gaps are told apart."""

from strataspark.operators import mesh


def observations(spark):
    rows = [(1, 1, 0.0, 9.0, 0.0, 0.3, 5.0, 5.1, "observed"), (1, 1, 9.0, 20.0, 0.3, 0.1, 5.1, 5.0, "observed"), (1, 1, 20.4, 30.0, 0.1, 0.0, 5.0, 5.2, "rule_inferred"),
            (1, 1, 33.0, 40.0, 0.0, 0.4, 5.2, 5.2, "observed"), (1, 1, 35.0, 37.0, 0.2, 0.2, 5.2, 5.2, "rule_inferred"), (2, 1, 0.0, 4.0, 1.0, 1.0, 2.0, 2.0, "observed")]
    return spark.createDataFrame(rows, "project long, track long, c0 double, c1 double, lat0 double, lat1 double, z0 double, z1 double, evidence string")


def test_pieces_and_gaps(spark):
    got = sorted(tuple(r) for r in mesh.pieces(mesh.segments(observations(spark), 0.5)).collect())
    assert got == [(1, 1, 1, "observed", 0.0, 20.0), (1, 1, 2, "gap_inferred", 20.0, 20.4), (1, 1, 3, "rule_inferred", 20.4, 30.0), (1, 1, 4, "gap_open", 30.0, 33.0), (1, 1, 5, "observed", 33.0, 40.0), (2, 1, 1, "observed", 0.0, 4.0)]


def test_positions_and_slopes_match_at_knots(spark):
    s = mesh.segments(observations(spark), 0.5).cache()
    knots = {(r.project, r.c): (r.lat, r.t_lat) for r in s.collect()}
    rows = mesh.stations(s, 1.0).collect()
    at = {(r.project, r.station): r for r in rows}
    assert len(at) == len(rows) and not any(30 < r.station < 33 for r in rows)
    for (project, c), (lat, slope) in knots.items():
        if (project, c) in at:
            assert abs(at[project, c].lat - lat) < 1e-12 and abs(at[project, c].slope_lat - slope) < 1e-12
    fine = sorted((r for r in mesh.stations(s, 0.001).collect() if r.project == 1 and r.station < 20), key=lambda r: r.station)
    for a, b in zip(fine, fine[1:]):  # no jump in value or slope, also across the knot at 9
        assert abs(b.lat - a.lat) < 1e-3 and abs(b.slope_lat - a.slope_lat) < 1e-3
        if b.station - a.station > 1e-6:
            assert abs((b.lat - a.lat) / (b.station - a.station) - (a.slope_lat + b.slope_lat) / 2) < 1e-3
