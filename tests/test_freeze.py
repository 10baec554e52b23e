"""Releases that freeze, and those that do not."""

import hashlib

from strataspark.operators import freeze


def test_states_and_digests(spark, monkeypatch):
    monkeypatch.setattr(freeze, "BLOCK_IDS", 7)
    many = [f"id{i * 7919 % 1000}" for i in range(1000)]
    assets = [(1, i, "accepted") for i in many] + [(2, "b", "accepted"), (2, "a", "candidate"), (2, "c", None), (2, None, "accepted")] + [(4, "x", "accepted"), (4, "x", "accepted"), (5, "é", "accepted"), (5, "z", "accepted"), (None, "q", "accepted")]
    assets += [(6, f"p{i:03d}", "candidate") for i in range(300)]
    releases = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 6, None)], "release long")
    got = {r.release: r for r in freeze.freeze_releases(releases, spark.createDataFrame(assets, "release long, id string, status string").repartition(4)).collect()}
    digest = lambda ids: hashlib.sha256("\n".join(sorted(ids, key=str.encode)).encode()).hexdigest()
    assert (got[1].state, got[1].n_assets, got[1].asset_set_sha256) == ("frozen", 1000, digest(many))
    assert (got[2].state, got[2].n_blocking, got[2].blocking, got[2].asset_set_sha256) == ("blocked", 3, ",a,c", None)
    assert (got[3].state, got[3].n_assets) == ("empty", 0) and got[4].state == "invalid"
    assert got[5].asset_set_sha256 == digest(["é", "z"])
    assert got[6].blocking == ",".join(f"p{i:03d}" for i in range(20)) and len(got) == 6
