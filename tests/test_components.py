import random

from strataspark.operators import lineage, spatial


def brute(links):
    comp = {x: x for e in links for x in e}
    for _ in comp:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return comp


def test_components_in_one_task_and_by_spreading_labels(spark, monkeypatch):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(20)] + [(500, i) for i in range(501, 530)] + [(900, 900)]
    frame = spark.createDataFrame([*links, (None, 5)], "a long, b long").repartition(5)
    want = brute(links)
    assert {r.id: r.component for r in spatial.components(frame).collect()} == want
    monkeypatch.setattr(spatial, "ONE_TASK_LINKS", 0)
    assert {r.id: r.component for r in spatial.components(frame).collect()} == want
    assert spatial.components(frame.limit(0)).count() == 0


def test_cut_tables_are_deleted(spark):
    import os

    t = lineage.cut(spark.range(3))
    assert t.count() == 3 and os.path.isdir(t._cut_path.removeprefix("file:"))
    lineage.discard(t)
    assert not os.path.isdir(t._cut_path.removeprefix("file:"))
