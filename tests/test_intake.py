import pytest

from strataspark.operators import gating
from strataspark.sources import intake as io


def test_strict_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿index,x,file\n1,2.5,a\n2,bad,b\n", encoding="utf-8")
    rows = io.strict_csv(spark, str(tmp_path / "a.csv"), {"index": "long", "x": "double"}).collect()
    assert [(r["index"], r.x, r.file) for r in rows] == [(1, 2.5, "a"), (2, None, "b")]
    with pytest.raises(ValueError, match="missing"):
        io.strict_csv(spark, str(tmp_path / "a.csv"), {"y": "double"})
    (tmp_path / "b.csv").write_text("index,x\n")
    with pytest.raises(ValueError, match="empty"):
        io.strict_csv(spark, str(tmp_path / "b.csv"), {"x": "double"})


def test_json_catalogue_labels_and_lineage(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": "a",\n "n": 3}')
    assert io.json_objects(spark, str(tmp_path / "one.json"), "id string, n int").first().n == 3
    src = spark.createDataFrame([("a", 1, None), ("b", 2, 9)], "id string, position int, priority int")
    assert {r.id: r.priority for r in io.source_catalogue(src).collect()} == {"a": 1, "b": 9}
    with pytest.raises(ValueError, match="not unique"):
        io.source_catalogue(src.union(src))
    x, y = io.unlabelled(spark.createDataFrame([(1, 2.0, "c")], "k int, x double, label string"), ["k"], ["x"], "label")
    assert x.columns == ["k", "x"] and y.columns == ["k", "label"]
    for i in range(2):
        io.append_lineage(spark, str(tmp_path / "lineage"), f"run{i}", "ok", {"a": "00", "b": "11"})
    assert spark.read.parquet(str(tmp_path / "lineage")).count() == 4
    io.write_report(src, str(tmp_path / "r"), "csv")
    with pytest.raises(Exception, match="(?i)exist"):
        io.write_report(src, str(tmp_path / "r"), "csv")


def test_imports_and_patches_refuse_conflicts(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    with pytest.raises(ValueError, match="more than once"):
        gating.import_records(base, base.union(base), "id", True)
    with pytest.raises(ValueError, match="exists"):
        gating.import_records(base, base.limit(1), "id", False)
    asset = spark.createDataFrame([(1, "s", {"k": "v"}, ["l"])], "id int, state string, parameters map<string,string>, limits array<string>")
    other = spark.createDataFrame([(1, "s", {"k": "w"}, ["l"])], asset.schema)
    with pytest.raises(ValueError, match="differs"):
        gating.additive_patch(asset, asset.limit(0), other, "id", ["state"])
    with pytest.raises(ValueError, match="unknown"):
        gating.additive_patch(asset.limit(0), asset, asset.limit(0), "id", ["state"])
