"""Null, empty and very long values, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataspark.llm import chat_rotation, decontam, html_template, lang_id, license_scan, line_dedup, mih, mixing, ngram_join, pii

CLASH = ["id", "t", "n", "p", "w", "key", "pos", "rep", "th", "tokens", "rate", "spans", "component", "node", "n_lines", "n_removed", "h", "vec", "part", "m", "row"]
LONG = " ".join(f"word{i % 997}" for i in range(120_000)) + "\nx\ny\nz"
TEXTS = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, "a b c d e g"), (None, None), (3, ""), (4, LONG), (5, " \n\t "), (6, "a\nb\nc"), (7, "a\nb\nc"), (8, "😀 é ñ " * 30), ((1 << 53) + 1, "big id one two three")]


def clashing(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def messy(spark):
    return clashing(spark.createDataFrame([(i, t, None if i == 3 else "en", "s", None if t is None else len(t)) for i, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long"))


def ids(df, name="doc_id"):
    return sorted((r[0] for r in df.select(name).collect()), key=str)


def test_every_row_comes_back(spark, messy):
    want = ids(messy)
    labels = clashing(spark.createDataFrame([(1, 1, 0), (4, 0, None), (None, 1, 1), (6, None, 0), (6, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int"))
    assert ids(ngram_join.jaccard_components(messy), "id") == want
    assert ids(lang_id.identify(messy, declared=F.col("lang"), host=F.col("source"), carry={"doc_id": F.col("doc_id")})) == want
    assert ids(mixing.mix_documents(messy, labels)) == want
    assert ids(pii.find_pii(messy), "id") == want
    lines = line_dedup.dedup_lines(messy)
    assert ids(lines) == want and {r.doc_id: r.text for r in lines.filter("doc_id in (4, 6, 7)").collect()} == {4: LONG, 6: "a\nb\nc", 7: ""}


def test_leaks_and_licenses_of_messy_rows(spark, messy):
    bench = clashing(spark.createDataFrame([(1, " ".join(f"word{i % 997}" for i in range(500, 530))), (2, None), (None, "x"), (3, "")], "item_id long, text string"))
    found = decontam.find_leaks(messy, bench, carry={"doc_id": F.col("doc_id"), "item": F.col("id")}).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(4, 1)} and {r["item"] for r in found} == {"clash"}
    notice = messy.unionByName(messy.filter("doc_id = 4").withColumn("text", F.concat("text", F.lit(" Released under the MIT License "), "text")))
    assert [(r.doc_id, r.licenses) for r in license_scan.scan_licenses(notice).collect()] == [(4, "MIT")]


def test_pages_vectors_and_dialogues(spark):
    pages = [(1, "http://h/", "<article><p>x</p></article>"), (1, "http://h/", "<article><p>x</p></article>"), (None, None, None), (2, "", ""), (3, "no url", "<p>" + "long " * 50_000), (4, None, "plain text")]
    got = html_template.extract_text(clashing(spark.createDataFrame(pages, "page_id long, url string, html string")))
    assert sorted((str(r.page_id), r.n_chars) for r in got.collect()) == [("1", 1), ("1", 1), ("2", 0), ("3", 249_999), ("4", 10), ("None", 0)]
    vec = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [None, 1.0]), (3, None), (4, [float("inf"), 1.0]), (5, [2.0, 4.0]), (6, [-1.0, 0.5]), (None, [1.0, 1.0]), (7, [])]
    v = clashing(spark.createDataFrame(vec, "vec_id long, embedding array<double>"))
    assert [(r.query_id, r.vec_id) for r in mih.nearest(v, v.filter("vec_id = 0").select("vec_id")).sort("rank").collect()] == [(0, 1), (0, 5), (0, 6)]
    talk = [(1, 1, "a", "x"), (1, 1, "a", "x"), (1, 1, "b", None), (None, None, None, None), (2, 5, "", "y" * 300_000), (3, 1, "system", "only")]
    got = chat_rotation.rotate_perspectives(clashing(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string"))).collect()
    assert sorted((str(r.conv_id), r.perspective, r.n_turns) for r in got) == [("1", "a", 3), ("1", "b", 3), ("2", "unknown", 1), ("None", "unknown", 1)]


def test_empty_tables(spark, messy, tmp_path):
    none = messy.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (ngram_join.jaccard_components(none), lang_id.identify(none), mixing.mix_documents(none, labels), pii.find_pii(none), line_dedup.dedup_lines(none), decontam.find_leaks(none, bench), decontam.find_leaks(messy, bench),
               license_scan.scan_licenses(none), html_template.extract_text(pages), chat_rotation.rotate_perspectives(talk)):
        assert df.count() == 0
    for name, df in (("documents", none.select("doc_id", "text", "lang", "source", "n_chars")), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
