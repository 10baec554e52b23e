"""Corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) with the columns of ``documents`` and returns them (the last one:
ids with rates); each result is written before the next stage reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataspark.llm import decontam, lang_id, line_dedup, mixing, ngram_join
from strataspark.llm.common import cut, few_rows, remove, shared_folder, table

ID = "__row"


def _row():
    """Names a row by 128 bits of its id and text, so that null and repeated ids are told apart."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents but those named by ``rows``, a table of numbers that is broadcast where it is small (counted), so that texts stay where they lie."""
    gone = few_rows(cut(rows.select(ID).distinct()))
    return docs.withColumn(ID, _row()).join(gone, ID, "left_anti").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the rejected go."""
    found = lang_id.identify(docs, declared=F.col("lang"), host=F.col("source"), carry={ID: _row()})
    return _without(docs, found.filter("not accepted"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; n_chars follows the text."""
    done = line_dedup.dedup_lines(docs)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at five-word shingles and similarity 0.8 the document with the smallest id stays; rows that
    repeat an id are one document, and a null id stays."""
    groups = ngram_join.jaccard_components(docs, shingle=5, num=80, den=100)
    gone = few_rows(cut(groups.filter("component_id < id").select(F.col("id").alias("__gone")).distinct()))
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    leaks = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"), carry={ID: _row()})
    return _without(docs, leaks)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, tokens, p_good, p_low, p_toxic, rate, worst_residual): the mix; documents of rate zero are out."""
    carry = {c: F.col(c) for c in ("doc_id", "source", "lang")}
    return mixing.mix_documents(docs, table(spark, sf_dir, "labels"), carry=carry).filter("rate > 0")


STAGES = [("language", language), ("repeated_lines", repeated_lines), ("near_duplicates", near_duplicates),
          ("benchmark_leaks", benchmark_leaks), ("mix", mix)]
ORACLE_SQL = None  # classifiers and alignment are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:  # the next stage has been written
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
