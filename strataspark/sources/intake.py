"""Strict reading and writing: checked columns and values, pinned digests, split tables, reports and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def strict_csv(spark: SparkSession, path: str, required: dict[str, str]) -> DataFrame:
    """A CSV table with a header that must hold the required columns (name -> type), a byte order mark allowed; an empty one is an error."""
    raw = spark.read.option("header", True).csv(path)
    df = raw.toDF(*[c.removeprefix("﻿").strip() for c in raw.columns])
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    out = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in required.items()], *[c for c in df.columns if c not in required])
    if not out.limit(1).count():
        raise ValueError("the table is empty")
    return out


def json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files that each hold one object; files that do not are an error when they are read."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(path)


def source_catalogue(sources: DataFrame) -> DataFrame:
    """``sources`` (id, position, priority) with the priority defaulting to the position; ids must be there and unique."""
    bad = sources.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or id is null").limit(1).collect()
    if bad:
        raise ValueError(f"the source id {bad[0].id!r} is missing or not unique")
    return sources.withColumn("priority", F.coalesce("priority", "position"))


def intake(df: DataFrame, axes: list[str], classes: str, most: int, low: dict[str, float], high: dict[str, float], step: float) -> DataFrame:
    """(rows, not_finite, outside, classes, accepted) of a table in one pass: values that are null or not finite, values beyond the declared bounds by more than half a step, the histogram of
    ``classes``; accepted if there are rows, at most ``most``, and nothing is wrong."""
    c = F.col
    wrong, out = F.lit(False), F.lit(False)
    for a in axes:
        wrong = wrong | c(a).isNull() | F.isnan(a) | (F.abs(a) == float("inf"))
        out = out | ~c(a).between(low[a] - step / 2, high[a] + step / 2)
    per = df.groupBy(c(classes).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(wrong, 1)).alias("w"), F.count(F.when(~wrong & out, 1)).alias("o"))
    hist = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda x: F.concat_ws("=", x["k"], x["n"].cast("string"))), ",")  # one entry for each class
    g = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("w"), F.lit(0)).alias("not_finite"), F.coalesce(F.sum("o"), F.lit(0)).alias("outside"), hist.alias("classes"))
    return g.withColumn("accepted", (c("rows") > 0) & (c("rows") <= most) & (c("not_finite") == 0) & (c("outside") == 0))


def profile(df: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, distinct_values) of every column, exact, in one aggregation: values are counted once for each column."""
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in df.columns])
    values = df.select(F.explode(items).alias("x")).groupBy("x.column_name", "x.v").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.count("v").alias("distinct_values"))


def unlabelled(df: DataFrame, keys: list[str], axes: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The coordinates without labels and the labels without coordinates: what detects never sees what judges."""
    return df.select(*keys, *axes), df.select(*keys, label)


def reviews(df: DataFrame, key: str, column: str, allowed: list[str]) -> DataFrame:
    """(key, value, state): ``ok``, ``duplicate`` where an id comes more than once, ``invalid`` where the trimmed, lower-cased value is not allowed."""
    value = F.lower(F.trim(F.col(column)))
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("value"))
    bad = ~F.coalesce(F.col("value").isin(allowed), F.lit(False))
    return n.select(key, "value", F.when(F.col("n") > 1, "duplicate").when(bad, "invalid").otherwise("ok").alias("state"))


def window(df: DataFrame, z: tuple[float, float], along: tuple[Column, float, float], every: int, key: Column) -> DataFrame:
    """Rows in a range of heights and of places along, every ``every``-th by key: filters only, so they reach the scan."""
    return df.filter(F.col("z").between(*z) & along[0].between(along[1], along[2]) & (F.pmod(key, F.lit(every)) == 0))


def verify_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(name, state) of a folder's files against (name, bytes, sha256): ``same``, ``changed``, ``missing`` or ``unlisted``. Contents are hashed where they are read."""
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("b"), F.sha2("content", 256).alias("h"))
    j = manifest.join(files, "name", "full")
    same = (F.col("bytes") == F.col("b")) & (F.col("sha256") == F.col("h"))
    return j.select("name", F.when(F.col("h").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(same, "same").otherwise("changed").alias("state"))


def write_split(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder for each value of ``by``, all in one pass; rows are dealt by those columns and a salt, so that a large part is written by several tasks.
    What exists is never replaced."""
    df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(8))).write.mode("errorifexists").partitionBy(*by).parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """A report as JSON or as CSV with a header, its columns in their order; commits are atomic and what exists is never replaced."""
    (df.write.mode("errorifexists").option("header", True).csv(path) if kind == "csv" else df.write.mode("errorifexists").json(path))


def append_lineage(spark: SparkSession, path: str, command: str, status: str, outputs: dict[str, str]) -> None:
    """Add a run to the lineage table: command, status and the digest of every output."""
    rows = F.array(*[F.struct(F.lit(k).alias("output"), F.lit(v).alias("sha256")) for k, v in outputs.items()])
    spark.range(1).select(F.lit(command).alias("command"), F.lit(status).alias("status"), F.inline(rows), F.current_timestamp().alias("at")).write.mode("append").parquet(path)
