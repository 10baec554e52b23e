"""Registries: upsert, precedence, set hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Rows of the patch replace or extend those of the base: one aggregation over the union, no join."""
    both = base.withColumn("__p", F.lit(0)).unionByName(patch.withColumn("__p", F.lit(1)))
    rest = [c for c in base.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), "__p").alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def set_hash(df: DataFrame, keys: list[str], part_rows: int = 50_000) -> DataFrame:
    """Order-free digest: rows are hashed, sorted within parts named by the first digits of the hash, and the parts' digests hashed again in order. There are so many digits, two or
    more, that a part holds about ``part_rows`` rows (counted), and up to 4,096 digests are put together at a time, so no task gathers more."""
    rows = df.select(F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256).alias("h"))
    n, digits = df.count(), 2
    while n > part_rows << (4 * digits):
        digits += 1
    join = lambda c: F.sha2(F.array_join(c, ""), 256)
    parts = rows.groupBy(F.substring("h", 1, digits).alias("b")).agg(join(F.sort_array(F.collect_list("h"))).alias("d"), F.count(F.lit(1)).alias("n"))
    inner = lambda: F.transform(F.array_sort(F.collect_list(F.struct("b", "d"))), lambda x: x["d"])
    while digits > 3:
        digits = max(digits - 3, 2)
        parts = parts.groupBy(F.substring("b", 1, digits).alias("p")).agg(join(inner()).alias("d"), F.sum("n").alias("n")).withColumnRenamed("p", "b")
    return parts.agg(join(inner()).alias("digest"), F.sum("n").alias("rows"))


def precedence(df: DataFrame, key: str, order: list) -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__rn = 1").drop("__rn")
