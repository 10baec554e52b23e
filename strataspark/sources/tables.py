"""Tables and the views that the spatial operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as points: x quantity, y price in thousands, z discount in percent."""
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("row_key"), F.col("l_linenumber").alias("row_no"), F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"),
        F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("source"), F.col("l_partkey").alias("part_key"))


def trajectory(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an ordered track per user."""
    return load(spark, folder, "events").select("user_id", "ts", "event_id", F.col("value").alias("position"), "event_type")


def intake_profile(df: DataFrame, name: str) -> DataFrame:
    """One row per column: rows, nulls and distinct values, in one aggregation."""
    cols = df.columns
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n_{c}") for c in cols])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("present")) for c in cols])
    out = sums.select("rows", F.explode(items).alias("i"))
    return out.select(F.lit(name).alias("table_name"), "i.column_name", "rows", (F.col("rows") - F.col("i.present")).alias("nulls"))
