"""Ordered sequences: chainage, islands, unions, tiles, range and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chainage(track: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    step = F.coalesce(F.abs(F.col(value) - F.lag(value).over(w)), F.lit(0.0))
    return track.withColumn("step_m", step).withColumn("chainage_m", F.sum("step_m").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def islands(df: DataFrame, key: str, order: list[str], start: str, stop: str, most: float = 0.0) -> DataFrame:
    """Intervals of a key united where the gap to all before is at most ``most``."""
    w = Window.partitionBy(key).orderBy(start, stop, *order)
    before = F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(before.isNull() | (F.col(start) > before + most), 1).otherwise(0))
    return (marked.withColumn("island", F.sum("__new").over(w)).groupBy(key, "island")
            .agg(F.min(start).alias("start"), F.max(stop).alias("stop"), F.count(F.lit(1)).alias("n")))


def coverage(df: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    return (islands(df, key, [], start, stop).groupBy(key)
            .agg(F.sum(F.col("stop") - F.col("start")).alias("covered"), F.count(F.lit(1)).alias("parts"), F.max("stop").alias("last")))


def longest_run(df: DataFrame, key: str, order: list[str], same: str) -> DataFrame:
    """Per key the longest run of rows with one value of ``same`` (ties to the smaller value)."""
    w, v = Window.partitionBy(key).orderBy(*order), Window.partitionBy(key, same).orderBy(*order)
    runs = df.withColumn("__g", F.row_number().over(w) - F.row_number().over(v)).groupBy(key, same, "__g").agg(F.count(F.lit(1)).alias("run"))
    return runs.groupBy(key).agg(F.max("run").alias("run"), F.min_by(F.col(same), F.struct(-F.col("run"), F.col(same))).alias("value"))


def tiles(length: DataFrame, key: str, total: str, size: float) -> DataFrame:
    """Tiles [start, stop) that cover 0..total of each key."""
    n = F.greatest(F.lit(1), F.ceil(F.col(total) / size)).cast("int")
    return (length.select(key, total, F.explode(F.sequence(F.lit(0), n - 1)).alias("tile"))
            .select(key, "tile", (F.col("tile") * size).alias("start"), F.least(F.col(total), (F.col("tile") + 1) * size).alias("stop")))


def range_join(rows: DataFrame, spans: DataFrame, key: str, at: str, start: str, stop: str, width: float) -> DataFrame:
    """Rows with the half-open spans that hold them: spans are cut into buckets of ``width`` so that the join is an
    equi-join on (key, bucket); a row has one bucket, hence no duplicates."""
    last = F.greatest(F.floor(F.col(start) / width), F.ceil(F.col(stop) / width) - 1)
    cut = spans.withColumn("__b", F.explode(F.sequence(F.floor(F.col(start) / width), last)))
    return (rows.withColumn("__b", F.floor(F.col(at) / width)).join(cut, [key, "__b"])
            .filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("__b"))


def asof(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each left row with the value of the last right row at or before it: one shuffle, no join of rows."""
    cols = left.columns
    both = (left.withColumn("__v", F.lit(None).cast(dict(right.dtypes)[value])).withColumn("__side", F.lit(1))
            .unionByName(right.select(key, at, F.col(value).alias("__v")).withColumn("__side", F.lit(0)), allowMissingColumns=True))
    w = Window.partitionBy(key).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(f"asof_{value}", F.last("__v", True).over(w)).filter("__side = 1").select(*cols, f"asof_{value}")


def interpolate(left: DataFrame, knots: DataFrame, key: str, at: str, knot_at: str, *values: str) -> DataFrame:
    """Left rows with each of ``values`` interpolated between the knots before and after, clipped to the first and last; one row for each
    knot place. Rows and knots of a key are read once in order: no join of rows."""
    cols = left.columns
    knot = F.struct(F.col(knot_at).cast("double").alias("t"), *[F.col(v) for v in values])
    both = (left.withColumn("__t", F.col(at).cast("double")).withColumn("__side", F.lit(1))
            .unionByName(knots.select(F.col(key), F.col(knot_at).cast("double").alias("__t"), knot.alias("__k"), F.lit(0).alias("__side")), allowMissingColumns=True))
    w = Window.partitionBy(key).orderBy("__t", "__side")
    after = Window.partitionBy(key).orderBy(F.col("__t").desc(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__a", F.last("__k", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__b", F.last("__k", True).over(after))
    a, b = F.coalesce("__a", "__b"), F.coalesce("__b", "__a")
    share = F.when(b["t"] > a["t"], (F.col("__t") - a["t"]) / (b["t"] - a["t"])).otherwise(0.0)
    return both.filter("__side = 1").select(*cols, *[(a[v] + (b[v] - a[v]) * share).alias(v) for v in values])


def sliding_median(df: DataFrame, key: str, order: list[str], value: str, half: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-half, half)
    return df.withColumn("median", F.expr(f"percentile({value}, 0.5)").over(w)).withColumn("prominence", F.col(value) - F.col("median"))
