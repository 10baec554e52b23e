"""Windows over event streams: the same functions serve batch and Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def timed(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withWatermark("ts", late) if e.isStreaming else e


def tumbling(events: DataFrame, size: str) -> DataFrame:
    w = timed(events).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("w.start").cast("long").alias("start_s"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str, step: str) -> DataFrame:
    w = timed(events).groupBy(F.window("ts", size, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").cast("long").alias("start_s"), "n")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    w = timed(events).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.col("w.start").cast("long").alias("start_s"), F.col("w.end").cast("long").alias("stop_s"), "n")


def run_available(spark: SparkSession, folder: str, schema, transform, name: str) -> DataFrame:
    """Drive all files of a folder through a stream once and return what it has put out."""
    stream = transform(spark.readStream.schema(schema).parquet(folder))
    q = stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def copy_available(spark: SparkSession, folder: str, schema, out: str, state: str, files: int = 100) -> None:
    """Append the files of a folder that are new since the last call to a table, at most ``files`` in a batch; what has been read is kept in ``state``, so a stopped run is taken up
    where it ended."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
