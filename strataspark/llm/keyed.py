"""Running sums within keys and lookups by key where one key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARE = 1000  # a key with more than this part of all rows is met by broadcast; there are at most so many of them


def running_by_key(df: DataFrame, key: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """A written table of ``df`` with running sums (new name -> summed column) over each key's rows in ``order``; ``key`` holds no null.

    Rows are dealt by ranges of key and order, so that a long key is spread over tasks. A window runs within a key and range; what a key brings along
    from earlier ranges is added. Only the first and the last key of a range can lie in others too, so these sums are two rows a range.
    """
    parts = cut(df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(F.col(key), *order, F.col("__row")).withColumn("__part", F.spark_partition_id()))
    edges = parts.groupBy("__part").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).select(F.explode(F.array("lo", "hi")).alias(key)).distinct()
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    here = parts.join(F.broadcast(edges), key, "left_semi").groupBy("__part", key).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    carried = here.select("__part", key, *[F.sum(n).over(earlier).alias(f"__c_{n}") for n in sums])
    w = Window.partitionBy("__part", key).orderBy(*order, "__row").rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("*", *[F.sum(c).over(w).alias(f"__s_{n}") for n, c in sums.items()])
    out = local.join(F.broadcast(carried), ["__part", key], "left")
    return cut(out.select(*df.columns, *[(F.col(f"__s_{n}") + F.coalesce(F.col(f"__c_{n}"), F.lit(0))).alias(n) for n in sums]))


def by_key(rows: DataFrame, side: DataFrame, keys: list[str], size: str) -> DataFrame:
    """The inner join of ``rows`` with ``side``, which has one row for each of ``keys`` and in ``size`` how many of the rows it meets. Keys with more than a
    share of 1 / SHARE of the rows, at most SHARE of them, are met by broadcast; the others meet by shuffle. Both sides are read twice."""
    total = side.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * SHARE > total
    often = F.broadcast(side.filter(hot).drop(size))
    rest = rows.join(F.broadcast(side.filter(hot).select(*keys)), keys, "left_anti").join(side.filter(~hot).drop(size), keys)
    return rows.join(often, keys).unionByName(rest)
