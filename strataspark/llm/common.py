"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import cut, discard, remove, shared_folder
from ..operators.spatial import components, local_forest

__all__ = ["components", "cut", "discard", "few_rows", "list_array", "local_forest", "local_rows", "remove", "shared_folder", "table", "with_columns"]
FEW = 1_000_000


def few_rows(df: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if it holds at most FEW rows, counted here."""
    return F.broadcast(df) if df.count() <= FEW else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small literal table built from SQL expressions only (no Python-to-JVM row conversion)."""
    items = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*items)))


def list_array(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as an Arrow column of lists."""
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k) if k else np.zeros(n + 1), pa.int32()), pa.array(values.ravel()))


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """An Arrow batch with more columns; those carried along stay as they are (pandas would make numbers of nulls)."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])
