"""Cutting lineage in loops through tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under the one that the cluster names in ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is set if everything runs in this process (``local``, as in tests); on
    a cluster other machines could not read it, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="ckpt-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by Hadoop's file system, wherever it lies."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def discard(df: DataFrame) -> None:
    """Delete the table behind a result of ``cut`` that nothing reads any more."""
    path = getattr(df, "_cut_path", None)
    spark = _written.pop(path, None)
    if spark is not None:
        remove(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through a written table in the shared folder.

    Unlike checkpoint() this also gives the planner true sizes: estimates of nested joins multiply, and a loop over
    checkpoints carries them on until planning itself is slow. Tables are deleted by ``discard`` or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    _written[path] = spark
    return out


@atexit.register
def discard_all() -> None:
    for path, spark in list(_written.items()):
        with contextlib.suppress(Exception):  # the session may have ended before
            remove(spark, path)
