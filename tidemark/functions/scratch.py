"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared `spark.checkpoint.dir`; a local folder only where it is unset in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: intermediate tables need a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write a table to shared storage and read it back: what follows does not repeat it, also if executors are lost."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the block, each statement's shuffle files go when it has ended, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
