"""Cutting lineage with a written table in a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_folder: str | None = None
_open_scopes: list[list[tuple[str, StructType]]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one on a local master only."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="songloom-stage-")
    return _local_folder


def job_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder, to be dropped once the job is over."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame) -> DataFrame:
    """Write once, read back columnar: later uses scan only the columns they need.

    Unlike cached blocks the files outlive a lost executor, and unlike ``checkpoint()`` the plan
    runs once.
    """
    spark = df.sparkSession
    path = f"{job_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for written in _open_scopes[-1:]:
        written.append((path, df.schema))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_stages(spark: SparkSession) -> Iterator[None]:
    """Give back the space of all stages written inside, once the block is over.

    Frames that read them must have been used by then. Overwriting with no rows works through any
    file system that Spark can write to.
    """
    _open_scopes.append([])
    try:
        yield
    finally:
        for path, schema in _open_scopes.pop():
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
