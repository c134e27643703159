"""What all operators share: the folder that the driver and all executors reach, and the end of a Python task."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The URI in spark.checkpoint.dir; where that is unset, a new temporary folder if driver and executors are one process (as in local tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        at = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at if ":/" in at else f"file://{at}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives memory that Arrow and the C library hold free back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task of mapInArrow after which its worker, which later stages use again, holds no freed memory."""

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            release()

    return run
