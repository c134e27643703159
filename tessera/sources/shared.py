"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The URI in spark.checkpoint.dir; where that is unset, a new temporary folder if driver and executors are one process (as in local tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
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


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of the order: as limit(n), but no task takes more than one range of them, however large n is."""
    ranged = saved(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "ranges")
    before = 0
    for r in sorted(ranged.groupBy("range_no").count().collect()):  # one row for each range
        if before + r["count"] >= n:
            whole = ranged.where(F.col("range_no") < r["range_no"])
            return whole.unionByName(ranged.where(F.col("range_no") == r["range_no"]).orderBy(*order).limit(max(n - before, 0))).drop("range_no")
        before += r["count"]
    return ranged.drop("range_no")


#: Bytes of rows that a task holds while it goes through blocks of other data.
GATHERED_BYTES = 32 << 20


def gathered(batches: Iterator[pa.RecordBatch], blocks: int, most: int = GATHERED_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """The batches that meet each of some blocks together, so that a block is read once for all of them: about ``most`` bytes, or one by one where a single block stays in memory anyway."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if blocks <= 1 or size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
