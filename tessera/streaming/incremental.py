"""Incremental ingest: new and changed pages of a file stream are merged by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import store
from tessera.sources.parts import Parts
from tessera.sources.shared import saved


def merge_batch(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """stored (key, text, content_hash, version) with the batch (key, text): equal pages stay, new and changed ones get the batch's version number."""
    latest = store.dedupe_last(batch, ["key"], "seq").drop("first_seq", "seq").withColumn("content_hash", tx.content_hash(F.col("text")))
    actions = store.load_decision(latest, stored, "key").where("action <> 'skip_nodes'")
    return store.upsert(stored, latest.join(actions.select("key"), "key"), ["key"])


ROWS = "key string, text string, content_hash string, version long"


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, text: str, per_trigger: int | None = None, order: str | None = None, parts: int = 64) -> int:
    """Runs all files of source that the checkpoint hasn't seen through merge_batch into the table under target (see ``table``), of which a batch rewrites the parts that its keys are in.

    order: the source's column by which a batch's rows of one key follow each other; without one they follow the files' times, then names, then places in the file.
    Returns the number of the last batch.  A batch that runs again finds its rows as they are and writes nothing.
    """
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader
    seq = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", "_metadata.row_index") if order is None else F.col(order)
    stream = reader.parquet(source).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), seq.alias("seq"))

    def each(batch: DataFrame, number: int) -> None:
        own = Parts(batch.sparkSession, target, parts)
        latest = saved(store.dedupe_last(batch, ["key"], "seq").drop("first_seq", "seq").withColumn("content_hash", tx.content_hash(F.col("text"))), "batch")
        at = own.part(F.col("key"))
        empty = batch.sparkSession.createDataFrame([], ROWS).schema
        keyed = latest.select("key", "content_hash", at.alias("part"))
        met = sorted(r["part"] for r in keyed.select("part").distinct().collect())  # one row for each part
        actions = store.load_decision(keyed, own.read("rows", empty, met), "key").where("action <> 'skip_nodes'")
        changed = saved(latest.join(actions.select("key"), "key", "left_semi").withColumn("version", F.lit(number).cast("long")), "changed")
        touched = sorted(r["part"] for r in changed.select(at.alias("part")).distinct().collect())
        if touched:
            merged = store.upsert(own.read("rows", empty, touched), changed, ["key"])
            own.commit({"rows": (merged.select("key", "text", "content_hash", "version"), F.col("key"), F.col("key"))}, touched)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.lastProgress["batchId"] if query.lastProgress else -1


def table(spark: SparkSession, target: str) -> DataFrame:
    """key, text, content_hash, version: what has been ingested so far; version is the batch that brought a row."""
    return Parts(spark, target).read("rows", spark.createDataFrame([], ROWS).schema)
