"""Calls of external models that can be taken up again: each distinct input once, results and failures kept as they come.

An input's key is a hash of the model's version and the input.  A task calls the model for batches of its inputs and writes each batch's results, as soon as they are there, to a file whose
name tells its keys; a task that runs again finds the file and doesn't call.  A later run calls what has no result yet and has failed fewer than ``attempts`` times.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "key string, result string, error string"
ROWS = pa.schema([("key", pa.string()), ("result", pa.string()), ("error", pa.string())])


def keyed(inputs: DataFrame, version: str, column: str = "payload") -> DataFrame:
    return inputs.withColumn("key", F.sha2(F.concat_ws("\n", F.lit(version), F.coalesce(column, F.lit(""))), 256))


def kept(df: DataFrame, folder: str) -> DataFrame:
    """All results and failures so far."""
    spark = df.sparkSession
    try:
        return spark.read.schema(SCHEMA).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def called(inputs: DataFrame, model: Callable[[list[str]], list[str | Exception]], folder: str, version: str, column: str = "payload", batch: int = 16, tasks: int = 8, attempts: int = 3, pause: float = 0.0) -> DataFrame:
    """inputs with result and error (null where there is a result) of the model for its column.

    model: takes a list of inputs and gives a result or an exception for each; one that it raises counts for all of them.  At most ``tasks`` calls of ``batch`` inputs run at once,
    each task waits ``pause`` seconds between two.  Inputs that failed in a run are tried again in the same call, until they have a result or ``attempts`` failures.
    """
    own = keyed(inputs, version, column)
    distinct = own.select("key", F.coalesce(column, F.lit("")).alias("payload")).dropDuplicates(["key"])
    for _ in range(attempts):
        tried = kept(inputs, folder).groupBy("key").agg(F.count_if(F.col("error").isNull()).alias("good"), F.count("*").alias("n"))
        todo = distinct.join(tried, "key", "left").where(F.col("n").isNull() | ((F.col("good") == 0) & (F.col("n") < attempts))).select("key", "payload", F.coalesce("n", F.lit(0)).alias("n"))

        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyarrow import fs, parquet

            store, path = fs.FileSystem.from_uri(folder)
            store.create_dir(path, recursive=True)
            for frame in frames:
                for lo in range(0, len(frame), batch):
                    part = frame.iloc[lo : lo + batch]
                    # of the keys and how often each has been tried: the same batch again has the same name
                    name = hashlib.sha256("\n".join(f"{k} {n}" for k, n in zip(part["key"], part["n"], strict=True)).encode()).hexdigest()
                    if store.get_file_info(f"{path}/{name}.parquet").type == fs.FileType.NotFound:
                        try:
                            results = model(part["payload"].tolist())
                        except Exception as e:  # noqa: BLE001 - a model may raise anything
                            results = [e] * len(part)
                        bad = [isinstance(r, Exception) for r in results]
                        table = pa.Table.from_pydict({"key": part["key"].tolist(), "result": [None if b else r for r, b in zip(results, bad, strict=True)], "error": [f"{type(r).__name__}: {r}" if b else None for r, b in zip(results, bad, strict=True)]}, schema=ROWS)
                        parquet.write_table(table, f"{path}/.{name}", filesystem=store)
                        store.move(f"{path}/.{name}", f"{path}/{name}.parquet")
                        time.sleep(pause)
                    yield pd.DataFrame({"n": [len(part)]})

        dealt = todo.repartition(tasks, "key").sortWithinPartitions("key")
        if not dealt.mapInPandas(task, "n long").agg(F.sum("n").alias("n")).first()["n"]:
            break
    results = kept(inputs, folder).groupBy("key").agg(F.max("result").alias("result"), F.max(F.when(F.col("result").isNull(), F.col("error"))).alias("last"))
    joined = own.join(results, "key", "left")
    return joined.select(*inputs.columns, "result", F.when(F.col("result").isNull(), F.col("last")).alias("error"))
