"""A stored index of vectors for exact cosine search: vectors lie with their nearest pivot, and a search reads only the pivots that can hold one of the best.

Vectors are brought to length 1 and stored by pivot, in blocks of at most about ``BLOCK``; the manifest keeps each pivot's radius, the largest angle to a vector of it.  By the
triangle inequality of angles no vector of a pivot has a larger cosine with a query than cos(angle between query and pivot - radius).  A search scores its queries in the pivots next to them that
hold k vectors; the k-th best there is a bound, and of the other pivots only those that can exceed it are read.  So the results are those of a full scan, whatever
the pivots are; how much is read depends on how the vectors are clustered, and ``share_read`` says it.

Vectors without a length, with null or non-finite entries, or of another length than the pivots have no cosine and aren't stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.search import best_cells, top_per
from tessera.sources.shared import saved

#: Pivots, the vectors that they are chosen among, steps that move them, and vectors of a block.
PIVOTS, SAMPLE, STEPS, BLOCK = 64, 8192, 8, 20_000
#: What rounding may change in a cosine, and in the sixth digit that scores are rounded to.
SLACK = 2e-6


def unit(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have the size and a length, and these brought to length 1."""
    of = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
    x = column.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(of), size)
    norm = np.sqrt((x * x).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    return of[good], x[good] / norm[good, None]


def usable(df: DataFrame, vector: str) -> DataFrame:
    return df.where(F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))))


def chosen(vectors: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """n pivots among sample vectors of length 1, moved to the middle of those next to them."""
    rng = np.random.default_rng(seed)
    pivots = vectors[rng.choice(len(vectors), min(n, len(vectors)), replace=False)]
    for _ in range(STEPS):
        at = np.argmax(vectors @ pivots.T, axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, at, vectors)
        size = np.linalg.norm(sums, axis=1)
        pivots = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], pivots)
    return pivots


class VectorIndex:
    """root: a URI that the driver and all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        from pyarrow import fs

        self.spark, self.root = spark, root if ":/" in root else f"file://{root}"
        store, path = fs.FileSystem.from_uri(self.root)
        there = store.get_file_info(f"{path}/pivots.json").type != fs.FileType.NotFound
        self.state = json.loads(store.open_input_file(f"{path}/pivots.json").read()) if there else None
        self.share_read = None

    def build(self, nodes: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> None:
        """Stores nodes (node_id, embedding), whose most frequent length is taken.  The pivots come from a sample by hash; that decides how fast searches are, not what they find."""
        from pyarrow import fs

        own = usable(nodes, "embedding").select("node_id", F.col("embedding").cast("array<double>").alias("embedding"))
        size = own.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).where("size > 0").orderBy(F.desc("n"), "size").first()
        folder = f"{self.root}/vectors-{uuid.uuid4().hex}"
        if size is None:
            self.state = {"folder": folder, "size": 0, "pivots": [], "radius": [], "count": [], "blocks": []}
        else:
            d = size["size"]
            share = min(1.0, 2 * SAMPLE / size["n"])
            some = own.where((F.size("embedding") == d) & (F.pmod(F.xxhash64("node_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)).limit(SAMPLE).select("embedding")
            _, sample = unit(pa.array([r["embedding"] for r in some.collect()], pa.list_(pa.float64())), d)  # at most SAMPLE
            if not len(sample):
                _, sample = unit(pa.array([r["embedding"] for r in own.where(F.size("embedding") == d).limit(SAMPLE).select("embedding").collect()], pa.list_(pa.float64())), d)
            p = chosen(sample, pivots) if len(sample) else np.zeros((0, d))
            shared = self.spark.sparkContext.broadcast(p)

            def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    of, x = unit(batch.column(1), d)
                    if len(of) and len(shared.value):
                        cosines = x @ shared.value.T
                        at = np.argmax(cosines, axis=1)
                        angle = np.arccos(np.clip(cosines[np.arange(len(at)), at], -1, 1))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), d).cast(pa.list_(pa.float64())), pa.array(at.astype(np.int32)), pa.array(angle)], names=["node_id", "vector", "pivot", "angle"])

            schema = T.StructType([nodes.schema["node_id"], *T._parse_datatype_string("vector array<double>, pivot int, angle double").fields])
            placed = saved(own.mapInArrow(task, schema), "placed")
            told = {r["pivot"]: r for r in placed.groupBy("pivot").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()}  # one row for each pivot
            counts = [told[i]["n"] if i in told else 0 for i in range(len(p))]
            blocks = [max(1, -(-n // block)) for n in counts]
            salt = F.pmod(F.xxhash64("node_id"), F.element_at(F.array(*map(F.lit, blocks or [1])), F.col("pivot") + 1)).cast("int")
            placed.withColumn("block", salt).repartition("pivot", "block").write.partitionBy("pivot", "block").parquet(folder)
            self.state = {"folder": folder, "size": d, "pivots": p.tolist(), "radius": [float(told[i]["radius"]) if i in told else 0.0 for i in range(len(p))], "count": counts, "blocks": blocks}
        store, path = fs.FileSystem.from_uri(self.root)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/.draft") as f:
            f.write(json.dumps(self.state).encode())
        store.move(f"{path}/.draft", f"{path}/pivots.json")

    def _bounds(self, queries: DataFrame, k: int) -> DataFrame:
        """query_id, vector, pivot, bound, first: what a pivot's vectors can have at most, and whether it is one of those next to the query that hold k vectors."""
        size, pivots, radius, counts = self.state["size"], np.array(self.state["pivots"]).reshape(-1, self.state["size"]), np.array(self.state["radius"]), np.array(self.state["count"])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of, q = unit(batch.column(1), size)
                if not len(of):
                    continue
                angle = np.arccos(np.clip(q @ pivots.T, -1, 1))
                bound = np.cos(np.maximum(angle - radius, 0))
                order = np.argsort(angle, axis=1)
                before = np.cumsum(counts[order], axis=1) - counts[order]
                first = np.zeros(angle.shape, bool)
                np.put_along_axis(first, order, before < k, axis=1)
                row, column = np.nonzero(np.broadcast_to(counts > 0, angle.shape))
                vectors = pa.FixedSizeListArray.from_arrays(pa.array(q.ravel()), size).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[row])), vectors.take(pa.array(row)), pa.array(column.astype(np.int32)), pa.array(bound[row, column]), pa.array(first[row, column])], names=["query_id", "vector", "pivot", "bound", "first"])

        schema = T.StructType([queries.schema["query_id"], *T._parse_datatype_string("vector array<double>, pivot int, bound double, first boolean").fields])
        return usable(queries, "vector").select("query_id", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(task, schema)

    def _scored(self, asked: DataFrame, k: int) -> DataFrame:
        """query_id, node_id, score of the k best in each block of the pivots asked for; blocks of other pivots aren't read."""
        pivots = sorted(r["pivot"] for r in asked.select("pivot").distinct().collect())  # one row for each pivot at most
        size, blocks, id_type, key_type = self.state["size"], self.state["blocks"], self.node_type, asked.schema["query_id"].dataType
        spread = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(F.array(*map(F.lit, blocks)), F.col("pivot") + 1) - 1)))
        stored = self.spark.read.parquet(self.state["folder"]).where(F.col("pivot").isin(pivots)).select("node_id", F.col("vector"), "pivot", "block")

        def meet(queries: pa.Table, vectors: pa.Table) -> pa.Table:
            out = pa.schema([("query_id", queries.schema.field("query_id").type), ("node_id", vectors.schema.field("node_id").type), ("score", pa.float64())])
            if not queries.num_rows or not vectors.num_rows:
                return out.empty_table()
            x = vectors.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            parts = []
            for lo in range(0, queries.num_rows, 1024):
                some = queries.slice(lo, 1024).combine_chunks()
                q = some.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                row, column, score = best_cells(q @ x.T, k)
                parts.append(pa.Table.from_arrays([some.column("query_id").take(pa.array(row)), vectors.column("node_id").take(pa.array(column)), pa.array(score)], schema=out))
            return pa.concat_tables(parts).combine_chunks()

        schema = T.StructType([T.StructField("query_id", key_type), T.StructField("node_id", id_type), T.StructField("score", T.DoubleType())])
        return spread.select("query_id", "vector", "pivot", "block").groupBy("pivot", "block").cogroup(stored.groupBy("pivot", "block")).applyInArrow(meet, schema)

    @property
    def node_type(self) -> T.DataType:
        return self.spark.read.parquet(self.state["folder"]).schema["node_id"].dataType

    def search(self, queries: DataFrame, k: int = 50) -> DataFrame:
        """query_id, node_id, score, rank: as ``search.vector_search`` of the stored vectors for queries (query_id, vector)."""
        if not sum(self.state["count"]):
            raise ValueError("the index holds no vectors")
        bounds = saved(self._bounds(queries, k), "bounds")
        near = saved(self._scored(bounds.where("first"), k), "near")
        least = top_per(near.withColumn("score", F.round("score", 6)), ["query_id"], [F.desc("score"), F.col("node_id")], k).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        more = saved(bounds.where("NOT first").join(least, "query_id", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)).drop("least"), "more")
        pairs = bounds.agg(F.count("*").alias("n"), F.count_if("first").alias("first")).first()
        self.share_read = (pairs["first"] + more.count()) / max(pairs["n"], 1)
        found = near.unionByName(self._scored(more, k)) if self.share_read * pairs["n"] > pairs["first"] else near
        return top_per(found.withColumn("score", F.round("score", 6)), ["query_id"], [F.desc("score"), F.col("node_id")], k)
