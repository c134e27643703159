"""Approximate nearest neighbours by multiprobe p-stable hashing, for the largest inner product.

With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query (q, 0):
all vectors then have norm M, and the nearest by distance is the largest by inner
product.  A table hashes by K Gaussian (2-stable) projections cut into cells of
width w.  For a query, a neighbour of the correlation that neighbours have here (fitted on
a bounded sample of queries) falls into a cell with a probability that the projections
of the query give; cells are visited in the order of that probability until their sum
reaches what each of the tables owes to the wanted recall.  Candidates of all tables are
scored exactly and merged; a query that then has fewer neighbours than it can have meets all rows.

K is the number of projections from which on more of them cost more (visited cells and scored rows, estimated
on bounded samples of queries and rows): it grows with the rows where cells part them, without a limit.
Equal vectors are one entry with its copies.  Cells with many entries are dealt over
several groups, and the queries of a group over blocks that each meet the group's entries, so no task is unbounded;
nothing is capped.

Nulls: vectors that are null, empty, zero, or hold null or non-finite components, rows
with a null id, and vectors of another length than the most frequent one (with which they have no inner product) take no part.
Of rows with one id the smallest vector takes part.  Ties go to the smaller id.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import saved, shared_folder, tidy

NEAREST, TABLES, RECALL, CELL = 20, 2, 0.96, 1.3
#: Entries of a group and queries of a block at most, about.
GROUP, ASKING = 8192, 4096
#: The sampled queries that the fit compares with all rows, the sampled rows, and the rows that cost as much as one visited cell.
SAMPLED, SAMPLED_ROWS, CELL_COST = 64, 2048, 10
#: Of the probability that a table needn't find, the share that may go to cells that are left out before they are ordered.
PRUNED = 0.25


@dataclass
class Index:
    norm: float
    correlation: float
    projections: np.ndarray  # tables x K x dimensions + 1
    shifts: np.ndarray
    width: float
    owed: float
    recall: float = 0.0  # measured on the sampled queries

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        lifted = np.column_stack([x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))])
        return np.floor((lifted @ self.projections[table].T + self.shifts[table]) / self.width).astype(np.int64)

    def probes(self, q: np.ndarray, table: int) -> list[np.ndarray]:
        """The cells to visit for each query, the most promising first."""
        at = np.column_stack([q, np.zeros(len(q))]) @ self.projections[table].T
        norm = np.linalg.norm(q, axis=1)
        spread, out = self.norm * math.sqrt(max(1 - self.correlation**2, 1e-6)), []
        for i in range(len(q)):
            axes, chances = [], []
            for k in range(at.shape[1]):
                mean = self.correlation * self.norm / norm[i] * at[i, k]
                lo, hi = (math.floor((mean + s * 3.3 * spread + self.shifts[table, k]) / self.width) for s in (-1, 1))
                cells = np.arange(lo, hi + 1)
                edges = (np.arange(lo, hi + 2) * self.width - self.shifts[table, k] - mean) / (spread * math.sqrt(2))
                axes.append(cells)
                chances.append(np.diff([0.5 * math.erf(e) for e in edges]))
            # axis by axis, without the least likely combinations: together they are a small share of what may be missed
            chance, cells = np.ones(1), np.zeros((1, 0), dtype=np.int64)
            for own, c in zip(axes, chances, strict=True):
                chance = np.multiply.outer(chance, c).ravel()
                order = np.argsort(-chance, kind="stable")
                kept = np.cumsum(chance[order])
                order = order[: int(np.searchsorted(kept, kept[-1] - PRUNED * (1 - self.owed) / len(axes))) + 1]
                chance, cells = chance[order], np.column_stack([cells[order // len(own)], own[order % len(own)]])
            out.append(cells[: int(np.searchsorted(np.cumsum(chance), self.owed)) + 1])
        return out


def cell_key(cells: np.ndarray) -> np.ndarray:
    h = np.zeros(len(cells), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(cells.shape[1]):
            h = (h ^ cells[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def entries(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, vector (doubles) of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.exists(v, lambda x: x != 0))
    sizes = fine.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return fine.where(F.size("vector") == (sizes[0]["size"] if sizes else -1)).groupBy("id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def top(ids: np.ndarray, x: np.ndarray, q: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the rows x by their product with q, then by smaller id.  rough: products whose last digits hang on how they were made."""
    if len(ids) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        some = np.flatnonzero(rough >= least - 1e-9 * abs(least))
        ids, x = ids[some], x[some]
    scores = (x * q).sum(axis=1)
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def exact(queries: DataFrame, data: DataFrame, k: int = NEAREST, own: bool = False, block: int = 512) -> DataFrame:
    """query_id, rank, id, score: the k best of data (id, vector) for each of the queries (id, vector), without its own id unless asked for.

    The queries are stored in blocks; each Arrow batch of data meets them block by block, so a task holds one of each.
    """
    spark = queries.sparkSession
    folder = f"{shared_folder(spark)}/asked-{uuid.uuid4().hex}"
    queries.select("id", "vector").write.option("maxRecordsPerFile", block).parquet(folder)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        store, path = fs.FileSystem.from_uri(folder)
        files = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            for f in files:
                asked = parquet.read_table(f, filesystem=store).combine_chunks()
                if not asked.num_rows or not len(ids):
                    continue
                found, qs = [], matrix(asked.column(1).combine_chunks())
                for query, q, row in zip(asked.column(0).to_pylist(), qs, qs @ x.T, strict=True):
                    best, scores = top(ids, x, q, row, k + 1)
                    some = np.full(len(best), True) if own else best != query
                    found.append((query, best[some][:k], scores[some][:k]))
                n = [len(i) for _, i, _ in found]
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.repeat([q for q, _, _ in found], n), pa.int64()), "id": pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()), "score": pa.array(np.concatenate([c for _, _, c in found]), pa.float64())})

    best = data.select("id", "vector").mapInArrow(tidy(task), "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def fit(data: DataFrame, queries: DataFrame, tables: int = TABLES, recall: float = RECALL, cell: float = CELL, seed: int = 7) -> Index:
    stats = data.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("norm"), F.max(F.size("vector")).alias("size")).first()
    norm, correlation, size = stats["norm"] or 1.0, 0.5, stats["size"] or 1
    some = lambda rows, n: rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(n)
    sample = saved(some(queries, SAMPLED), "sampled-queries")
    asked = {r["id"]: np.array(r["vector"]) for r in sample.collect()}
    near = exact(sample, data).join(data.select("id", "vector"), "id").collect() if asked else []  # 20 for each sampled query
    if found := [r["score"] / (np.linalg.norm(asked[r["query_id"]]) * norm) for r in near if r["score"] > 0]:
        correlation = min(0.999, max(0.05, float(np.mean(found))))
    rows = np.array([r["vector"] for r in some(data, SAMPLED_ROWS).collect()], dtype=float).reshape(-1, size)
    q, order = np.array(list(asked.values()), dtype=float).reshape(-1, size), {i: n for n, i in enumerate(asked)}
    best, best_cost, k = None, math.inf, 1
    while True:
        rng = np.random.default_rng(seed)
        index = Index(norm, correlation, rng.normal(size=(tables, k, size + 1)), rng.uniform(0, cell * norm, size=(tables, k)), cell * norm, 1 - (1 - recall) ** (1 / tables))
        visits, scored, hits = 0, 0, np.zeros(len(near), bool)
        for t in range(tables if len(q) else 0):
            held, of_near = cell_key(index.cells(rows, t)), cell_key(index.cells(np.array([r["vector"] for r in near], dtype=float).reshape(-1, size), t))
            for n, cells in enumerate(map(cell_key, index.probes(q, t))):
                visits, scored = visits + len(cells), scored + int(np.isin(held, cells).sum())
                mine = np.array([order[r["query_id"]] == n for r in near], bool)
                hits[mine] |= np.isin(of_near[mine], cells)
        index.recall = float(hits.mean()) if len(hits) else 1.0
        cost = CELL_COST * visits + scored * stats["n"] / max(len(rows), 1)
        if cost >= best_cost:
            return best
        best, best_cost, k = index, cost, k + 1
        if not len(q):
            return best


def search(vectors: DataFrame, is_query: Column, k: int = NEAREST, recall: float = RECALL, tables: int = TABLES, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which is_query(id) holds."""
    spark = vectors.sparkSession
    rows = saved(entries(vectors, vec_id, vector), "entries")
    by_vector = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("copy", F.row_number().over(by_vector)).where(F.col("copy") <= k + 1)  # no result needs more copies
    data = saved(few.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("copies")), "vectors")
    queries = saved(rows.where(is_query), "queries")
    index = fit(data.select("id", "vector"), queries, tables, recall)
    sent = spark.sparkContext.broadcast(index)  # a few projections

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(x), t), pa.int32()), pa.array(cell_key(sent.value.cells(x, t)))], names=["id", "t", "cell"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1))
            for lo in range(0, len(x), 512):
                for t in range(tables):
                    found = [cell_key(p) for p in sent.value.probes(x[lo : lo + 512], t)]
                    n = [len(f) for f in found]
                    yield pa.RecordBatch.from_pydict({"query_id": np.repeat(ids[lo : lo + 512], n), "t": pa.array(np.full(sum(n), t), pa.int32()), "cell": np.concatenate(found)})

    placed = saved(data.select("id", "vector").mapInArrow(tidy(place), "id long, t int, cell long"), "placed")
    # cells with more entries than a group should hold are dealt over several
    large = saved(placed.groupBy("t", "cell").count().where(F.col("count") > GROUP // 2).select("t", "cell", F.ceil(F.col("count") / (GROUP // 2)).cast("int").alias("parts")), "large-cells")
    groups = max(1, math.ceil(placed.count() / tables / GROUP))
    parts = F.coalesce("parts", F.lit(1))
    group = F.pmod(F.xxhash64("cell", "part"), F.lit(groups)).cast("int").alias("g")
    dealt = placed.join(large, ["t", "cell"], "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    stored = dealt.join(data.select("id", "vector"), "id").select("t", group, "cell", "part", "id", "vector")
    asked = queries.select("id", "vector").mapInArrow(tidy(probe), "query_id long, t int, cell long").join(large, ["t", "cell"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    sent_to = asked.select("query_id", "t", group, "cell", "part").groupBy("query_id", "t", "g").agg(F.collect_list(F.struct("cell", "part")).alias("cells"))  # a query's own probes
    sent_to = saved(sent_to, "probes")
    # the queries of a group in blocks; its entries go to each of them
    blocks = sent_to.groupBy("t", "g").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("blocks"))
    asking = sent_to.join(blocks, ["t", "g"]).join(queries.select(F.col("id").alias("query_id"), F.col("vector").alias("q")), "query_id").select("t", "g", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("b"), "query_id", "cells", "q")
    stored = stored.join(blocks, ["t", "g"]).select("t", "g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "cell", "part", "id", "vector")

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out_q, out_id, out_score = [], [], []
        if len(left) and len(right):
            left = left.sort_values(["cell", "part"], kind="stable")
            x, ids = np.stack(left["vector"].to_numpy()), left["id"].to_numpy()
            keys = list(zip(left["cell"].tolist(), left["part"].tolist(), strict=True))
            at: dict[tuple[int, int], list[int]] = {}
            for n, key in enumerate(keys):
                at.setdefault(key, [n, n])[1] = n + 1
            for query, cells, q in zip(right["query_id"].tolist(), right["cells"], right["q"], strict=True):
                some = [np.arange(*at[key]) for c in cells if (key := (c["cell"], c["part"])) in at]
                if some:
                    some = np.concatenate(some)
                    best, score = top(ids[some], x[some], np.asarray(q), x[some] @ np.asarray(q), k + 1)
                    out_q.append(np.full(len(best), query))
                    out_id.append(best)
                    out_score.append(score)
        none = [np.zeros(0)]
        return pd.DataFrame({"query_id": np.concatenate(out_q or none).astype(np.int64), "id": np.concatenate(out_id or none).astype(np.int64), "score": np.concatenate(out_score or none)})

    found = stored.groupBy("t", "g", "b").cogroup(asking.groupBy("t", "g", "b")).applyInPandas(rerank, "query_id long, id long, score double")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = found.withColumn("n", F.row_number().over(by_query)).where(F.col("n") <= k + 1).drop("n")
    copies = data.select("id", "copies")

    def nearest(best: DataFrame) -> DataFrame:
        spread = best.join(copies, "id").select("query_id", F.explode("copies").alias("vec_id"), "score").where("vec_id <> query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return spread.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    near = saved(nearest(best), "nearest")
    # queries whose cells hold too few rows: all rows
    every = min(k, rows.count() - 1)
    short = saved(queries.join(near.groupBy(F.col("query_id").alias("id")).count(), "id", "left").where(F.coalesce("count", F.lit(0)) < every).select("id", "vector"), "short")
    if not short.limit(1).count():
        return near
    whole = near.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    again = nearest(exact(short, data, k + 1, own=True).drop("rank"))  # a query's own entry may have copies
    return whole.unionByName(again)
