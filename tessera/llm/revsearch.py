"""Ranked lexical search, reversed: items are indexed and documents stream through the index.

The terms of a block of items make an inverted index (term, items with how often each has it), which is broadcast.  One pass over the documents sums what the scores
need of them: how many have a term, how many terms they have, and in how many each of the index's terms is.  A second pass takes each document's counts of these terms
through the index and keeps, for each item, a heap of the best documents that the task has met; heaps are merged in two steps, first those of some tasks, then all.

A block holds items of at most ``BLOCK_BYTES`` of text (or one item), so what is broadcast has a bound; more items are more blocks, each with its own two passes.
A heap holds ``TOP`` documents.  Texts are read whole, long ones slice by slice.  Nothing depends on how rows lie in partitions; counts and scores are integers.

Nulls and empty texts have no terms: such a document has no part in any count, such an item finds nothing.  Each row is a document or an item of its own, also
where ids are null or repeated; of equal scores a null id comes first.  Columns other than the ids and texts are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import saved, tidy

TOP, BLOCK_BYTES, SLICE = 10, 4 << 20, 1 << 20
#: Heaps of tasks that are merged at first: those of tasks with equal remainders.
MERGES = 64
#: Bytes that terms are made of stay, those of A-Z lower-cased; all others are blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice; a slice ends where a term does."""
    blank = text.translate(TERM_BYTES)
    at = 0
    while at < len(blank):
        end = blank.find(b" ", at + SLICE) if at + SLICE < len(blank) else -1
        yield blank[at : end if end >= 0 else len(blank)].split()
        at = end if end >= 0 else len(blank)


@dataclass
class ItemIndex:
    """The inverted index of a block: places has the number of each term, whose items are ``items[begins[p]:begins[p + 1]]``, ``times`` how often each has it."""

    ids: list
    places: dict[bytes, int]
    begins: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> ItemIndex:
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(rows):
            own = Counter(t for terms in term_slices((text or "").encode()) for t in terms)
            for term, times in own.items():
                postings.setdefault(term, []).append((i, times))
        flat = np.array([x for p in postings.values() for x in p], dtype=np.int64).reshape(-1, 2)
        begins = np.concatenate([[0], np.cumsum([len(p) for p in postings.values()], dtype=np.int64)]).astype(np.int64)
        return cls([r[0] for r in rows], {t: k for k, t in enumerate(postings)}, begins, flat[:, 0], flat[:, 1])

    def counts(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """How many terms a text has, and the index's terms among them with how often each occurs."""
        n, found = 0, Counter()
        for terms in term_slices(text):
            n += len(terms)
            found.update(map(self.places.get, terms))
        found.pop(None, None)
        return n, np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))

    def scores(self, place: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Each item's sum of gain over its terms."""
        lengths = self.begins[place + 1] - self.begins[place]
        at = np.repeat(self.begins[place] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, self.items[at], np.repeat(gain, lengths) * self.times[at])
        return out


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """block, item_id, text: the items, written in blocks, and the blocks' numbers.  Each task cuts its own items, so none sees them all."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for length in (x.as_py() or 0 for x in pc.binary_length(batch.column(1))):
                if size and size + length > block_bytes:
                    block, size = block + 1, 0
                size += length
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *batch.columns], names=["block", *batch.schema.names])

    own = items.select("item_id", F.col("text").cast("string").alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    schema = T.StructType([T.StructField("block", T.LongType()), *own.schema.fields])
    cut = saved(own.repartition(max(1, -(-total // block_bytes))).mapInArrow(tidy(task), schema), "items")
    return cut, sorted(r["block"] for r in cut.select("block").distinct().collect())  # one row for each block


def gathered(docs: DataFrame, shared) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and in how many documents each term of the index is."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        n_docs, n_terms, held = 0, 0, np.zeros(len(index.places), np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                if text.is_valid:
                    n, place, _ = index.counts(text.as_py())
                    n_docs, n_terms = n_docs + (n > 0), n_terms + n
                    held[place] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"place": pa.array([-1, -2, *some.tolist()], pa.int64()), "n": pa.array([n_docs, n_terms, *held[some].tolist()], pa.int64())})

    sums = {r["place"]: r["n"] for r in docs.select("text").mapInArrow(tidy(task), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}  # one row for each term of the block
    holds = np.zeros(len(shared.value.places), np.int64)
    for place, n in sums.items():
        if place >= 0:
            holds[place] = n
    return sums.get(-1, 0), sums.get(-2, 0), holds


def best(found: DataFrame, by: list[Column | str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_block(docs: DataFrame, rows: list[tuple], id_type: T.DataType, top: int) -> DataFrame | None:
    """item_id, rank, doc_id, score of one block of items (item_id, text); None if no document has a term."""
    index = ItemIndex.of(rows)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    n_docs, n_terms, holds = gathered(docs, shared)
    if not n_docs:
        return None
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * h + 1))) for h in holds.tolist()], dtype=np.int64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        heaps: list[list] = [[] for _ in index.ids]
        least = np.ones(len(index.ids), np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                if not text.is_valid:
                    continue
                n, place, times = index.counts(text.as_py())
                if not len(place):
                    continue
                m = 100 - 75 + (75 * n * n_docs) // n_terms
                score = index.scores(place, weights[place] * ((1_000_000_000 * times) // (1000 * times + 8 * m)))
                for i in np.flatnonzero(score >= least).tolist():
                    entry = (int(score[i]), doc_id is None, -(doc_id or 0))
                    if len(heaps[i]) < top:
                        heapq.heappush(heaps[i], entry)
                    else:
                        heapq.heappushpop(heaps[i], entry)
                    if len(heaps[i]) == top:
                        least[i] = heaps[i][0][0]
        out = [(i, index.ids[i], None if null else -own, score) for i, heap in enumerate(heaps) for score, null, own in heap]
        item, ids, own, score = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int64()), "item_id": pa.array(ids, arrow_type), "doc_id": pa.array(own, pa.int64()), "score": pa.array(score, pa.int64())})

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_type = to_arrow_type(id_type)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = docs.mapInArrow(tidy(task), schema).withColumn("some", F.pmod(F.spark_partition_id(), F.lit(MERGES)))
    return best(best(found, ["item", "some"], top), ["item"], top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents (doc_id, text) with the highest scores above 0 for each item (item_id, text)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut, blocks = item_blocks(items, block_bytes)
    id_type = items.schema["item_id"].dataType
    out = None
    for block in blocks:
        rows = [(r["item_id"], r["text"]) for r in cut.where(F.col("block") == block).select("item_id", "text").collect()]  # of bounded bytes
        ranked = ranked_block(own, rows, id_type, top)
        out = ranked if out is None else out if ranked is None else out.unionByName(ranked)
    return out if out is not None else docs.sparkSession.createDataFrame([], T.StructType([T.StructField("item_id", id_type), *T._parse_datatype_string("rank int, doc_id long, score long").fields]))


#: The same by joining all terms, for small tables.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
held AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counts, s GROUP BY term, n_docs),
items AS (SELECT i, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL)),
sized AS (SELECT r, doc_id, 100 - 75 + ((75 * len(w) * n_docs) // n_terms) AS m FROM d, s),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM items JOIN held USING (term) JOIN counts USING (term) JOIN sized USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
