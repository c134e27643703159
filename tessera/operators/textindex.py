"""A stored full-text index: the postings of texts, read by later searches instead of the texts.

docs (in parts by a hash of the node): node_id, content_hash, length, segment, and the columns that searches filter by.  postings: term, node_id, tf, in buckets by a hash of the term and sorted
by term, one segment for each update.  An update tokenises the texts that are new or changed and writes their postings as its segment; a posting counts if its
node's row names its segment, so what an older segment says of a changed or removed text is passed over.  ``compact`` writes all that counts as one segment.
A search reads the buckets of its terms and of docs only lengths, segments and filter columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.operators import search
from tessera.sources.parts import SPREAD, Parts
from tessera.sources.shared import saved

BUCKETS = 64
#: The hash of the empty text, which has no part in the statistics.
EMPTY = hashlib.sha256(b"").hexdigest()


class TextIndex:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.docs, self.buckets = Parts(spark, f"{root}/docs", buckets), buckets
        self.spark, self.root = spark, self.docs.root.removesuffix("/docs")

    def bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _segment(self, number: int) -> str:
        return f"{self.root}/postings/segment={number}"

    def _write(self, postings: DataFrame, number: int) -> None:
        dealt = postings.withColumn("bucket", self.bucket(F.col("term"))).repartition("bucket", F.pmod(F.xxhash64(F.col("node_id").cast("string")), F.lit(SPREAD)))
        dealt.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(self._segment(number))

    def update(self, nodes: DataFrame, columns: tuple[str, ...] = (), whole: bool = False) -> int:
        """Takes nodes (node_id, indexed_text, columns) in; with ``whole``, nodes that aren't among them go.  How many texts it tokenised."""
        own = nodes.select("node_id", F.coalesce("indexed_text", F.lit("")).alias("text"), *columns)
        keyed = own.withColumn("content_hash", tx.content_hash(F.col("text")))
        empty = T.StructType([nodes.schema["node_id"], *T._parse_datatype_string("content_hash string, length int, segment int").fields, *[nodes.schema[c] for c in columns]])
        stored = self.docs.read("docs", empty)
        now = keyed.select("node_id", "content_hash", *columns)
        old = stored.select("node_id", F.col("content_hash").alias("old_hash"), F.col("length").alias("old_length"), F.col("segment").alias("old_segment"), *[F.col(c).alias(f"old_{c}") for c in columns])
        both = now.withColumn("is_new", F.lit(True)).join(old, "node_id", "full_outer" if whole else "left")
        same = F.col("content_hash").eqNullSafe(F.col("old_hash"))
        moved = ~same
        for c in columns:
            moved = moved | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
        told = saved(both.where(moved).withColumn("retold", F.col("is_new").isNotNull() & ~same).withColumn("part", self.docs.part(F.col("node_id"))), "index-changes")
        touched = sorted(r["part"] for r in told.select("part").distinct().collect())  # one row for each part
        if not touched:
            return 0
        number = self.docs.version + 1
        texts = keyed.join(told.where("retold").select("node_id"), "node_id", "left_semi").select("node_id", search.tokens(F.col("text")).alias("tokens"))
        # a node's row holds all its words: their counts are made there, and shuffled once, to their buckets
        self._write(texts.select("node_id", F.explode(search.term_counts(F.col("tokens"))).alias("x")).select("x.term", "node_id", "x.tf"), number)
        # what isn't tokenised again keeps its length and segment
        lengths = texts.select("node_id", F.size("tokens").alias("new_length"))
        rows = told.where("is_new").join(lengths, "node_id", "left").select("node_id", "content_hash", F.coalesce("new_length", "old_length").alias("length"), F.when(F.col("retold"), number).otherwise(F.col("old_segment")).cast("int").alias("segment"), *columns)
        kept = self.docs.read("docs", empty, touched).join(told.select("node_id"), "node_id", "left_anti")
        self.docs.commit({"docs": (kept.select(*rows.columns).unionByName(rows), F.col("node_id"), F.col("node_id"))}, touched)
        return told.where("retold").count()

    def postings(self, terms: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """term, node_id, tf of the given terms (all, without one), as far as they count."""
        segments = [r["segment"] for r in self.docs.read("docs").select("segment").distinct().collect()]  # one row for each update
        schema = T.StructType([T.StructField("term", T.StringType()), self.docs.read("docs").schema["node_id"], T.StructField("tf", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        every = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("segment", T.IntegerType())]))
        if segments:
            every = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("segment", T.IntegerType())])).option("basePath", f"{self.root}/postings").parquet(*map(self._segment, segments))
        return (every if buckets is None else every.where(F.col("bucket").isin(buckets)).join(terms, "term", "left_semi")).drop("bucket")

    def compact(self) -> None:
        """All postings that count as one segment."""
        docs = self.docs.read("docs")
        number = self.docs.version + 1
        self._write(self.postings(None).join(docs.select("node_id", "segment"), ["node_id", "segment"], "left_semi").drop("segment"), number)
        self.docs.commit({"docs": (docs.withColumn("segment", F.lit(number).cast("int")), F.col("node_id"), F.col("node_id"))}, list(range(self.docs.state["n"])))

    def bm25(self, queries: DataFrame, k: int = 50, wanted: Column | None = None) -> DataFrame:
        """As ``search.bm25`` of the stored texts; wanted: a condition on the columns of docs."""
        asked = saved(search.asked_terms(queries), "asked")
        buckets = sorted(r["b"] for r in asked.select(self.bucket(F.col("term")).alias("b")).distinct().collect())  # one row for each bucket at most
        docs = self.docs.read("docs").where(F.col("content_hash") != EMPTY)
        stats = docs.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
        own = docs.select("node_id", "segment", "length", (F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))).alias("wanted"))
        met = self.postings(asked.select("term").distinct(), buckets).join(own, ["node_id", "segment"])
        met = met.groupBy("node_id", "wanted", "length").agg(F.collect_list(F.struct("term", "tf")).alias("held"))
        return search.ranked(saved(met, "postings"), asked, stats["n"], stats["mean"], k)
