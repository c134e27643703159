"""Question answering over the graph for a batch of questions: plan, search, fuse, rerank, cite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import search
from tessera.plans import models
from tessera.sources.shared import saved

NO_RESULTS = "No relevant documentation was found for this question."


def retrieve(nodes: DataFrame, entities: DataFrame, sub_queries: DataFrame, k: int = 50, rrf_k: int = 60, top_n: int = 40) -> DataFrame:
    """query_id, node_id, node_label, scores, rrf_score and rank of the fused candidates."""
    found = saved(search.hybrid_search(nodes, entities, sub_queries, k), "found")  # read for each leg, and for the scores
    fused = search.rrf(found, ["bm25_score", "vector_score"], ["query_id"], ["node_id", "node_label"], rrf_k, top_n)
    return saved(fused.join(found, ["query_id", "node_id", "node_label"]), "fused")  # a table of known size: where it is small, the nodes' texts aren't shuffled to meet it


def rerank(candidates: DataFrame, nodes: DataFrame, questions: DataFrame, top_k: int = 8, entity_budget: int = 2) -> DataFrame:
    """The best top_k of each question by the scorer, with their payload."""
    full = candidates.drop("rank").join(nodes, ["node_id", "node_label"]).join(questions.select("query_id", "question"), "query_id")
    scored = full.withColumn("rerank_score", F.round(search.overlap_score(F.col("question"), F.coalesce("indexed_text", "raw_text")), 6))
    scored = scored if "expansion_origin" in scored.columns else scored.withColumn("expansion_origin", F.lit(None).cast("string"))
    return search.rerank_budget(scored, ["query_id"], top_k, entity_budget)


def answer(nodes: DataFrame, entities: DataFrame, questions: DataFrame) -> DataFrame:
    """query_id, answer, citations and no_results of every question (query_id, question).

    nodes: node_id, node_label, indexed_text, raw_text, embedding, url, anchor, breadcrumb, title.
    """
    plan = models.synthetic_plan(questions)
    best = rerank(retrieve(nodes, entities, plan), nodes, questions)
    cited = saved(search.citations(best), "cited")
    answers = models.extractive_answer(cited.select("query_id", F.col("id").alias("rank"), "snippet"))
    listed = cited.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("id", "node_id", "node_label", "title", "snippet", "score"))).alias("citations"))
    joined = questions.join(answers, "query_id", "left").join(listed, "query_id", "left")
    return joined.select("query_id", F.coalesce("answer", F.lit(NO_RESULTS)).alias("answer"), F.coalesce("citations", F.filter(F.array(F.struct(F.lit(0).alias("id"), F.lit("").alias("node_id"), F.lit("").alias("node_label"), F.lit("").alias("title"), F.lit("").alias("snippet"), F.lit(0.0).alias("score"))), lambda x: F.lit(False))).alias("citations"), F.col("citations").isNull().alias("no_results"))
