"""Retrieval metrics against gold questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import saved


def satisfied(groups: Column, ids: Column) -> Column:
    """How many groups (any-of lists) hold one of ids."""
    return F.size(F.filter(groups, lambda g: F.arrays_overlap(g, ids)))


def passage_gold(documents: DataFrame, questions: DataFrame, words: int = 8) -> DataFrame:
    """question_id and expected: for each node that holds a run of ``words`` words of the question's passage, a group of its own, by id.

    documents: node_id, text; questions: question_id, text.  Runs are joined by equality, those of the documents against the few distinct ones of the questions first;
    a question of fewer words, or that no document holds, has no row.  A run of a document is only its hash until a question's has the same.
    """
    held = lambda df, key: df.select(key, F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)).alias("w")).where(F.size("w") >= words)
    placed = lambda df: df.select("*", F.explode(F.sequence(F.lit(0), F.size("w") - words)).alias("i"))
    key = F.xxhash64(*[F.get("w", F.col("i") + n) for n in range(words)])

    def runs(df: DataFrame, key: str) -> DataFrame:
        own = df.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - words + 1), lambda i: F.array_join(F.slice("w", i, words), " "))).alias("run"))
        return own.distinct() if key == "question_id" else own

    asked = held(questions, "question_id")
    met = placed(held(documents, "node_id")).select("node_id", key.alias("key")).join(placed(asked).select(key.alias("key")).distinct(), "key", "left_semi").select("node_id").distinct()
    some = saved(held(documents.join(met, "node_id", "left_semi"), "node_id"), "held")
    pairs = runs(some, "node_id").join(runs(asked, "question_id"), "run").select("question_id", "node_id").distinct()
    return pairs.groupBy("question_id").agg(F.transform(F.array_sort(F.collect_list("node_id")), lambda x: F.array(x)).alias("expected"))


def id_metrics(answers: DataFrame, most: int = 8) -> DataFrame:
    """answers (question_id, category, expected array<array<string>>, retrieved array<string>, cited array<string>) with their metrics."""
    groups, got = F.col("expected"), F.slice("retrieved", 1, most)
    hits, cited = satisfied(groups, got), satisfied(groups, F.col("cited"))
    return answers.select(
        "question_id", "category", F.when(hits > 0, 1.0).otherwise(0.0).alias("id_hit_at_8"), F.when(F.size(groups) > 0, hits / F.size(groups)).otherwise(0.0).alias("id_recall_at_8"),
        F.when(cited > 0, 1.0).otherwise(0.0).alias("cited_expected_hit"), F.size("cited").cast("long").alias("citation_count"),
    )


#: The judge's metrics (fixed values).
JUDGED = ("faithfulness", "context_precision", "context_recall", "answer_relevancy", "factual_correctness", "semantic_similarity")


def judge_payload(question: Column, answer: Column, reference: Column, contexts: Column) -> Column:
    """What a judge is asked about one answer, as JSON: a question, the answer, the reference answer and the contexts (one empty one, where there are none)."""
    some = F.when(F.size(F.coalesce(contexts, F.array().cast("array<string>"))) > 0, contexts).otherwise(F.array(F.lit("")))
    text = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return F.to_json(F.struct(text(question, "question"), text(answer, "answer"), text(reference, "reference"), some.alias("contexts")))


def judged(rows: DataFrame, result: str = "result") -> DataFrame:
    """rows with the metrics of a judge's result (JSON); NaN for a metric that it hasn't, and for all where it has none."""
    told = F.from_json(F.col(result), ", ".join(f"{m} double" for m in JUDGED))
    return rows.withColumn("told", told).select(*rows.columns, *[F.coalesce(F.col(f"told.{m}"), F.lit(float("nan"))).alias(m) for m in JUDGED])


def means(metrics: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """Means of the columns, over all or by a column; NaN and null don't count."""
    wanted = [F.round(F.avg(F.when(~F.isnan(c), F.col(c))), 6).alias(c) for c in columns]
    return (metrics.groupBy(by) if by else metrics.groupBy()).agg(F.count("*").alias("n"), *wanted)


def gate(metrics: DataFrame, least: float, column: str = "id_hit_at_8") -> DataFrame:
    """One row: the mean and whether it reaches the least."""
    return metrics.agg(F.round(F.avg(column), 6).alias("mean")).select("mean", (F.col("mean") >= least).alias("passed"))


def contexts(candidates: DataFrame, most: int = 8) -> DataFrame:
    """query_id and the texts of its first ``most`` candidates that have one, each under its label and title."""
    text = F.trim(F.coalesce(F.when(F.col("indexed_text") != "", F.col("indexed_text")), F.col("raw_text"), F.lit("")))
    title = F.trim(F.coalesce("title", "breadcrumb", "node_id"))
    shown = candidates.where(F.col("rank") <= most).withColumn("text", text).where("text <> ''")
    line = F.struct("rank", F.concat(F.lit("["), F.col("node_label"), F.lit("] "), title, F.lit("\n"), F.col("text")).alias("line"))
    return shown.groupBy("query_id").agg(F.sort_array(F.collect_list(line)).alias("x")).select("query_id", F.transform("x", lambda s: s["line"]).alias("contexts"))
