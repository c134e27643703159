"""A corpus pipeline: five of the operators, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, minhash, piece, toxicity
from tessera.llm.registry import table, vocabulary
from tessera.llm.shared import saved

#: No SQL states the classifiers and signatures; tests hold the stages against plain versions.
ORACLE_SQL = None


def filtered(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of docs that the operator leaves of (doc_id, text, lang), with all columns of docs, whatever they are called.

    The other columns go along in one struct, so that none clashes with what the operator adds.
    """
    own = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    rest = [c for c in docs.columns if c not in own]
    packed = docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("others"))
    return operator(packed).select(*[F.col(c) if c in own else F.col(f"others.`{c}`").alias(c) for c in docs.columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier chain takes as toxic."""
    labels = table(spark, sf_dir, "labels")
    return filtered(docs, lambda d: toxicity.classify(d, labels).where(~F.coalesce("toxic_pred", F.lit(False))))


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letters, whose language can't be told; all others stay, whatever their score.

    Where no document is labelled, the model has no languages and can't tell: only the letters count then.
    """
    learn = docs.where(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    model = langid.fit(learn)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    return filtered(docs, lambda d: langid.identify(d, model).where(F.col("lang_pred") != langid.UNKNOWN))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return filtered(docs, minhash.representatives)


def contamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    items = table(spark, sf_dir, "benchmark")
    return filtered(docs, lambda d: decontam.find_contamination(d, items).where("NOT contaminated"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes what is left: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return piece.encode_documents(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("language_id", language_filter),
    ("near_duplicates", near_duplicate_filter),
    ("decontamination", contamination_filter),
    ("piece_encoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
