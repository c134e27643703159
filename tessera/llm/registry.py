"""The queries of this subpackage: opN_<name> applies operator N to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import langid

    return langid.predict(table(spark, sf_dir, "documents"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import tokenbin

    return tokenbin.encode_to_shards(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import sitetree

    return sitetree.extract(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).drop("text")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import decontam

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_contamination(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tessera.llm import annlsh

    return annlsh.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tessera.llm import licences

    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join(F.array_sort(F.map_keys("licences")), ",")).withColumn("dice", F.round("dice", 6))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import minhash

    return minhash.classes(table(spark, sf_dir, "documents")).drop("text_hash", "label")


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import warc

    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages"))).drop("metadata", "conversion")


def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import piece

    return piece.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import revsearch

    return revsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm import tokencount

    return tokencount.count(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_token_shards, op3_html_text, op4_toxicity, op5_decontamination, op6_nearest_vectors, op7_licence_scan, op8_near_duplicates, op9_warc_derivatives, op10_piece_encoding, op11_reversed_search, op12_whitening, op13_token_counts)}


def oracle_sql() -> dict[str, str]:
    from tessera.llm import decontam, licences, revsearch

    return {"op5_decontamination": decontam.SQL, "op7_licence_scan": licences.SQL, "op11_reversed_search": revsearch.SQL}
