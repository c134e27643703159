import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline
import __spark_entry__

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_columns_and_reject_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    some = docs.where("doc_id < 40")
    extra = spark.createDataFrame([(9001, f"Vorher {item} nachher", "de", "x", 1), (9002, "12345 !!", None, None, 1), (9003, "clean and short", "en", "x", 1), (9004, "clean and short", "en", "x", 1), (None, "no id here", "en", "x", 1)], SCHEMA)
    table = some.unionByName(extra)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language_id", "near_duplicates", "decontamination", "piece_encoding"]
    for name in list(stages)[:-1]:
        out = stages[name](spark, table, SF)
        assert out.columns == table.columns
        ids = Counter(r["doc_id"] for r in out.collect())
        if name == "language_id":
            assert 9002 not in ids and ids.keys() == {r["doc_id"] for r in table.collect()} - {9002} - {r["doc_id"] for r in table.collect() if not any(c.isalpha() for c in r["text"])}
        if name == "near_duplicates":
            assert 9003 in ids and 9004 not in ids and None in ids
        if name == "decontamination":
            assert 9001 not in ids and 9003 in ids
        if name == "toxicity":
            assert {9001, 9003, 9004, None} <= ids.keys()
    assert stages["piece_encoding"](spark, table, SF).count() == table.count()


def test_run_is_the_stages_in_order(spark):
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), SCHEMA)
    assert got == {r["doc_id"] for r in kept.collect()} and len(got) > 100


def test_language_stage_without_labels_keeps_what_has_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    table = docs.unionByName(spark.createDataFrame([(9001, "12345 !!", None, None, 1), (9002, None, None, None, 1), (9003, "\u00dcber", None, None, 1)], SCHEMA))
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, table, SF)
    assert out.columns == table.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in table.collect() if any(c.isalpha() for c in r["text"] or ""))


def test_stages_take_nulls_long_texts_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 30")
    rows = [(9001, None), (9002, ""), (9003, "long " + " ".join(f"w{i % 997}x" for i in range(60_000))), (9004, "clean and short"), (9004, "clean and short"), (None, "no id here")]
    table = docs.unionByName(spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], SCHEMA))
    names = ["score", "lang_pred", "toxic_pred", "p_toxic", "n_hit", "contaminated", "class_id", "own_id", "others", "Score2", "held_out"]
    for name in names:
        table = table.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns and dict(out.dtypes) == dict(table.dtypes)
        kept = out.collect()
        assert all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in kept for n in names)
        ids = {r["doc_id"] for r in kept}
        assert {9003, 9004, None} <= ids and ({9001, 9002} <= ids) == (name != "language_id")
    assert corpus_pipeline.STAGES[-1][1](spark, table, SF).count() == table.count()


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
