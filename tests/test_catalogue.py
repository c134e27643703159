"""Every query of the catalogue against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def shown(v):
    return "NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    kinds = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: KINDS[k] for c, k in got.dtypes} == kinds
    at = [relation.columns.index(c) for c in columns]
    want = sorted(tuple(shown(row[i]) for i in at) for row in relation.fetchall())
    assert sorted(tuple(map(shown, r)) for r in got.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_answers_embed_whole_texts(spark, monkeypatch, tmp_path):
    from tessera.plans import models, qa

    text = "word " * 100 + "needle in the last part"
    spark.createDataFrame([(1, text, "en", "web")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("nation", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    seen, answer = [], qa.answer
    monkeypatch.setattr(qa, "answer", lambda nodes, *rest: (seen.append(nodes), answer(nodes, *rest))[1])
    QUERIES["QA_answer_batch"](spark, str(tmp_path))
    want = spark.range(1).select(models.embed(F.lit(text)).alias("e")).first()["e"]
    assert seen[0].first()["embedding"] == want


def test_questions_are_searched_whole(spark):
    from tessera.plans import models, qa

    question = "word " * 120 + "needle"
    asked = spark.createDataFrame([(1, question)], "query_id long, question string")
    assert models.synthetic_plan(asked).first()["text"] == question
    rows = [("d1", "Section", "needle alone", "", None, "u", "", "", "")]
    nodes = spark.createDataFrame(rows, "node_id string, node_label string, indexed_text string, raw_text string, embedding array<double>, url string, anchor string, breadcrumb string, title string")
    entities = spark.createDataFrame([], "node_id string, label string, name string")
    got = qa.answer(nodes, entities, asked).first()
    assert not got["no_results"] and [c["node_id"] for c in got["citations"]] == ["d1"]


@pytest.mark.parametrize("name", ["B28_section_texts", "B29_callouts", "B32_table_rows", "B37_kept_sections", "F04_preceding_text"])
def test_parts_of_pages_are_read_where_the_pages_are(spark, name):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {p.name for p in folder.iterdir()}
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1
    assert {p.name for p in folder.iterdir()} == before  # and nothing is written on the way
