"""The query catalogue: each operator on the star-schema and text tables, with the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import contexts as cx
from tessera.functions import text as tx
from tessera.functions.vectors import cosine
from tessera.plans.build import build
from tessera.sources.parts import Parts
from tessera.sources.shared import saved, shared_folder
from tessera.operators import audit, choose, entities, evaluate, graph, load, parse, resolve, search, store
from tessera.operators.textindex import TextIndex
from tessera.operators.vectorindex import VectorIndex

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


# ---- search -------------------------------------------------------------------------------------

TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+')"
BM25_CTE = rf"""
q AS (SELECT item_id AS query_id, unnest(list_distinct({TOKENS.format("text")})) AS term FROM benchmark),
d AS (SELECT doc_id, {TOKENS.format("text")} AS t FROM documents WHERE text <> ''),
st AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM d),
post AS (SELECT doc_id, length, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS length, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
sc AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score FROM post JOIN df USING (term) JOIN q USING (term), st GROUP BY ALL),
lex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc) WHERE rank <= 50)"""
VECTOR_CTE = """
vq AS (SELECT vec_id AS query_id, embedding AS vector FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark)),
vs AS (SELECT query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], vector::DOUBLE[]), 6) AS score FROM embeddings, vq),
vec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM vs) WHERE rank <= 50)"""


def _lexical(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "documents").select(F.col("doc_id").alias("node_id"), F.col("text").alias("indexed_text"))
    return search.bm25(nodes, table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), "text"))


def _vectors(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "embeddings").select(F.col("vec_id").alias("node_id"), "embedding")
    asked = nodes.join(table(s, d, "benchmark").select(F.col("item_id").alias("node_id")).distinct(), "node_id", "left_semi")  # the vector of each item
    return search.vector_search(nodes, asked.select(F.col("node_id").alias("query_id"), F.col("embedding").alias("vector")))


@query(f"WITH {BM25_CTE} SELECT query_id, doc_id, score, rank FROM lex")
def J01_bm25_topk(s: SparkSession, d: str) -> DataFrame:
    return _lexical(s, d).select("query_id", F.col("node_id").alias("doc_id"), "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {BM25_CTE}, f AS (SELECT * FROM documents WHERE lang = 'en') SELECT 'all' AS kind, query_id, doc_id, score FROM lex UNION ALL SELECT 'en', query_id, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE doc_id IN (SELECT doc_id FROM f)) WHERE rank <= 50")
def J02_stored_index(s: SparkSession, d: str) -> DataFrame:
    """A stored index of other texts and languages, brought up to date, is searched twice: all documents and those of a language."""
    docs = table(s, d, "documents").select(F.col("doc_id").alias("node_id"), F.col("text").alias("indexed_text"), "lang")
    index = TextIndex(s, f"{shared_folder(s)}/text-index-{uuid.uuid4().hex}")
    before = docs.where("node_id % 3 <> 2").withColumn("indexed_text", F.when(F.col("node_id") % 3 == 1, F.concat("indexed_text", F.lit(" old words"))).otherwise(F.col("indexed_text"))).withColumn("lang", F.when(F.col("node_id") % 2 == 0, "xx").otherwise(F.col("lang")))
    gone = docs.limit(0).unionByName(s.createDataFrame([(-1, "gone words", "en")], docs.schema))
    index.update(before.unionByName(gone), ("lang",))
    index.update(docs, ("lang",), whole=True)
    asked = table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    every, english = index.bm25(asked), index.bm25(asked, wanted=F.col("lang") == "en")
    return every.select(F.lit("all").alias("kind"), "query_id", F.col("node_id").alias("doc_id"), "score").unionByName(english.select(F.lit("en").alias("kind"), "query_id", F.col("node_id").alias("doc_id"), "score"))


@query(f"WITH {VECTOR_CTE} SELECT query_id, vec_id, score, rank FROM vec")
def J03_vector_topk(s: SparkSession, d: str) -> DataFrame:
    return _vectors(s, d).select("query_id", F.col("node_id").alias("vec_id"), "score", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {VECTOR_CTE} SELECT query_id, vec_id, score, rank FROM vec")
def J04_vector_index(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "embeddings").select(F.col("vec_id").alias("node_id"), "embedding")
    index = VectorIndex(s, f"{shared_folder(s)}/vector-index-{uuid.uuid4().hex}")
    index.build(nodes)
    asked = nodes.join(table(s, d, "benchmark").select(F.col("item_id").alias("node_id")).distinct(), "node_id", "left_semi")
    return index.search(asked.select(F.col("node_id").alias("query_id"), F.col("embedding").alias("vector"))).select("query_id", F.col("node_id").alias("vec_id"), "score", F.col("rank").cast("long").alias("rank"))


MERGED = f"WITH {BM25_CTE}, {VECTOR_CTE}, legs AS (SELECT coalesce(l.query_id, v.query_id) AS query_id, coalesce(doc_id, vec_id) AS node_id, l.score AS bm25_score, v.score AS vector_score FROM lex l FULL OUTER JOIN vec v ON l.query_id = v.query_id AND doc_id = vec_id)"


def _merged(s: SparkSession, d: str) -> DataFrame:
    return search.merge_legs(_lexical(s, d), _vectors(s, d), ["query_id", "node_id"])


def _kept(s: SparkSession, d: str) -> DataFrame:
    """The merged legs, written once: both the fusion and what comes after it read them."""
    return saved(_merged(s, d), "legs")


@query(f"{MERGED} SELECT * FROM legs")
def H05_merge_legs(s: SparkSession, d: str) -> DataFrame:
    return _merged(s, d)


RRF = f"""{MERGED}, parts AS (SELECT query_id, node_id, 1.0::DOUBLE / (60 + row_number() OVER (PARTITION BY query_id ORDER BY bm25_score DESC, node_id)) AS part FROM legs WHERE bm25_score IS NOT NULL
 UNION ALL SELECT query_id, node_id, 1.0::DOUBLE / (60 + row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, node_id)) FROM legs WHERE vector_score IS NOT NULL),
fused AS (SELECT query_id, node_id, round(sum(part), 9) AS rrf_score FROM parts GROUP BY ALL),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, node_id) AS rank FROM fused) WHERE rank <= 40)"""


def _fused(legs: DataFrame) -> DataFrame:
    return search.rrf(legs, ["bm25_score", "vector_score"], ["query_id"], ["node_id"])


@query(f"{RRF} SELECT query_id, node_id, rrf_score, rank FROM ranked")
def J10_rrf_fuse(s: SparkSession, d: str) -> DataFrame:
    return _fused(_kept(s, d)).withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH {BM25_CTE}, f AS (SELECT * FROM documents WHERE lang = 'en' AND starts_with(source, 'src1'))
SELECT query_id, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE doc_id IN (SELECT doc_id FROM f)) WHERE rank <= 50""")
def C08_bm25_filtered(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents")
    nodes = docs.select(F.col("doc_id").alias("node_id"), F.col("text").alias("indexed_text"), "lang", "source")
    asked = table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = search.bm25(nodes, asked, 50, (F.col("lang") == "en") & F.startswith("source", F.lit("src1")))
    return found.select("query_id", F.col("node_id").alias("doc_id"), "score")


@query(f"WITH {BM25_CTE} SELECT query_id, lex.doc_id, score, f.source FROM lex LEFT JOIN (SELECT * FROM documents WHERE starts_with(source, 'src1')) f ON lex.doc_id = f.doc_id")
def X01_prefix_on_clause(s: SparkSession, d: str) -> DataFrame:
    """The filter in the join's condition: it nulls the page's columns but drops no row."""
    pages = table(s, d, "documents").where(F.startswith("source", F.lit("src1"))).select(F.col("doc_id").alias("node_id"), "source")
    return _lexical(s, d).join(pages, "node_id", "left").select("query_id", F.col("node_id").alias("doc_id"), "score", "source")


LOOKUP = r"""WITH names AS (SELECT 'part:' || p_partkey AS node_id, string_split(p_name, ' ')[1] AS name FROM part UNION ALL SELECT 'nation:' || n_nationkey, n_name FROM nation UNION ALL SELECT 'region:' || r_regionkey, r_name FROM region),
asked AS (SELECT n_nationkey AS query_id, list_transform(string_split('tell me about ' || n_name || ' and ' || left(n_name, 4), ' '), lambda x: lower(x)) AS terms FROM nation),
hit AS (SELECT query_id, node_id, name, CASE WHEN list_contains(terms, lower(name)) THEN 3.0 WHEN len(list_filter(terms, lambda t: length(t) >= 4 AND starts_with(lower(name), t))) > 0 THEN 2.0
 WHEN length(name) >= 4 AND len(list_filter(terms, lambda t: starts_with(t, lower(name)))) > 0 THEN 1.0 ELSE 0.0 END AS score FROM names, asked)
SELECT query_id, node_id, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, name, node_id) AS rank FROM hit WHERE score > 0) WHERE rank <= 50"""


@query(LOOKUP)
def J05_entity_lookup(s: SparkSession, d: str) -> DataFrame:
    named = lambda t, key, name: table(s, d, t).select(F.concat(F.lit(f"{t}:"), F.col(key).cast("string")).alias("node_id"), name.alias("name"))
    names = named("part", "p_partkey", F.element_at(F.split("p_name", " "), 1)).union(named("nation", "n_nationkey", F.col("n_name"))).union(named("region", "r_regionkey", F.col("r_name")))
    text = F.concat(F.lit("tell me about "), F.col("n_name"), F.lit(" and "), F.substring("n_name", 1, 4))
    asked = table(s, d, "nation").select(F.col("n_nationkey").alias("query_id"), F.split(text, " ").alias("terms"))
    return search.entity_lookup(names, asked).select("query_id", "node_id", "score")


BUDGET = f"""{RRF}, cand AS (SELECT query_id, node_id, CASE WHEN node_id % 3 = 0 THEN 'Tool' ELSE 'Section' END AS node_label, rrf_score AS rerank_score, b.bm25_score FROM ranked JOIN legs b USING (query_id, node_id)),
lanes AS (SELECT *, (node_label = 'Tool')::INT AS lane FROM cand),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id, lane ORDER BY CASE WHEN lane = 1 AND bm25_score IS NULL THEN 1 ELSE 0 END, rerank_score DESC, node_label, node_id) AS place FROM lanes),
chosen AS (SELECT *, sum(lane) OVER (PARTITION BY query_id) AS entities FROM placed WHERE place <= CASE WHEN lane = 1 THEN 2 ELSE 8 END)
SELECT query_id, node_id, node_label, rerank_score, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, node_label, node_id) AS rank FROM chosen WHERE lane = 1 OR place <= 8 - entities"""


@query(BUDGET)
def J12_rerank_budget(s: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("node_id") % 3 == 0, "Tool").otherwise("Section")
    legs = _kept(s, d)
    scored = _fused(legs).drop("rank").join(legs, ["query_id", "node_id"]).select("query_id", "node_id", label.alias("node_label"), F.col("rrf_score").alias("rerank_score"), "bm25_score", F.lit(None).cast("string").alias("expansion_origin"))
    return search.rerank_budget(scored, ["query_id"]).select("query_id", "node_id", "node_label", "rerank_score", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {BM25_CTE}, top AS (SELECT * FROM lex WHERE rank <= 5)
SELECT query_id, string_agg('[' || rank || '] Section ' || coalesce(nullif(source, ''), doc_id::VARCHAR) || chr(10) || '    url: /' || lang || '#a' || doc_id || chr(10) || '    ' || left(text, 800), chr(10) || chr(10) ORDER BY rank) AS evidence FROM top JOIN documents USING (doc_id) GROUP BY query_id""")
def I22_evidence_render(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(F.col("doc_id").alias("node_id"), F.lit("Section").alias("node_label"), F.col("source").alias("title"), F.lit("").alias("breadcrumb"), F.concat(F.lit("/"), "lang").alias("url"), F.concat(F.lit("a"), F.col("doc_id").cast("string")).alias("anchor"), F.col("text").alias("indexed_text"), F.lit("").alias("raw_text"))
    found = _lexical(s, d).where("rank <= 5").join(docs, "node_id").withColumn("node_id", F.col("node_id").cast("string"))
    return search.evidence(found, ["query_id"])


GOLD = r"""
iw AS (SELECT item_id AS question_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark), dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
ir AS (SELECT DISTINCT question_id, array_to_string(w[i:i + 7], ' ') AS run FROM (SELECT question_id, w, unnest(range(1, len(w) - 6)) AS i FROM iw WHERE len(w) >= 8)),
dr AS (SELECT doc_id, array_to_string(w[i:i + 7], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM dw WHERE len(w) >= 8)),
gd AS (SELECT question_id, list(doc_id ORDER BY doc_id) AS expected FROM (SELECT DISTINCT question_id, doc_id FROM ir JOIN dr USING (run)) GROUP BY question_id)"""
METRICS = f"""WITH {BM25_CTE}, {GOLD}, ans AS (SELECT query_id, list(doc_id ORDER BY rank) AS got FROM lex GROUP BY query_id),
gold AS (SELECT query_id, 'c' || query_id % 3 AS category, coalesce(expected, []) AS expected, got[:8] AS retrieved, got[:2] AS cited FROM ans LEFT JOIN gd ON query_id = question_id),
m AS (SELECT query_id, category, len(expected) AS n, len(list_intersect(expected, retrieved)) AS hits, len(list_intersect(expected, cited)) AS chits, len(cited) AS citation_count FROM gold)"""


def _gold(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select(F.col("doc_id").alias("node_id"), "text")
    return evaluate.passage_gold(docs, table(s, d, "benchmark").select(F.col("item_id").alias("question_id"), "text"))


def _metrics(s: SparkSession, d: str) -> DataFrame:
    """The answers of the full-text search against the documents that hold a passage of the question."""
    got = _lexical(s, d).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "node_id"))).alias("x")).select("query_id", F.transform("x", lambda r: r["node_id"]).alias("got"))
    q = F.col("question_id")
    answers = got.withColumnRenamed("query_id", "question_id").join(_gold(s, d), "question_id", "left")
    expected = F.coalesce("expected", F.array().cast("array<array<bigint>>"))
    return evaluate.id_metrics(answers.select(q, F.concat(F.lit("c"), (q % 3).cast("string")).alias("category"), expected.alias("expected"), F.slice("got", 1, 8).alias("retrieved"), F.slice("got", 1, 2).alias("cited")))


@query(f"WITH {GOLD.lstrip()} SELECT question_id, array_to_string(expected, ',') AS expected FROM gd")
def Q01_passage_gold(s: SparkSession, d: str) -> DataFrame:
    return _gold(s, d).select("question_id", F.array_join(F.transform("expected", lambda g: g[0].cast("string")), ",").alias("expected"))


@query(f"{METRICS} SELECT query_id AS question_id, category, CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS id_hit_at_8, CASE WHEN n > 0 THEN hits / n::DOUBLE ELSE 0.0::DOUBLE END AS id_recall_at_8, CASE WHEN chits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cited_expected_hit, citation_count FROM m")
def Q02_id_metrics(s: SparkSession, d: str) -> DataFrame:
    return _metrics(s, d)


@query(f"{METRICS} SELECT category, count(*) AS n, round(avg(CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS id_hit_at_8, round(avg(CASE WHEN n > 0 THEN hits / n::DOUBLE ELSE 0.0::DOUBLE END), 6) AS id_recall_at_8 FROM m GROUP BY category")
def E14_category_means(s: SparkSession, d: str) -> DataFrame:
    return evaluate.means(_metrics(s, d), ["id_hit_at_8", "id_recall_at_8"], "category")


@query(f"{METRICS} SELECT round(avg(CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS mean, round(avg(CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) >= 0.9 AS passed FROM m")
def Q05_hit_gate(s: SparkSession, d: str) -> DataFrame:
    return evaluate.gate(_metrics(s, d), 0.9)


# ---- text functions -----------------------------------------------------------------------------

SLUG = r"trim(regexp_replace(regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}_\s-]', '', 'g'), '[\s_-]+', '-', 'g'), '-')"


@query(f"WITH x AS (SELECT p_partkey, p_brand, {SLUG.format('p_type')} AS base FROM part), y AS (SELECT *, row_number() OVER (PARTITION BY p_brand, base ORDER BY p_partkey) - 1 AS n FROM x) SELECT p_partkey, p_brand, CASE WHEN n = 0 THEN base ELSE base || '-' || n END AS anchor FROM y")
def B24_anchor_unique(s: SparkSession, d: str) -> DataFrame:
    parts = table(s, d, "part").select("p_partkey", "p_brand", tx.slugify(F.col("p_type")).alias("base"))
    return parts.select("p_partkey", "p_brand", parse.unique_anchor(["p_brand"], "base", "p_partkey").alias("anchor"))


@query(f"SELECT doc_id, {SLUG.format('text')} AS slug, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS loose FROM documents")
def I01_slugs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", tx.slugify(F.col("text")).alias("slug"), tx.loose_key(F.col("text")).alias("loose"))


@query("SELECT doc_id, sha256(text) AS content_hash, left(sha256(source || '#' || lang || '|' || doc_id || '|row'), 16) AS node_id FROM documents")
def I08_content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", tx.content_hash(F.col("text")).alias("content_hash"), tx.atom_id(F.concat_ws("#", "source", "lang"), F.col("doc_id"), F.lit("row")).alias("node_id"))


@query("SELECT l_orderkey, l_linenumber, left(sha256('LINKS_TO|' || l_orderkey || '|' || l_partkey || '|' || l_returnflag), 16) AS edge_id FROM lineitem")
def I08_edge_ids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", tx.edge_id(F.lit("LINKS_TO"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag")).alias("edge_id"))


TICKED = "array_to_string(list_transform(string_split(text, ' '), lambda x, i: CASE WHEN i % 5 = 0 THEN '`\"' || x || '\"`' ELSE x END), ' ')"


def _ticked() -> Column:
    return F.array_join(F.transform(F.split("text", " "), lambda x, i: F.when((i + 1) % 5 == 0, F.concat(F.lit('`"'), x, F.lit('"`'))).otherwise(x)), " ")


@query(f"WITH t AS (SELECT conv_id, turn, role, {TICKED} AS m FROM conversations), c AS (SELECT *, list_filter(list_transform(regexp_extract_all(m, '`([^`]+)`', 1), lambda x: trim(trim(trim(x), '\"'), '''')), lambda x: x <> '') AS ids FROM t) SELECT conv_id, turn, role, array_to_string(ids, chr(10)) AS identifiers, coalesce(ids[1], trim(regexp_replace(m, '\\s+', ' ', 'g'))) AS first_code FROM c")
def I09_code_identifiers(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "conversations").withColumn("m", _ticked())
    return t.select("conv_id", "turn", "role", F.array_join(tx.code_identifiers(F.col("m")), "\n").alias("identifiers"), tx.first_code_or_text(F.col("m")).alias("first_code"))


@query(r"""WITH w AS (SELECT conv_id, turn, role, list_filter(list_transform(regexp_split_to_array(text, '\s+'), lambda x: regexp_replace(regexp_replace(x, '^[,.;:?!()\[\]{}"'']+', ''), '[,.;:?!()\[\]{}"'']+$', '')), lambda x: length(x) >= 2) AS t FROM conversations)
SELECT conv_id, turn, role, array_to_string(list_filter(t, lambda x, i: list_position(list_transform(t, lambda y: lower(y)), lower(x)) = i), ' ') AS terms FROM w""")
def I15_query_terms(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conversations").select("conv_id", "turn", "role", F.array_join(tx.query_terms(F.col("text")), " ").alias("terms"))


@query(r"""SELECT conv_id, turn, role, regexp_replace(text, '([+\-!(){}\[\]^"~*?:\\/&|])', '\\\1', 'g') AS escaped, concat_ws(' ', nullif(trim(text), ''), nullif(trim(role), '')) AS query FROM conversations""")
def I13_query_string(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conversations").select("conv_id", "turn", "role", tx.escape_query(F.col("text")).alias("escaped"), tx.query_string(F.col("text"), F.array("role")).alias("query"))


MARKED = "text || ' [' || (turn + 1) || '] and [' || (conv_id % 9) || '] again [' || (turn + 1) || ']'"


@query(f"WITH a AS (SELECT conv_id, turn, role, {MARKED} AS answer, [turn + 1, 3]::INT[] AS used FROM conversations), b AS (SELECT *, list_distinct(list_transform(regexp_extract_all(answer, '\\[(\\d+)\\]', 1), lambda x: x::INT)) AS ids FROM a) SELECT conv_id, turn, role, array_to_string(list_sort(ids), ',') AS ids, array_to_string(list_sort(list_filter(used, lambda n: NOT list_contains(ids, n))), ',') AS missing, array_to_string(list_sort(list_filter(ids, lambda n: n < 1 OR n > 4)), ',') AS out_of_range, len(list_filter(used, lambda n: NOT list_contains(ids, n))) = 0 AND len(list_filter(ids, lambda n: n < 1 OR n > 4)) = 0 AS ok FROM b")
def I20_citations(s: SparkSession, d: str) -> DataFrame:
    t, c = F.col("turn") + 1, (F.col("conv_id") % 9).cast("string")
    answer = F.concat("text", F.lit(" ["), t.cast("string"), F.lit("] and ["), c, F.lit("] again ["), t.cast("string"), F.lit("]"))
    rows = table(s, d, "conversations").select("conv_id", "turn", "role", answer.alias("answer"), F.array(t.cast("int"), F.lit(3)).alias("used"))
    check = tx.citation_check(F.col("answer"), F.lit(4), F.col("used"))
    show = lambda a: F.array_join(F.transform(F.array_sort(a), lambda x: x.cast("string")), ",")
    return rows.withColumn("k", check).select("conv_id", "turn", "role", show(tx.citation_ids(F.col("answer"))).alias("ids"), show(F.col("k.missing")).alias("missing"), show(F.col("k.out_of_range")).alias("out_of_range"), F.col("k.ok").alias("ok"))


LABEL = "CASE doc_id % 4 WHEN 0 THEN 'Section' WHEN 1 THEN 'CodeBlock' WHEN 2 THEN 'Callout' ELSE 'Other' END"
CRUMB = "source || ' > ' || lang || CASE WHEN doc_id % 3 = 0 THEN ' > deep' ELSE '' END"


def _payloads(s: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id") % 4
    label = F.when(i == 0, "Section").when(i == 1, "CodeBlock").when(i == 2, "Callout").otherwise("Other")
    crumb = F.concat("source", F.lit(" > "), "lang", F.when(F.col("doc_id") % 3 == 0, " > deep").otherwise(""))
    return table(s, d, "documents").select("doc_id", label.alias("label"), F.col("text").alias("raw_text"), crumb.alias("breadcrumb"), (F.col("doc_id") % 20 == 0).alias("synthesized"), F.substring("text", 1, 300).alias("preceding"), "lang", "source")


@query(f"""WITH n AS (SELECT doc_id, {LABEL} AS label, text, {CRUMB} AS crumb FROM documents)
SELECT doc_id, label, CASE label WHEN 'Section' THEN CASE WHEN trim(text) IN ('', '---') THEN 'skip' WHEN doc_id % 20 = 0 THEN 'template' WHEN length(text) > 200 AND len(string_split(crumb, ' > ')) >= 3 THEN 'template' ELSE 'llm' END
 WHEN 'CodeBlock' THEN CASE WHEN length(text) > 1000 AND length(left(text, 300)) > 200 THEN 'template' ELSE 'llm' END WHEN 'Callout' THEN 'llm' ELSE 'skip' END AS route FROM n""")
def I26_route_nodes(s: SparkSession, d: str) -> DataFrame:
    p = _payloads(s, d)
    return p.select("doc_id", "label", cx.route(F.col("label"), F.col("raw_text"), F.col("breadcrumb"), F.col("synthesized"), F.col("preceding")).alias("route"))


@query(f"""WITH n AS (SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'Section' ELSE 'CodeBlock' END AS label, text, lang, source, {CRUMB} AS crumb FROM documents),
c AS (SELECT *, CASE WHEN label = 'CodeBlock' THEN trim('[' || lang || ': example] In ' || crumb || '. ' || left(text, 200)) WHEN doc_id % 20 = 0 THEN '[changelog entry] Release notes for ' || string_split(crumb, ' > ')[-1] || '.'
 ELSE trim('[' || source || ' — ' || string_split(crumb, ' > ')[-1] || '] Subsection of "' || array_to_string(string_split(crumb, ' > ')[:-2], ' > ') || '". ' || trim(left(text, 120))) END AS context FROM n)
SELECT doc_id, label, context, context || chr(10) || chr(10) || CASE WHEN label = 'CodeBlock' THEN '[' || lang || ']' || chr(10) || text ELSE text END AS indexed_text FROM c""")
def I25_indexed_text(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    p = _payloads(s, d).withColumn("label", F.when(c("doc_id") % 2 == 0, "Section").otherwise("CodeBlock"))
    context = cx.template(c("label"), cx.section_template(c("breadcrumb"), c("source"), c("raw_text"), c("synthesized")), cx.code_template(c("lang"), c("breadcrumb"), F.substring("preceding", 1, 200)))
    none = F.array().cast("array<string>")
    shown = cx.raw_representation(c("label"), c("raw_text"), c("lang"), none, none, c("source"), c("source"))
    return p.withColumn("context", context).select("doc_id", "label", "context", cx.indexed_text(c("context"), shown).alias("indexed_text"))


PHRASES = "[" + ", ".join(f"'{p}'" for p in cx.FORBIDDEN_PHRASES) + "]"


@query(f"""WITH c AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'The ' || text WHEN 3 THEN text || ' in the documentation' ELSE text END AS context FROM documents UNION ALL SELECT item_id, CASE item_id % 2 WHEN 0 THEN 'The ' || text ELSE text END FROM benchmark)
SELECT doc_id, CASE WHEN length(context) < 10 THEN 'too short' WHEN length(context) > 600 THEN 'too long' WHEN trim(regexp_replace(context, '\\s+', ' ', 'g')) = '' THEN 'empty'
 WHEN regexp_replace(lower(string_split(trim(regexp_replace(context, '\\s+', ' ', 'g')), ' ')[1]), '[:,.;!?]+$', '') IN ('this', 'the', 'a', 'an') THEN 'opener' WHEN len(list_filter({PHRASES}, lambda p: contains(lower(context), p))) > 0 THEN 'phrase' END AS error FROM c""")
def I27_context_validation(s: SparkSession, d: str) -> DataFrame:
    i, t = F.col("doc_id") % 5, F.col("text")
    context = F.when(i == 0, F.concat(F.lit("The "), t)).when(i == 3, F.concat(t, F.lit(" in the documentation"))).otherwise(t)
    items = table(s, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("The "), t)).otherwise(t).alias("context"))
    return table(s, d, "documents").select("doc_id", context.alias("context")).union(items).select("doc_id", cx.context_error(F.col("context")).alias("error"))


@query("""WITH c AS (SELECT c_custkey, c_name, n_name, CASE c_custkey % 4 WHEN 0 THEN n_name || ': baseline' WHEN 1 THEN n_name || ' without' WHEN 2 THEN n_name || ': near ' || 'KENYA' ELSE n_name || ': plain' END AS context FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, CASE WHEN NOT starts_with(context, n_name || ':') THEN 'prefix' WHEN n_name <> 'KENYA' AND regexp_matches(context, '(^|[^A-Za-z0-9_])KENYA($|[^A-Za-z0-9_])') THEN 'sibling' END AS error FROM c""")
def I28_entity_context_rules(s: SparkSession, d: str) -> DataFrame:
    joined = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    i, n = F.col("c_custkey") % 4, F.col("n_name")
    context = F.when(i == 0, F.concat(n, F.lit(": baseline"))).when(i == 1, F.concat(n, F.lit(" without"))).when(i == 2, F.concat(n, F.lit(": near KENYA"))).otherwise(F.concat(n, F.lit(": plain")))
    return joined.select("c_custkey", cx.entity_context_error(F.lit("PermissionMode"), n, context, F.array(F.lit("KENYA"))).alias("error"))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
def C05_resume_missing(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left").select("doc_id", F.col("quality").alias("context"), F.col("source").alias("context_source"))
    return store.resume(nodes, "missing_only").select("doc_id")


@query("SELECT doc_id FROM documents WHERE source IN ('src1', 'src7')")
def A10_resume_by_source(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "documents").select("doc_id", F.lit("").alias("context"), F.col("source").alias("context_source"))
    return store.resume(nodes, "by_source", ["src1", "src7"]).select("doc_id")


# ---- graph: region > nation > customer > orders as containment, lineitem as links ---------------

EDGES = """edges AS (SELECT 'HAS_SUBSECTION' AS type, 'r' || n_regionkey AS source_id, 'n' || n_nationkey AS target_id FROM nation
 UNION ALL SELECT 'HAS_SUBSECTION', 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'CONTAINS_CODE', 'c' || o_custkey, 'o' || o_orderkey FROM orders
 UNION ALL SELECT DISTINCT 'LINKS_TO', 'o' || l_orderkey, 'p' || l_partkey FROM lineitem UNION ALL SELECT DISTINCT 'DEFINES', 'n' || s_nationkey, 's' || s_suppkey FROM supplier)"""
SEEDS = "seeds AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS seed_rank, 'o' || o_orderkey AS node_id FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"


def _graph(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    def key(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    def edges(name: str, kind: str, source: Column, target: Column) -> DataFrame:
        return table(s, d, name).select(F.lit(kind).alias("type"), source.alias("source_id"), target.alias("target_id"))

    all_edges = (
        edges("nation", "HAS_SUBSECTION", key("r", "n_regionkey"), key("n", "n_nationkey")).union(edges("customer", "HAS_SUBSECTION", key("n", "c_nationkey"), key("c", "c_custkey"))).union(edges("orders", "CONTAINS_CODE", key("c", "o_custkey"), key("o", "o_orderkey")))
        .union(edges("lineitem", "LINKS_TO", key("o", "l_orderkey"), key("p", "l_partkey")).distinct()).union(edges("supplier", "DEFINES", key("n", "s_nationkey"), key("s", "s_suppkey")))
    )

    def nodes(name: str, label: str, ident: Column, natural: Column | None = None, language: Column | None = None) -> DataFrame:
        null = F.lit(None).cast("string")
        return table(s, d, name).select(ident.alias("node_id"), F.lit(label).alias("node_label"), (natural if natural is not None else null).alias("natural_key"), (language if language is not None else null).alias("language"), F.lit(None).cast("int").alias("position"))

    all_nodes = nodes("region", "Section", key("r", "r_regionkey")).union(nodes("nation", "Section", key("n", "n_nationkey"))).union(nodes("customer", "Section", key("c", "c_custkey"))).union(nodes("orders", "CodeBlock", key("o", "o_orderkey"), None, F.col("o_orderstatus"))).union(nodes("part", "Page", key("p", "p_partkey"))).union(nodes("supplier", "Tool", key("s", "s_suppkey"), F.col("s_name")))
    return all_edges, all_nodes


def _seeds(s: SparkSession, d: str) -> DataFrame:
    some = table(s, d, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return some.select(F.col("o_orderkey").alias("seed_rank"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("node_id"), F.lit("CodeBlock").alias("node_label"))


@query(f"""WITH RECURSIVE {EDGES}, walk AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS node_id, 0 AS depth FROM region UNION ALL SELECT root, target_id, depth + 1 FROM walk JOIN edges ON source_id = node_id WHERE type IN ('HAS_SUBSECTION', 'CONTAINS_CODE'))
SELECT root, depth, count(*) AS n FROM walk GROUP BY ALL""")
def KT1_closure_depths(s: SparkSession, d: str) -> DataFrame:
    edges, _ = _graph(s, d)
    roots = table(s, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node_id"))
    return graph.closure(edges.where(F.col("type").isin("HAS_SUBSECTION", "CONTAINS_CODE")), roots).groupBy("root", "depth").agg(F.count("*").alias("n"))


@query(f"""WITH {EDGES}, {SEEDS}, held AS (SELECT * FROM edges WHERE type = 'CONTAINS_CODE'),
f AS (SELECT DISTINCT s.node_id AS seed_id, seed_rank, b.target_id AS node_id FROM seeds s JOIN held a ON a.target_id = s.node_id JOIN held b ON a.source_id = b.source_id WHERE b.target_id <> s.node_id)
SELECT seed_id, node_id, 'CodeBlock' AS node_label FROM f ORDER BY seed_rank, node_id LIMIT (SELECT 3 * count(*) FROM seeds)""")
def KT4_expand_siblings(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    return graph.expand_siblings(edges, nodes, _seeds(s, d)).select("seed_id", "node_id", "node_label")


@query(f"""WITH {SEEDS}, f AS (SELECT s.node_id AS seed_id, seed_rank, 'r' || n_regionkey AS node_id FROM seeds s JOIN orders ON s.node_id = 'o' || o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT seed_id, node_id, 'Page' AS node_label FROM f ORDER BY seed_rank, node_id LIMIT (SELECT 3 * count(*) FROM seeds)""")
def KT5_expand_parent_page(s: SparkSession, d: str) -> DataFrame:
    edges, _ = _graph(s, d)
    roots = table(s, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node_id"))
    pages = graph.closure(edges.where(F.col("type").isin("HAS_SUBSECTION", "CONTAINS_CODE")), roots).select("node_id", F.col("root").alias("page_id"))
    return graph.expand_parent_page(pages, _seeds(s, d)).select("seed_id", "node_id", "node_label")


@query(f"""WITH {EDGES}, {SEEDS} SELECT node_id AS seed_id, target_id AS node_id, 'Page' AS node_label FROM seeds JOIN edges ON source_id = node_id WHERE type = 'LINKS_TO' ORDER BY seed_rank, target_id LIMIT (SELECT 3 * count(*) FROM seeds)""")
def KT6_expand_links(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    return graph.expand_targets(edges, nodes, _seeds(s, d), ("LINKS_TO", "LINKS_TO_PAGE")).select("seed_id", "node_id", "node_label")


@query(f"""WITH {SEEDS}, e AS (SELECT DISTINCT 'o' || l_orderkey AS source_id, 's' || l_suppkey AS target_id FROM lineitem)
SELECT node_id AS seed_id, target_id AS node_id, 'Tool' AS node_label FROM seeds JOIN e ON source_id = node_id ORDER BY seed_rank, target_id LIMIT (SELECT 3 * count(*) FROM seeds)""")
def KT7_expand_navigates_to(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    key = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    table_links = table(s, d, "lineitem").select(F.lit("NAVIGATES_TO").alias("type"), key("o", "l_orderkey").alias("source_id"), key("s", "l_suppkey").alias("target_id"))
    return graph.expand_targets(edges.union(table_links), nodes, _seeds(s, d), ("NAVIGATES_TO",)).select("seed_id", "node_id", "node_label")


@query("SELECT 's' || l_suppkey AS entity_id, min('p' || l_partkey) AS section_id FROM lineitem GROUP BY 1")
def D13_first_definition(s: SparkSession, d: str) -> DataFrame:
    key = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    return entities.first_definition(table(s, d, "lineitem").select(F.lit("DEFINES").alias("type"), key("p", "l_partkey").alias("source_id"), key("s", "l_suppkey").alias("target_id")))


@query("""WITH n AS (SELECT n_nationkey, n_name, r_name, n_nationkey % 2 = 0 AS by_anchor FROM nation JOIN region ON n_regionkey = r_regionkey),
sec AS (SELECT DISTINCT mktsegment.r_name AS path, lower(n_name) AS anchor FROM n mktsegment WHERE n_nationkey IN (SELECT s_nationkey FROM supplier))
SELECT 'MessageType' AS label, n_name AS name, r_name || '#' || lower(n_name) AS source_id FROM n WHERE by_anchor AND (r_name, lower(n_name)) IN (SELECT path, anchor FROM sec)
UNION ALL SELECT 'Provider', n_name, f.source_id FROM n LEFT JOIN (SELECT path, min(path || '#' || anchor) AS source_id FROM sec GROUP BY path) f ON f.path = n.r_name WHERE NOT by_anchor""")
def L05_named_entities(s: SparkSession, d: str) -> DataFrame:
    nations = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    by_anchor = F.col("n_nationkey") % 2 == 0
    named = nations.select(F.when(by_anchor, "MessageType").otherwise("Provider").alias("label"), F.col("n_name").alias("name"), F.col("r_name").alias("path"), F.when(by_anchor, F.lower("n_name")).alias("anchor"))
    held = nations.join(table(s, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey", "left_semi")
    sections = held.select(F.col("r_name").alias("path"), F.lower("n_name").alias("anchor"), F.concat("r_name", F.lit("#"), F.lower("n_name")).alias("section_id"))
    return entities.named_entities(named, sections, sections.groupBy("path").agg(F.min("section_id").alias("section_id")))


TOOL_SEEDS = "seeds AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS seed_rank, CASE WHEN s_suppkey % 2 = 0 THEN 's' || s_suppkey ELSE s_name END AS seed_id, 's' || s_suppkey AS entity_id FROM supplier WHERE s_acctbal > 5000)"


def _tool_seeds(s: SparkSession, d: str) -> DataFrame:
    own = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).otherwise(F.col("s_name"))
    return table(s, d, "supplier").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("seed_rank"), own.alias("node_id"), F.lit("Tool").alias("node_label"))


@query(f"""WITH {EDGES}, {TOOL_SEEDS} SELECT seed_id, source_id AS node_id, 'Section' AS node_label FROM seeds JOIN edges ON target_id = entity_id WHERE type = 'DEFINES' ORDER BY seed_rank, source_id LIMIT (SELECT 3 * count(*) FROM seeds)""")
def KT8_expand_defines(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    return graph.expand_defines(edges, nodes, _tool_seeds(s, d)).select("seed_id", "node_id", "node_label")


CODE = f"""WITH RECURSIVE {EDGES}, {TOOL_SEEDS}, parents AS (SELECT seed_id, seed_rank, source_id AS root FROM seeds JOIN edges ON target_id = entity_id WHERE type = 'DEFINES'),
below AS (SELECT root, root AS section_id, 0 AS depth FROM (SELECT DISTINCT root FROM parents) UNION ALL SELECT root, target_id, depth + 1 FROM below JOIN edges ON source_id = section_id WHERE type = 'HAS_SUBSECTION'),
f AS (SELECT seed_id, seed_rank, depth, target_id AS node_id FROM parents JOIN below USING (root) JOIN edges ON source_id = section_id JOIN orders ON target_id = 'o' || o_orderkey WHERE type = 'CONTAINS_CODE' AND o_orderstatus = 'F'),
best AS (SELECT node_id, arg_min(seed_id, (depth, seed_rank, seed_id)) AS seed_id, min(depth) AS depth FROM f GROUP BY node_id)"""


@query(f"{CODE} SELECT seed_id, node_id, 'CodeBlock' AS node_label, depth FROM best ORDER BY depth, node_id LIMIT (SELECT 3 * count(*) FROM seeds)")
def KT9_expand_code_examples(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    return graph.expand_code_examples(edges, nodes, _tool_seeds(s, d), language="F").select("seed_id", "node_id", "node_label", "depth")


@query(f"""WITH {EDGES}, {SEEDS}, held AS (SELECT * FROM edges WHERE type = 'CONTAINS_CODE'), cap AS (SELECT 3 * count(*) AS n FROM seeds),
sib AS (SELECT DISTINCT s.node_id AS seed_id, seed_rank, b.target_id AS node_id FROM seeds s JOIN held a ON a.target_id = s.node_id JOIN held b ON a.source_id = b.source_id WHERE b.target_id <> s.node_id ORDER BY seed_rank, node_id LIMIT (SELECT n FROM cap)),
lin AS (SELECT node_id AS seed_id, seed_rank, target_id AS node_id FROM seeds JOIN edges ON source_id = node_id WHERE type = 'LINKS_TO' ORDER BY seed_rank, target_id LIMIT (SELECT n FROM cap)),
u AS (SELECT node_id, 'CodeBlock' AS node_label, -1 AS part, seed_rank AS place, NULL AS origin FROM seeds UNION ALL SELECT node_id, 'CodeBlock', 0, row_number() OVER (ORDER BY seed_rank, node_id), 'siblings:' || seed_id FROM sib UNION ALL SELECT node_id, 'Page', 1, row_number() OVER (ORDER BY seed_rank, node_id), 'links:' || seed_id FROM lin),
f AS (SELECT node_id, node_label, min(part) AS part, arg_min(place, (part, place)) AS place, CASE WHEN min(part) >= 0 THEN arg_min(origin, (part, place)) END AS origin FROM u GROUP BY ALL)
SELECT node_id, node_label, origin AS expansion_origin FROM f WHERE part < 0 UNION ALL SELECT * FROM (SELECT node_id, node_label, origin FROM f WHERE part >= 0 ORDER BY part, place, node_id LIMIT 20)""")
def KT2_expand_capped(s: SparkSession, d: str) -> DataFrame:
    edges, nodes = _graph(s, d)
    seeds = _seeds(s, d)
    found = [("siblings", graph.expand_siblings(edges, nodes, seeds)), ("links", graph.expand_targets(edges, nodes, seeds, ("LINKS_TO",)))]
    return graph.expand(seeds, found).select("node_id", "node_label", "expansion_origin")


@query("SELECT a.conv_id, a.turn AS source_turn, b.turn AS target_turn FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn < b.turn AND a.role <> b.role")
def D06_equivalent_pairs(s: SparkSession, d: str) -> DataFrame:
    blocks = table(s, d, "conversations").select(F.struct("conv_id", "turn").alias("node_id"), F.col("conv_id").alias("group_id"), F.col("turn").alias("position"), F.col("role").alias("language"))
    return graph.equivalents(blocks).select("source_id.conv_id", F.col("source_id.turn").alias("source_turn"), F.col("target_id.turn").alias("target_turn"))


@query("SELECT a.conv_id, a.turn, string_agg(DISTINCT b.role, ',' ORDER BY b.role) AS languages FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.role <> b.role GROUP BY ALL")
def D12_equivalent_languages(s: SparkSession, d: str) -> DataFrame:
    blocks = table(s, d, "conversations").select(F.col("turn").alias("node_id"), F.col("conv_id").alias("group_id"), F.col("role").alias("language"))
    return graph.equivalent_languages(blocks).select(F.col("group_id").alias("conv_id"), F.col("node_id").alias("turn"), F.nullif(F.array_join("languages", ","), F.lit("")).alias("languages")).distinct()


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def D09_edge_endpoints(s: SparkSession, d: str) -> DataFrame:
    edges = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("source_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("target_id"))
    nodes = table(s, d, "part").where("p_size <= 25").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node_id")).union(table(s, d, "supplier").where("s_acctbal > 0").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))))
    return store.checked_edges(edges, nodes).select("l_orderkey", "l_linenumber")


# ---- store --------------------------------------------------------------------------------------

@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value, min(event_id) AS first_seq FROM events GROUP BY ALL")
def E02_dedupe_last(s: SparkSession, d: str) -> DataFrame:
    return store.dedupe_last(table(s, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def E03_dedupe_first(s: SparkSession, d: str) -> DataFrame:
    return store.dedupe_first(table(s, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


STORED = "stored AS (SELECT doc_id, sha256(CASE WHEN doc_id % 4 = 0 THEN text || '!' ELSE text END) AS content_hash, lang AS context, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), incoming AS (SELECT doc_id, sha256(text) AS content_hash, n_chars + 1 AS n_chars FROM documents)"


def _versions(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(s, d, "documents")
    changed = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    labelled = table(s, d, "labels").select("doc_id").distinct()  # the documents that have been stored before
    stored = docs.join(labelled, "doc_id", "left_semi").select("doc_id", tx.content_hash(changed).alias("content_hash"), F.col("lang").alias("context"), "n_chars")
    return stored, docs.select("doc_id", tx.content_hash(F.col("text")).alias("content_hash"), (F.col("n_chars") + 1).alias("n_chars"))


@query(f"WITH {STORED} SELECT i.doc_id, CASE WHEN s.content_hash IS NULL THEN 'merge_all' WHEN s.content_hash = i.content_hash THEN 'skip_nodes' ELSE 'replace' END AS action FROM incoming i LEFT JOIN stored s USING (doc_id)")
def M04_load_decision(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _versions(s, d)
    return store.load_decision(incoming, stored, "doc_id")


@query(f"WITH {STORED} SELECT doc_id, coalesce(i.content_hash, s.content_hash) AS content_hash, context, coalesce(i.n_chars, s.n_chars) AS n_chars FROM stored s FULL OUTER JOIN incoming i USING (doc_id)")
def M02_upsert(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _versions(s, d)
    return store.upsert(stored, incoming, ["doc_id"])


@query("""WITH gone AS (SELECT 'c' || c_custkey AS id FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'o' || o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0)
SELECT 'node' AS kind, id FROM (SELECT 'c' || c_custkey AS id FROM customer UNION ALL SELECT 'o' || o_orderkey FROM orders) WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'edge', 'o' || l_orderkey || '>p' || l_partkey || '.' || l_linenumber FROM lineitem WHERE 'o' || l_orderkey NOT IN (SELECT id FROM gone)""")
def M05_subtree_delete(s: SparkSession, d: str) -> DataFrame:
    key = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    customers = table(s, d, "customer")
    nodes = customers.select(key("c", "c_custkey").alias("node_id"), key("c", "c_custkey").alias("page_id")).union(table(s, d, "orders").select(key("o", "o_orderkey"), key("c", "o_custkey")))
    edges = table(s, d, "lineitem").select(key("o", "l_orderkey").alias("source_id"), key("p", "l_partkey").alias("target_id"), "l_linenumber")
    gone = graph.subtree(nodes, customers.where("c_acctbal < 0").select(key("c", "c_custkey").alias("page_id")))
    kept, left = store.delete_subtree(nodes, edges, gone)
    return kept.select(F.lit("node").alias("kind"), F.col("node_id").alias("id")).union(left.select(F.lit("edge"), F.concat("source_id", F.lit(">"), "target_id", F.lit("."), F.col("l_linenumber").cast("string"))))


@query(f"""WITH {STORED}, st AS (SELECT doc_id, content_hash AS h FROM stored), inc AS (SELECT doc_id, content_hash AS h FROM incoming WHERE doc_id % 10 <> 9),
pg AS (SELECT i.doc_id, s.doc_id IS NOT NULL AND s.h = i.h AS kept FROM inc i LEFT JOIN st s ON i.doc_id = s.doc_id),
nd AS (SELECT 's' || doc_id AS id, CASE WHEN kept OR EXISTS (SELECT 1 FROM st WHERE st.doc_id = pg.doc_id) THEN 'c' || doc_id END AS context FROM pg UNION ALL SELECT 'x' || doc_id, CASE WHEN kept THEN 'c' || doc_id END FROM pg WHERE doc_id % 3 = 0)
SELECT 'node' AS kind, id, context FROM nd UNION ALL SELECT 'edge', 's' || doc_id || '>s' || (doc_id + 1), NULL FROM pg WHERE doc_id + 1 IN (SELECT doc_id FROM pg)""")
def M06_load_parts(s: SparkSession, d: str) -> DataFrame:
    """A stored graph, then a load of all pages of which some are new, changed or gone; sections keep their text, and so their context, other nodes of a changed page don't."""
    parts = Parts(s, f"{shared_folder(s)}/graph-{uuid.uuid4().hex}")
    stored, incoming = _versions(s, d)
    text = lambda prefix: F.concat(F.lit(prefix), F.col("doc_id").cast("string"))

    def of(docs: DataFrame, context: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
        page = F.col("doc_id").cast("string").alias("page_id")
        section = docs.select(page, text("s").alias("node_id"), F.lit("Section").alias("node_label"), F.lit("text").alias("raw_text"), context.alias("context"))
        other = docs.where("doc_id % 3 = 0").select(page, text("x").alias("node_id"), F.lit("CodeBlock").alias("node_label"), F.col("content_hash").alias("raw_text"), context.alias("context"))
        target = F.concat(F.lit("s"), (F.col("doc_id") + 1).cast("string"))
        edges = docs.select(page, F.concat(text("s"), F.lit(">"), target).alias("edge_id"), F.lit("LINKS_TO").alias("type"), text("s").alias("source_id"), target.alias("target_id"))
        return docs.select(page, "content_hash"), section.unionByName(other), edges

    load.load(parts, *of(stored, text("c")))
    load.load(parts, *of(incoming.where("doc_id % 10 <> 9"), F.lit(None).cast("string")), whole=True, carried=("context",))
    nodes, edges = load.graph(parts)
    return nodes.select(F.lit("node").alias("kind"), F.col("node_id").alias("id"), "context").unionByName(edges.select(F.lit("edge").alias("kind"), F.col("edge_id").alias("id"), F.lit(None).cast("string").alias("context")))


@query("SELECT d.doc_id, d.lang, coalesce(l.quality::VARCHAR, d.source) AS source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def M09_write_properties(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "documents").select("doc_id", "lang", "source")
    return store.write_properties(nodes, table(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("source")), ["doc_id"])


NAMED = """nodes AS (SELECT 'nation:' || n_nationkey AS node_id, '/n/' || n_nationkey AS url, n_name AS name, left(n_name, 3) AS key, n_regionkey AS payload FROM nation
 UNION ALL SELECT 'region:' || r_regionkey, NULL, r_name, '/n/' || r_regionkey, -1 FROM region UNION ALL SELECT 'part:' || p_partkey, '/p/' || p_partkey, p_brand, p_type, p_size FROM part),
asked AS (SELECT 's' || s_suppkey AS asked_by, n_name AS ref FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 'u' || s_suppkey, '/n/' || s_nationkey FROM supplier UNION ALL SELECT 'i' || s_suppkey, 'part:' || s_suppkey FROM supplier UNION ALL SELECT 'x' || s_suppkey, s_name FROM supplier)"""


@query(f"WITH {NAMED} SELECT DISTINCT asked_by, ref, node_id, payload FROM asked JOIN nodes ON ref = node_id OR ref = url OR ref = name OR ref = key")
def A12_hydrate_any_key(s: SparkSession, d: str) -> DataFrame:
    c, none = F.col, F.lit(None).cast("string")
    text = lambda prefix, k: F.concat(F.lit(prefix), c(k).cast("string"))
    row = lambda df, *columns: df.select(*[x.alias(n) for x, n in zip(columns, ("node_id", "url", "name", "key", "payload"), strict=True)])
    nation, supplier = table(s, d, "nation"), table(s, d, "supplier")
    nodes = row(nation, text("nation:", "n_nationkey"), text("/n/", "n_nationkey"), c("n_name"), F.substring("n_name", 1, 3), c("n_regionkey"))
    nodes = nodes.unionByName(row(table(s, d, "region"), text("region:", "r_regionkey"), none, c("r_name"), text("/n/", "r_regionkey"), F.lit(-1))).unionByName(row(table(s, d, "part"), text("part:", "p_partkey"), text("/p/", "p_partkey"), c("p_brand"), c("p_type"), c("p_size")))
    ask = lambda df, prefix, ref: df.select(text(prefix, "s_suppkey").alias("asked_by"), ref.alias("ref"))
    named = supplier.join(nation, c("s_nationkey") == c("n_nationkey"))
    asked = ask(named, "s", c("n_name")).unionByName(ask(supplier, "u", text("/n/", "s_nationkey"))).unionByName(ask(supplier, "i", text("part:", "s_suppkey"))).unionByName(ask(supplier, "x", c("s_name")))
    return store.hydrated_by_key(asked, nodes, ["payload"], "ref").select("asked_by", "ref", "node_id", "payload")


@query("""WITH nodes AS (SELECT 'c' || c_custkey AS id, 'Customer' AS label FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'n' || n_nationkey, 'Nation' FROM nation UNION ALL SELECT 'n' || n_nationkey, 'Nation' FROM nation WHERE n_regionkey = 2),
edges AS (SELECT 'PLACED_' || o_orderstatus AS type, 'c' || o_custkey AS target FROM orders UNION ALL SELECT 'LOCATED', CASE WHEN s_acctbal >= 0 THEN 'n' || s_nationkey END FROM supplier),
lim(name, lo, hi) AS (VALUES ('Nation', 20, 29), ('Customer', 1000000, NULL), ('Tool', 3, 3), ('LOCATED', 1, NULL)),
counts AS (SELECT name, sum(n)::BIGINT AS n FROM (SELECT label AS name, 1 AS n FROM nodes UNION ALL SELECT type, 1 FROM edges UNION ALL SELECT name, 0 FROM lim) GROUP BY name)
SELECT 'count' AS "check", c.name, n, coalesce(n >= lo, true) AND coalesce(n <= hi, true) AS passed FROM counts c LEFT JOIN lim USING (name)
UNION ALL SELECT 'duplicate', label, sum((k > 1)::INT)::BIGINT, sum((k > 1)::INT) = 0 FROM (SELECT label, id, count(*) AS k FROM nodes GROUP BY ALL) GROUP BY label
UNION ALL SELECT 'required', r, (r IN (SELECT id FROM nodes))::BIGINT, r IN (SELECT id FROM nodes) FROM (VALUES ('n3'), ('c-1')) t(r)
UNION ALL SELECT 'dangling', type, sum(bad)::BIGINT, sum(bad) = 0 FROM (SELECT type, (starts_with(type, 'PLACED') AND target NOT IN (SELECT id FROM nodes))::INT AS bad FROM edges) GROUP BY type
UNION ALL SELECT 'untargeted', type, sum((target IS NULL)::INT)::BIGINT, sum((target IS NULL)::INT) = 0 FROM edges GROUP BY type""")
def P05_graph_audit(s: SparkSession, d: str) -> DataFrame:
    key = lambda prefix, column: F.concat(F.lit(prefix), F.col(column).cast("string"))
    node = lambda df, prefix, column, label: df.select(key(prefix, column).alias("node_id"), F.lit(label).alias("node_label"))
    nation = table(s, d, "nation")
    nodes = node(table(s, d, "customer").where("c_acctbal >= 0"), "c", "c_custkey", "Customer").unionByName(node(nation.select("n_nationkey", "n_regionkey").withColumn("n_nationkey", F.explode(F.array_repeat("n_nationkey", F.when(F.col("n_regionkey") == 2, 2).otherwise(1)))), "n", "n_nationkey", "Nation"))
    edges = table(s, d, "orders").select(F.concat(F.lit("PLACED_"), "o_orderstatus").alias("type"), key("c", "o_custkey").alias("target_id"))
    edges = edges.unionByName(table(s, d, "supplier").select(F.lit("LOCATED").alias("type"), F.when(F.col("s_acctbal") >= 0, key("n", "s_nationkey")).alias("target_id")))
    return audit.one_pass(nodes, edges, {"Nation": (20, 29), "Customer": (1_000_000, None), "Tool": (3, 3), "LOCATED": (1, None)}, ("n3", "c-1"), ("PLACED_O", "PLACED_F", "PLACED_P"))


# ---- entities -----------------------------------------------------------------------------------

@query(r"SELECT doc_id, m.name FROM documents, (SELECT DISTINCT lower(n_name) AS name FROM nation UNION SELECT unnest(['the', 'idiot', 'v1.0', 'License', 'example.com'])) m WHERE regexp_matches(text, '(^|[^A-Za-z0-9_])' || regexp_escape(m.name) || '([^A-Za-z0-9_]|$)')")
def D07_mentions(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "nation").select(F.lower("n_name").alias("name")).union(s.range(1).select(F.explode(F.array(*map(F.lit, ["the", "idiot", "v1.0", "License", "example.com"])))))
    sections = table(s, d, "documents").select(F.col("doc_id").alias("section_id"), F.lit("").alias("breadcrumb"), "text")
    return entities.mentions(sections, names).select(F.col("section_id").alias("doc_id"), "name")


RULE_ROWS = """found AS (SELECT CASE WHEN p_size > 40 THEN 'Tool' ELSE 'Hook' END AS label, p_brand AS name, p_type AS description, p_partkey AS seq FROM part WHERE (p_size > 40 AND starts_with(p_type, 'STANDARD')) OR (p_size <= 10 AND starts_with(p_type, 'PROMO')))"""


def _rule_rows(s: SparkSession, d: str) -> DataFrame:
    """Parts as table rows: their first type word is the header, their size gives page and anchor."""
    page = F.when(F.col("p_size") > 40, "tools").when(F.col("p_size") <= 10, "hooks").otherwise("other")
    rows = table(s, d, "part").select(F.col("p_partkey").cast("string").alias("node_id"), F.concat(page, F.lit("#a")).alias("section_id"), page.alias("path"), F.lit(0).alias("table_position"), F.col("p_partkey").cast("int").alias("position"), F.array(F.lower(F.element_at(F.split("p_type", " "), 1)), F.lit("x")).alias("headers"), F.array(F.concat(F.lit("`"), "p_brand", F.lit("`")), F.col("p_type"), F.lit("")).alias("cells"))
    rules = s.createDataFrame([(0, "tools", None, ["standard"], "Tool", "row"), (1, "hooks", "a", ["promo"], "Hook", "section")], entities.RULE_SCHEMA)
    return entities.from_rows(rows, rules)


@query(f"WITH {RULE_ROWS} SELECT label || ':' || name AS entity_id, label, name, arg_min(description, seq) AS description FROM found GROUP BY label, name")
def L07_entity_catalogue(s: SparkSession, d: str) -> DataFrame:
    return entities.catalogue(_rule_rows(s, d)).select("entity_id", "label", "name", "description")


@query(f"WITH {RULE_ROWS}, e AS (SELECT DISTINCT CASE WHEN label = 'Tool' THEN seq::VARCHAR ELSE 'hooks#a' END AS source_id, label || ':' || name AS target_id FROM found) SELECT 'DEFINES' AS type, source_id, target_id, left(sha256('DEFINES|' || source_id || '|' || target_id || '|'), 16) AS id FROM e")
def L09_defines_edges(s: SparkSession, d: str) -> DataFrame:
    return entities.defines(_rule_rows(s, d))


# ---- pages: links, headers ----------------------------------------------------------------------

HREFS = """raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS nth FROM pages),
known AS (SELECT DISTINCT lower(regexp_replace(h, '[.,]', '', 'g')) AS name FROM (SELECT ltrim(href, '/') AS h FROM raw WHERE page_id % 2 = 0))"""


def _page_links(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", "url", F.posexplode(parse.html_links(F.col("html"))).alias("nth", "href"))


def _resolved(s: SparkSession, d: str) -> DataFrame:
    """Menu links against pages named by the menu words of the even pages; every third link points outside, every fifth to an anchor."""
    n = F.col("page_id") * 31 + F.col("nth")
    name = F.regexp_replace(F.regexp_replace("href", "(?s)^.", ""), "[.,]", "")
    href = F.when(n % 3 == 0, F.concat(F.lit("https://elsewhere.example.net/"), name)).when(n % 5 == 0, F.concat(F.lit("/docs/"), name, F.lit("#Part One"))).otherwise(F.concat(F.lit("../"), name))
    links = _page_links(s, d).select(n.alias("link_id"), F.concat(F.lit("en/p"), F.col("page_id").cast("string"), F.lit(".md")).alias("path"), F.col("page_id").alias("section_id"), href.alias("href"), F.lit("").alias("text"), F.lit("prose").alias("source_kind"))
    names = _page_links(s, d).where("page_id % 2 = 0").select(F.concat(F.regexp_replace(F.regexp_replace("href", "(?s)^.", ""), "[.,]", ""), F.lit(".md")).alias("path")).distinct()
    pages = names.select("path", F.concat(F.lit("https://site.example.org/docs/"), "path").alias("url"))
    sections = pages.where(F.length("path") % 2 == 0).select(F.concat_ws("#", "url", F.lit("part-one")).alias("section_id"), F.col("url").alias("page_url"), F.lit("part-one").alias("anchor"), F.lit(0).alias("position"))
    return resolve.resolve(links, pages, sections, "site.example.org")


RESOLVED = """n AS (SELECT page_id, page_id * 31 + nth AS link_id, regexp_replace(substr(href, 2), '[.,]', '', 'g') AS name FROM raw),
names AS (SELECT DISTINCT name || '.md' AS path FROM n WHERE page_id % 2 = 0),
kinds AS (SELECT *, CASE WHEN link_id % 3 = 0 THEN 'external' WHEN link_id % 5 = 0 THEN 'anchor' ELSE 'page' END AS kind FROM n),
r AS (SELECT link_id, kind, CASE WHEN kind <> 'external' THEN 'https://site.example.org/docs/' || p.path END AS page_url, length(p.path) AS len, name FROM kinds LEFT JOIN names p ON p.path = name || '.md'),
res AS (SELECT link_id, CASE WHEN kind = 'external' THEN 'external' WHEN page_url IS NULL THEN 'unresolved' WHEN kind = 'page' THEN 'page' WHEN len % 2 = 0 THEN 'section' ELSE 'unresolved' END AS status,
 CASE WHEN kind <> 'external' AND page_url IS NULL THEN 'page' WHEN kind = 'anchor' AND len % 2 <> 0 THEN 'anchor' END AS reason, page_url, CASE WHEN kind = 'anchor' AND len % 2 = 0 THEN page_url || '#part-one' END AS target_section_id, kind, name FROM r)"""


@query(f"WITH {HREFS} SELECT page_id, nth, href FROM raw")
def B36_link_extract(s: SparkSession, d: str) -> DataFrame:
    return _page_links(s, d).select("page_id", F.col("nth").cast("long").alias("nth"), "href")


@query(f"WITH {HREFS}, {RESOLVED} SELECT link_id, status, reason, page_url, target_section_id FROM res")
def D05_link_resolve(s: SparkSession, d: str) -> DataFrame:
    return _resolved(s, d).select("link_id", "status", "reason", "page_url", "target_section_id")


@query(f"WITH {HREFS}, {RESOLVED} SELECT reason, count(*) AS n, count(page_url) AS n_pages FROM res WHERE status = 'unresolved' GROUP BY reason")
def D05_unresolved_links(s: SparkSession, d: str) -> DataFrame:
    return resolve.unresolved(_resolved(s, d)).groupBy("reason").agg(F.count("*").alias("n"), F.count("target_page_url").alias("n_pages"))


@query(f"WITH {HREFS}, {RESOLVED} SELECT (link_id - link_id % 31) // 31 AS section_id, string_agg(DISTINCT 'https://elsewhere.example.net/' || name, ' ' ORDER BY 'https://elsewhere.example.net/' || name) AS links FROM res WHERE kind = 'external' GROUP BY 1")
def E01_external_links(s: SparkSession, d: str) -> DataFrame:
    return resolve.external_links(_resolved(s, d)).select("section_id", F.array_join("external_links", " ").alias("links"))


@query(f"WITH {HREFS}, {RESOLVED}, e AS (SELECT DISTINCT CASE WHEN kind = 'anchor' THEN 'LINKS_TO' ELSE 'LINKS_TO_PAGE' END AS type, link_id // 31 AS source_id, coalesce(target_section_id, page_url) AS target_id FROM res WHERE status IN ('page', 'section')) SELECT type, count(*) AS n, 0::BIGINT AS n_null FROM e GROUP BY type")
def P04_edge_counts(s: SparkSession, d: str) -> DataFrame:
    resolved = _resolved(s, d).withColumn("section_id", F.col("section_id").cast("string"))
    sections = s.createDataFrame([], "section_id string, page_url string, position int")
    return audit.counts(resolve.link_edges(resolved, sections))


@query("""WITH p AS (SELECT DISTINCT doc_id, 'https://s.example/docs/d' || doc_id || '.md' AS u FROM documents),
e AS (SELECT 'HAS_SECTION' AS type, u AS source_id, u || '#a' AS target_id, NULL AS href FROM p UNION ALL SELECT 'HAS_SECTION', u, u || '#b', NULL FROM p UNION ALL SELECT 'HAS_SUBSECTION', u || '#b', u || '#sub', NULL FROM p
 UNION ALL SELECT 'CONTAINS_CODE', u || '#a', left(sha256(u || '#a|0|code-py'), 16), NULL FROM p UNION ALL SELECT 'CONTAINS_CODE', u || '#a', left(sha256(u || '#a|1|code-ts'), 16), NULL FROM p
 UNION ALL SELECT 'CONTAINS_TABLE_ROW', u || '#sub', left(sha256(u || '#sub|0|row'), 16), NULL FROM p UNION ALL SELECT 'CONTAINS_CALLOUT', u || '#sub', left(sha256(u || '#sub|0|callout-tip'), 16), NULL FROM p
 UNION ALL SELECT 'EQUIVALENT_TO', left(sha256(u || '#a|0|code-py'), 16), left(sha256(u || '#a|1|code-ts'), 16), NULL FROM p
 UNION ALL SELECT 'LINKS_TO', u || '#a', u || '#b', '#b' FROM p UNION ALL SELECT 'LINKS_TO_PAGE', a.u || '#a', b.u, 'd' || b.doc_id || '.md' FROM p a JOIN p b ON b.doc_id = a.doc_id + 1
 UNION ALL SELECT 'NAVIGATES_TO', a.u || '#a', b.u || '#a', '/docs/d' || b.doc_id || '.md' FROM p a JOIN p b ON b.doc_id = a.doc_id + 2 UNION ALL SELECT 'NAVIGATES_TO', a.u || '#a', b.u || '#sub', './d' || b.doc_id || '.md#sub' FROM p a JOIN p b ON b.doc_id = a.doc_id + 2)
SELECT DISTINCT * FROM e""")
def P04_built_graph(s: SparkSession, d: str) -> DataFrame:
    """All edges of the graph of pages that hold sections, a code group, a navigation table and a data table, a callout, and links to pages, sections and themselves."""
    c = lambda n: (F.col("doc_id") + n).cast("string")
    text = F.concat(
        F.lit("# T\n\n## A\n\nSee [n](d"), c(1), F.lit(".md), [b](#b), [self](#a) and [gone](#nowhere).\n\n<CodeGroup>\n```py\nx\n```\n~~~~ts\ny\n~~~~\n</CodeGroup>\n\n| Topic | Where |\n|---|---|\n| [t](/docs/d"), c(2), F.lit(".md) | [u](./d"), c(2),
        F.lit(".md#sub) |\n\n## B\n\n"), F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", " ")), F.lit("\n\n### Sub\n\n| Tool | What |\n|---|---|\n| a | b |\n\n<Tip>t</Tip>\n"),
    )
    pages = table(s, d, "documents").select(F.concat(F.lit("d"), c(0), F.lit(".md")).alias("path"), text.alias("text"))
    built = build(pages, s.createDataFrame([], "url string, description string"), "s.example", "https://s.example/docs/")
    return built.edges.select("type", "source_id", "target_id", "href")


@query("""WITH p AS (SELECT doc_id, 'd' || doc_id || '.md' AS path, 'u/d' || doc_id || '.md' AS url, '# T ' || source || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '> about ' || lang || chr(10) ELSE '' END || '## Text' || chr(10) || text AS text FROM documents),
i AS (SELECT DISTINCT doc_id FROM labels)
SELECT path, url, 'T ' || p_source.source AS title, CASE WHEN i.doc_id IS NOT NULL THEN 'labelled ' || i.doc_id WHEN p.doc_id % 2 = 0 THEN 'about ' || p_source.lang ELSE '' END AS description,
 CASE WHEN i.doc_id IS NOT NULL THEN 'index' WHEN p.doc_id % 2 = 0 THEN 'blockquote' ELSE 'missing' END AS description_source, starts_with(path, 'd1') AS volatile, sha256(text) AS content_hash
FROM p JOIN (SELECT doc_id, source, lang FROM documents) p_source USING (doc_id) LEFT JOIN i ON p.doc_id = i.doc_id""")
def B20_page_header(s: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md"))
    quote = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("> about "), "lang", F.lit("\n"))).otherwise("")
    pages = table(s, d, "documents").select(path.alias("path"), F.concat(F.lit("# T "), "source", F.lit("\n\n"), quote, F.lit("## Text\n"), "text").alias("text"))
    index = table(s, d, "labels").select(F.concat(F.lit("u/"), path).alias("url"), F.concat(F.lit("labelled "), F.col("doc_id").cast("string")).alias("description")).distinct()
    return parse.page_header(pages, index, ("d1",), "u/")


@query(r"""WITH p AS (SELECT item_id AS line_no, '- [x](https://e.org/' || item_id % 25 || '): ' || regexp_replace(text, '\s+', ' ', 'g') AS line FROM benchmark) SELECT regexp_extract(line, '^\s*-\s*\[[^\]]*\]\(([^)\s]+)\):\s*(.+?)\s*$', 1) AS url, arg_max(regexp_extract(line, '^\s*-\s*\[[^\]]*\]\(([^)\s]+)\):\s*(.+?)\s*$', 2), line_no) AS description FROM p GROUP BY 1""")
def A03_link_descriptions(s: SparkSession, d: str) -> DataFrame:
    from tessera.sources.records import link_descriptions

    line = F.concat(F.lit("- [x](https://e.org/"), (F.col("item_id") % 25).cast("string"), F.lit("): "), F.regexp_replace("text", r"\s+", " "))
    return link_descriptions(table(s, d, "benchmark").select(F.col("item_id").alias("line_no"), line.alias("line")))


# ---- Markdown structure, on documents whose lines are given marks -------------------------------

MARKDOWN = """mdl AS (SELECT 'd' || doc_id || '.md' AS path, i AS pos, CASE WHEN i % 17 = 0 THEN '# ' || PLAIN(20) WHEN i % 9 = 1 THEN '## ' || PLAIN(30) WHEN i % 9 = 3 THEN '### ' || PLAIN(10)
  WHEN i % 9 = 4 THEN ['```py', '~~~', '````md', '```js'][(i // 9) % 4 + 1] WHEN i % 36 = 23 THEN '```' WHEN i % 9 = 6 THEN ['```', '~~~~', '````', '~~~'][(i // 9) % 4 + 1] WHEN i % 9 = 8 THEN l || ' [see](/docs/d' || doc_id || '.md#x)' ELSE l END AS line
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)),
marks AS (SELECT path, pos, regexp_extract(line, '^[ \\t]*(`{3,}|~{3,})(.*)$', 1) AS run, trim(regexp_extract(line, '^[ \\t]*(`{3,}|~{3,})(.*)$', 2)) AS info, row_number() OVER (PARTITION BY path ORDER BY pos) AS k FROM mdl WHERE regexp_matches(line, '^[ \\t]*(```|~~~)')),
states AS (SELECT DISTINCT path, CAST(0 AS BIGINT) AS k, CAST(-1 AS BIGINT) AS pos, '' AS was, '' AS open FROM marks
 UNION ALL SELECT m.path, m.k, m.pos, open, CASE WHEN open = '' AND NOT (starts_with(run, '`') AND contains(info, '`')) THEN run WHEN open <> '' AND starts_with(run, open) AND info = '' THEN '' ELSE open END FROM states s JOIN marks m ON m.path = s.path AND m.k = s.k + 1),
turns AS (SELECT *, sum(CASE WHEN was = '' AND open <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY k) AS fence_no FROM states),
fe AS (SELECT m.path, m.pos, m.line, t.pos = m.pos AND (was = '') <> (open = '') AS mark, coalesce(open <> '' OR (t.pos = m.pos AND was <> ''), false) AS fence, fence_no FROM mdl m ASOF LEFT JOIN turns t ON m.path = t.path AND m.pos >= t.pos),
lv AS (SELECT *, CASE WHEN fence THEN 0 ELSE length(regexp_extract(line, '^ {0,3}(#{1,6})\\s+\\S', 1)) END AS level FROM fe)""".replace("\\\\", "\\").replace("PLAIN(", "left(regexp_replace(l, '[^A-Za-z0-9 ]', '', 'g'), ")
#: The same lines in sections: their headings, anchors, ids and the sections above them.
OUTLINE = rf"""hd AS (SELECT path, pos, level, trim(regexp_replace(trim(line), '^#+\s+', '')) AS heading FROM lv WHERE level > 0),
fi AS (SELECT path, min(CASE WHEN level >= 2 THEN pos END) AS first, min(CASE WHEN level = 0 AND trim(line) <> '' THEN pos END) AS content FROM lv GROUP BY path),
ti AS (SELECT fi.path, coalesce(arg_min(heading, pos) FILTER (level = 1), fi.path) AS title FROM fi LEFT JOIN hd ON fi.path = hd.path GROUP BY fi.path),
al AS (SELECT * FROM hd WHERE level >= 2 UNION ALL SELECT path, -1, 2, 'Overview' FROM fi WHERE first IS NULL OR content < first),
ba AS (SELECT *, coalesce(nullif({SLUG.format("heading")}, ''), 'section') AS base FROM al),
an AS (SELECT *, row_number() OVER (PARTITION BY path, base ORDER BY pos) - 1 AS nth, row_number() OVER (PARTITION BY path ORDER BY pos) - 1 AS position, max(CASE WHEN level = 2 THEN pos END) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM ba),
se AS (SELECT a.*, a.base || CASE WHEN a.nth > 0 THEN '-' || a.nth ELSE '' END AS anchor, CASE WHEN a.level = 3 THEN a.path || '#' || p.base || CASE WHEN p.nth > 0 THEN '-' || p.nth ELSE '' END END AS parent_id, title || CASE WHEN a.level = 3 AND p.heading IS NOT NULL THEN ' > ' || p.heading ELSE '' END || ' > ' || a.heading AS breadcrumb
 FROM an a JOIN ti USING (path) LEFT JOIN an p ON p.path = a.path AND p.pos = a.above)"""


def _markdown(s: SparkSession, d: str) -> DataFrame:
    plain = lambda l, n: F.substring(F.regexp_replace(l, "[^A-Za-z0-9 ]", ""), 1, n)
    of = lambda i, *marks: F.element_at(F.array(*map(F.lit, marks)), (F.floor(i / 9) % 4 + 1).cast("int"))

    def mark(l: Column, i: Column) -> Column:
        return (
            F.when(i % 17 == 0, F.concat(F.lit("# "), plain(l, 20))).when(i % 9 == 1, F.concat(F.lit("## "), plain(l, 30))).when(i % 9 == 3, F.concat(F.lit("### "), plain(l, 10)))
            .when(i % 9 == 4, of(i, "```py", "~~~", "````md", "```js")).when(i % 36 == 23, "```").when(i % 9 == 6, of(i, "```", "~~~~", "````", "~~~"))
            .when(i % 9 == 8, F.concat(l, F.lit(" [see](/docs/d"), F.col("doc_id").cast("string"), F.lit(".md#x)"))).otherwise(l)
        )

    return table(s, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.array_join(F.transform(F.split("text", "\n"), mark), "\n").alias("text"))


@query(f"""WITH RECURSIVE {MARKDOWN}, {OUTLINE}
SELECT path, CAST(pos AS INTEGER) AS pos, CAST(position AS INTEGER) AS position, CAST(level AS INTEGER) AS level, heading, anchor, path || '#' || anchor AS section_id, parent_id, breadcrumb, false AS synthesized FROM se""")
def B23_sections(s: SparkSession, d: str) -> DataFrame:
    """Pages with fences of other marks, longer ones around shorter ones, and ones that end with the page."""
    return parse.sections(_markdown(s, d))


@query(f"""WITH RECURSIVE {MARKDOWN}, {OUTLINE}, b AS (SELECT path, fence_no, min(pos) AS pos, arg_min(regexp_extract(line, '^\\s*(?:`{{3,}}|~{{3,}})\\s*([^\\s`{{]*)', 1), pos) AS language, coalesce(string_agg(CASE WHEN NOT mark THEN line END, chr(10) ORDER BY pos), '') AS text FROM lv WHERE fence GROUP BY path, fence_no),
of AS (SELECT b.*, se.path || '#' || anchor AS section_id, row_number() OVER (PARTITION BY se.path, anchor ORDER BY b.pos) - 1 AS position FROM b ASOF JOIN se ON b.path = se.path AND b.pos >= se.pos)
SELECT left(sha256(section_id || '|' || position || '|code-' || language), 16) AS node_id, path, section_id, CAST(pos AS INTEGER) AS pos, CAST(position AS INTEGER) AS position, language, rtrim(text, chr(10)) AS text, CAST(NULL AS VARCHAR) AS group_id FROM of""".replace("\\\\", "\\"))
def B30_code_blocks(s: SparkSession, d: str) -> DataFrame:
    _, placed = parse.located(_markdown(s, d))
    return parse.code_blocks(placed).drop("preceding")


@query(r"""SELECT doc_id, coalesce(source, '') || chr(10) || chr(10) || trim('Intro ' || l) || chr(10) || chr(10) || 'end' AS text, trim('Mind ' || coalesce(lang, '')) AS callout, 'x = 1' || chr(10) || '  y' AS code, 'Step_' || doc_id AS href
FROM (SELECT *, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^A-Za-z ]', ' ', 'g'), ' +', ' ', 'g')) AS l FROM documents)""")
def B05_component_pages(s: SparkSession, d: str) -> DataFrame:
    """Each text in nested components, with a dropped one, an export, a callout, a fenced block and a link in a table: what is left of the page."""
    c, blank = F.col, lambda x: F.coalesce(F.col(x), F.lit(""))
    plain = F.trim(F.regexp_replace(F.regexp_replace(blank("text"), "[^A-Za-z ]", " "), " +", " "))
    text = F.concat(
        F.lit("# T\n\nexport const W = ({a = '}'}) => {\nreturn (\n<p>{a}</p>\n);\n};\n<Steps>\n  <Step title={`"), blank("source"), F.lit("`}>\n    Intro "), plain, F.lit("\n\n    <Note>\n      Mind <b>"), blank("lang"),
        F.lit("</b>\n    </Note>\n\n    ````py\n    x = 1\n      y\n    ````\n\n    | Tool |\n    |---|\n    | [t](Step_"), c("doc_id").cast("string"), F.lit(") |\n  </Step>\n</Steps>\n<Hero big>\n  <b>gone</b>\n</Hero>\n\nend\n"),
    )
    placed = parse.read(table(s, d, "documents").select(c("doc_id").cast("string").alias("path"), text.alias("text")), parts=("texts", "callouts", "blocks", "links"))
    texts = parse.section_text(placed).select(F.regexp_replace("section_id", "#.*", "").alias("path"), "text")
    joined = texts.join(parse.callouts(placed).select("path", c("text").alias("callout")), "path").join(parse.code_blocks(placed).select("path", c("text").alias("code")), "path").join(parse.links(placed).select("path", "href"), "path")
    return joined.select(c("path").cast("long").alias("doc_id"), "text", "callout", "code", "href")


@query(f"""WITH RECURSIVE {MARKDOWN} SELECT path, CAST(pos AS INTEGER) AS pos, unnest(regexp_extract_all(line, '\\[([^\\[\\]]*)\\]\\(([^)\\s]*)\\)', 2)) AS href FROM lv WHERE NOT fence AND level = 0 AND NOT regexp_matches(line, '^\\s*>')""".replace("\\\\", "\\"))
def B36_markdown_links(s: SparkSession, d: str) -> DataFrame:
    _, placed = parse.located(_markdown(s, d))
    return parse.links(placed).select("path", "pos", "href")


@query(r"""WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(trim(text), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS rows FROM documents),
u AS (SELECT doc_id, rows, list_filter(rows, lambda x: len(regexp_split_to_array(x, '\s+')) >= 5 AND regexp_matches(x, '[A-Za-z]')) AS prose FROM t)
SELECT doc_id, coalesce(len(rows) > 0 AND len(list_filter(rows[:2], lambda x: regexp_matches(x, '^[/$>{\[|#<]'))) = 0 AND len(prose) / len(rows) >= 0.6 AND len(list_filter(prose, lambda x: regexp_matches(x, '[.!?](\s|$)'))) > 0, false) AS prose FROM u""")
def B31_prose_code(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", parse.looks_like_prose(F.col("text")).alias("prose"))


@query("""SELECT p_partkey, contains(p_type, 'STEEL') AS data, round((CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END) / 2.0::DOUBLE, 1) >= 0.5 AND NOT contains(p_type, 'STEEL') AS navigates FROM part""")
def B33_navigation_tables(s: SparkSession, d: str) -> DataFrame:
    link = lambda k: F.when(F.col("p_size") % k == 0, F.concat(F.lit("[x](/p"), F.col("p_size").cast("string"), F.lit(")"))).otherwise("plain")
    data = F.contains("p_type", F.lit("STEEL"))
    text = F.concat(F.lit("## T\n\n| "), F.when(data, "Tool").otherwise("Topic"), F.lit(" | More |\n|---|:--|\n| "), link(2), F.lit(" | "), link(3), F.lit(" |\n"))
    pages = table(s, d, "part").select(F.col("p_partkey").cast("string").alias("path"), text.alias("text"), data.alias("data"))
    _, placed = parse.located(pages.drop("data"))
    return parse.tables(placed).join(pages.select("path", "data"), "path").select(F.col("path").cast("long").alias("p_partkey"), "data", "navigates")


# ---- aggregates and audits ----------------------------------------------------------------------

@query("SELECT lang, count(*) AS n, round(100.0 * count(*) FILTER (text LIKE '%the%') / count(*), 1) AS boilerplate, round(100.0 * count(*) FILTER (starts_with(text, 'The ')) / count(*), 1) AS opener FROM documents GROUP BY lang")
def E10_boilerplate_rates(s: SparkSession, d: str) -> DataFrame:
    return audit.rates(table(s, d, "documents"), "lang", {"boilerplate": F.contains("text", F.lit("the")), "opener": F.startswith("text", F.lit("The "))})


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def E11_label_source_counts(s: SparkSession, d: str) -> DataFrame:
    return audit.group_counts(table(s, d, "documents"), "lang", "source")


@query("""WITH p AS (SELECT a.label, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) SELECT label, count(*) AS n, round(avg(c), 6) AS mean, round(quantile_cont(c, 0.5), 6) AS median FROM p GROUP BY label""")
def E12_pair_cosines(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))  # each vector with the next
    return e.join(b, "vec_id").withColumn("c", cosine(F.col("embedding"), F.col("other"))).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("c"), 6).alias("mean"), F.round(F.median("c"), 6).alias("median"))


@query("SELECT len(embedding) AS dimensions, count(*) AS n, round(avg(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS mean_norm FROM embeddings GROUP BY 1")
def E13_dimension_histogram(s: SparkSession, d: str) -> DataFrame:
    from tessera.functions.vectors import norm

    return table(s, d, "embeddings").groupBy(F.size("embedding").cast("long").alias("dimensions")).agg(F.count("*").alias("n"), F.round(F.avg(norm(F.col("embedding"))), 6).alias("mean_norm"))


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def E17_duplicate_keys(s: SparkSession, d: str) -> DataFrame:
    return audit.duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def P06_orphans(s: SparkSession, d: str) -> DataFrame:
    used = table(s, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return audit.orphans(table(s, d, "part").select("p_partkey"), used, "p_partkey")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def H07_set_difference(s: SparkSession, d: str) -> DataFrame:
    return audit.missing(table(s, d, "documents"), table(s, d, "labels"), "doc_id")


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def H08_set_intersection(s: SparkSession, d: str) -> DataFrame:
    return audit.common(table(s, d, "documents"), table(s, d, "labels"), "doc_id")


@query(r"""WITH p AS (SELECT page_id, regexp_replace(html, '`[^`]*`', '', 'g') AS t FROM pages) SELECT page_id, regexp_matches(t, '<!--') OR regexp_matches(t, '</?[A-Z][A-Za-z]*') OR regexp_matches(t, '(?m)^\s*export\s+(const|function|default)') OR regexp_matches(t, 'theme=\{') OR regexp_matches(t, '</?(div|span|img|p)\b') AS leaks FROM p""")
def P02_markup_leaks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pages").select("page_id", audit.leaks(F.col("html")).alias("leaks"))


@query("WITH a AS (SELECT doc_id, lang FROM documents), b AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'xx' ELSE lang END AS lang FROM documents) SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def P07_same_rows(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "documents").select("doc_id", "lang")
    return audit.same_rows(a, a.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "xx").otherwise(F.col("lang"))))


@query("SELECT conv_id, turn, role, array_to_string(list_filter(['the', 'license', 'with', 'zzz'], lambda p: contains(lower(text), p)), ',') AS hits, string_split(text, ':')[1] AS head FROM conversations")
def I18_phrase_hits(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "conversations").select("conv_id", "turn", "role", F.array_join(audit.hits(F.col("text"), ["the", "license", "with", "zzz"]), ",").alias("hits"), F.element_at(F.split("text", ":"), 1).alias("head"))


@query("SELECT query_id, string_agg(DISTINCT lower(t), ',' ORDER BY lower(t)) AS kept FROM (SELECT item_id AS query_id, unnest(['language=' || item_id, 'page_path_prefix=en', 'Other=x']) AS t FROM benchmark) WHERE split_part(t, '=', 1) IN ('language', 'page_path_prefix') GROUP BY query_id")
def C04_allowed_filters(s: SparkSession, d: str) -> DataFrame:
    given = F.create_map(F.lit("language"), F.col("item_id").cast("string"), F.lit("page_path_prefix"), F.lit("en"), F.lit("Other"), F.lit("x"))
    kept = search.allowed_filters(given)
    return table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("kept"))


# ---- whole plans, without SQL: tests hold their parts -------------------------------------------

@query()
def QA_answer_batch(s: SparkSession, d: str) -> DataFrame:
    from tessera.plans import models, qa

    docs = table(s, d, "documents")
    label = F.element_at(F.array(*map(F.lit, ("Section", "CodeBlock", "TableRow", "Callout"))), (F.col("doc_id") % 4 + 1).cast("int"))
    nodes = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("node_id"), label.alias("node_label"), F.col("text").alias("indexed_text"), F.lit("").alias("raw_text"), models.embed(F.col("text")).alias("embedding"), F.concat(F.lit("/"), "source").alias("url"), F.lit("").alias("anchor"), F.col("source").alias("breadcrumb"), F.lit("").alias("title"))
    named = table(s, d, "nation").select(F.concat(F.lit("Tool:"), "n_name").alias("node_id"), F.lit("Tool").alias("label"), F.col("n_name").alias("name"))
    asked = table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return qa.answer(nodes, named, asked).select("query_id", "answer", F.size("citations").alias("n_citations"), "no_results")


@query()
def EN_enrich_nodes(s: SparkSession, d: str) -> DataFrame:
    from tessera.plans import enrich

    c, none = F.col, F.array().cast("array<string>")
    p = _payloads(s, d).select(c("doc_id").cast("string").alias("node_id"), "label", "raw_text", "breadcrumb", c("source").alias("page_title"), c("raw_text").alias("parent_text"), "synthesized", c("lang").alias("language"), "preceding", none.alias("headers"), none.alias("cells"), F.lit("note").alias("callout_kind"), c("source").alias("name"))
    good, _ = enrich.enrich(p)
    return good.select("node_id", "label", "context", "context_source", F.length("indexed_text").alias("n_chars"))


# ---- pieces of pages: lists, callouts, quotes, tables, on pages made of each document's lines -----

PIECES = r"""src AS (SELECT doc_id, 'p' || doc_id AS path, coalesce(lang, 'no') AS lang, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '[^A-Za-z]', ' ', 'g'), ' +', ' ', 'g'))), lambda x: x <> '') AS ls FROM documents),
li AS (SELECT path, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM src),
lists AS (SELECT path, string_agg(repeat('  ', CAST(i % 3 AS INTEGER)) || '- ' || l, chr(10) ORDER BY i) AS bullets, string_agg(repeat('  ', CAST(i % 3 AS INTEGER)) || (i + 1 - i % 3) || '. ' || l, chr(10) ORDER BY i) AS numbers,
 string_agg('- page: ' || l || CASE WHEN i % 2 = 0 THEN '; next: to ' || i ELSE '' END, chr(10) ORDER BY i) AS nav FROM li GROUP BY path)"""


def _pieces(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Sections and lines of a page for each document: its lines as a list, as a numbered one, as rows of a table and of a navigation table, beside a quote, a rule, an image, a callout, code and an empty section."""
    letters = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "[^A-Za-z]", " "), " +", " "))
    ls = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), letters), lambda x: x != "")
    each = lambda f: F.array_join(F.transform("ls", f), "\n")
    text, lang, deep = F.lit, F.coalesce("lang", F.lit("no")), lambda i, wide: F.repeat(F.lit(" " * wide), (i % 3).cast("int"))
    row = lambda l, i: F.concat(F.lit("| "), i.cast("string"), F.lit(" | **"), l, F.lit("** |"))
    link = lambda l, i: F.concat(F.lit("| ["), l, F.lit("](/n) | "), F.when(i % 2 == 0, F.concat(F.lit("[to "), i.cast("string"), F.lit("](/t)"))).otherwise(""), F.lit(" |"))
    page = F.concat(
        text("# T\n\n## Text\n\nfirst in *"), lang, text("*\nand second\n\n> said\n> in "), lang, text("\n\n---\n\n![alt text](/i/m.png)\n\n<img alt=\"pic\" src=\"/i/"), F.col("doc_id").cast("string"), text(".png\" />\n\n## Bullets\n\n"), each(lambda l, i: F.concat(deep(i, 2), F.lit("- "), l)),
        text("\n\n## Numbers\n\n"), each(lambda l, i: F.concat(deep(i, 3), F.lit("1. "), l)), text("\n\n```py\nx = 1\n```\n\n## Notes\n\n<Warning>\nmind **"), lang, text("**\n\n- a\n- b\n</Warning>\n\n<Tip>\nsee `"), lang,
        text("`\n</Tip>\n\n## Rows\n\n| Name | Value |\n|---|---|\n"), each(row), text("\n\n## Links\n\n| Page | Next |\n|---|---|\n"), each(link), text("\n\n## Empty\n\n## Outer\n\n### Inner\n\ntail\n"),
    )
    pages = table(s, d, "documents").select("doc_id", "lang", ls.alias("ls"))
    return parse.located(pages.select(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("path"), page.alias("text")))


@query(f"""WITH {PIECES}, t AS (SELECT path || '#text' AS section_id, 'first in ' || lang || ' and second' || chr(10) || chr(10) || '> said in ' || lang || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'alt text' || chr(10) || chr(10) || '[image: pic](/i/' || doc_id || '.png)' AS text FROM src
 UNION ALL SELECT path || '#bullets', bullets FROM lists UNION ALL SELECT path || '#numbers', numbers FROM lists UNION ALL SELECT path || '#links', nav FROM lists UNION ALL SELECT path || '#inner', 'tail' FROM src) SELECT * FROM t""")
def B28_section_texts(s: SparkSession, d: str) -> DataFrame:
    """Texts of sections: paragraphs, a quote, a rule, an image, nested lists of both kinds, and a navigation table."""
    _, placed = _pieces(s, d)
    return parse.section_text(placed, navigation=True).select("section_id", "text")


@query(f"""WITH {PIECES}, c AS (SELECT path, 0 AS position, 'warning' AS kind, 'mind ' || lang || chr(10) || chr(10) || '- a' || chr(10) || '- b' AS text FROM src UNION ALL SELECT path, 1, 'tip', 'see `' || lang || '`' FROM src)
SELECT left(sha256(path || '#notes|' || position || '|callout-' || kind), 16) AS node_id, path, path || '#notes' AS section_id, position, kind, text FROM c""")
def B29_callouts(s: SparkSession, d: str) -> DataFrame:
    _, placed = _pieces(s, d)
    return parse.callouts(placed)


@query(f"""WITH {PIECES} SELECT left(sha256(path || '#rows|' || i || '|row'), 16) AS node_id, path || '#rows' AS section_id, i AS position, 'name,value' AS headers, i || ',' || l AS cells FROM li""")
def B32_table_rows(s: SparkSession, d: str) -> DataFrame:
    _, placed = _pieces(s, d)
    return parse.table_rows(placed).select("node_id", "section_id", F.col("position").cast("long").alias("position"), F.array_join("headers", ",").alias("headers"), F.array_join("cells", ",").alias("cells"))


@query(f"""WITH {PIECES}, last AS (SELECT path, string_agg(numbers, '') AS preceding FROM lists GROUP BY path)
SELECT path, 'py' AS language, 'x = 1' AS text, coalesce(preceding, '') AS preceding FROM src LEFT JOIN last USING (path)""")
def F04_preceding_text(s: SparkSession, d: str) -> DataFrame:
    """The text that stands before each code block of its section."""
    _, placed = _pieces(s, d)
    return parse.code_blocks(placed).select("path", "language", "text", "preceding")


@query(f"""WITH {PIECES} SELECT path, CASE a WHEN 'inner' THEN 3 ELSE 2 END AS level, path || '#' || a AS section_id FROM (SELECT path, len(ls) AS n, unnest(['text', 'bullets', 'numbers', 'notes', 'rows', 'links', 'outer', 'inner']) AS a FROM src)
WHERE n > 0 OR a NOT IN ('bullets', 'rows', 'links')""")
def B37_kept_sections(s: SparkSession, d: str) -> DataFrame:
    """Sections without those that have no text, nothing in them, and no section under them."""
    _, placed = _pieces(s, d)
    return parse.held_sections(placed).select("path", "level", "section_id")


# ---- choices: kinds, labels, properties, optional filters, unions ---------------------------------


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS page_url, CAST(NULL AS VARCHAR) AS anchor, CAST(NULL AS VARCHAR) AS breadcrumb, CAST(NULL AS VARCHAR) AS level, CAST(NULL AS VARCHAR) AS position, text, CAST(NULL AS VARCHAR) AS synthesized, CAST(NULL AS VARCHAR) AS parent_section_id, CAST(NULL AS VARCHAR) AS external_links FROM documents""")
def C01_stored_properties(s: SparkSession, d: str) -> DataFrame:
    """Documents as sections: what is stored of them, whatever else they carry."""
    return choose.projected(table(s, d, "documents").withColumn("id", F.col("doc_id").cast("string")), "Section")


@query("SELECT event_id, event_type AS kind FROM events WHERE event_type IN (SELECT DISTINCT event_type FROM events ORDER BY event_type LIMIT 2)")
def C02_kinds(s: SparkSession, d: str) -> DataFrame:
    """Events of the first two types, when the others are known and skipped."""
    records = table(s, d, "events").select("event_id", F.col("event_type").alias("kind"))
    kinds = sorted(r["kind"] for r in records.select("kind").distinct().collect())  # a closed list
    return choose.of_kinds(records, tuple(kinds[:2]), tuple(kinds[2:]))


@query("SELECT doc_id, 'any' AS asked FROM documents UNION ALL SELECT doc_id, 'de' FROM documents WHERE lang = 'de' UNION ALL SELECT doc_id, 'own' FROM documents WHERE lang IS NULL OR source = lang")
def C06_optional_language(s: SparkSession, d: str) -> DataFrame:
    """Documents of any language, of one, and where the language wanted is a column (null: any)."""
    docs = table(s, d, "documents")
    asked = {"any": choose.equal_or_any(F.col("lang"), None), "de": choose.equal_or_any(F.col("lang"), "de"), "own": choose.equal_or_any(F.col("source"), F.col("lang"))}
    return choose.union_all([docs.where(condition).select("doc_id", F.lit(name).alias("asked")) for name, condition in asked.items()])


@query("WITH p AS (SELECT p_partkey, string_split(p_type, ' ') AS labels FROM part), w AS (SELECT list(l) AS wanted FROM (SELECT DISTINCT unnest(labels) AS l FROM p ORDER BY l LIMIT 2)) SELECT p_partkey FROM p, w WHERE list_has_any(labels, wanted)")
def C07_any_label(s: SparkSession, d: str) -> DataFrame:
    """Parts of whose words of type one is among the first two."""
    parts = table(s, d, "part").select("p_partkey", F.split("p_type", " ").alias("labels"))
    words = sorted(r["l"] for r in parts.select(F.explode("labels").alias("l")).distinct().collect())  # a closed list
    return choose.labelled(parts, tuple(words[:2])).select("p_partkey")


@query("SELECT doc_id FROM documents WHERE lang IS NOT NULL OR source IS NOT NULL")
def C12_present(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where(choose.present("lang", "source")).select("doc_id")


@query("""WITH a AS (SELECT item_id, ['Section', 'Tool', 'Nothing', 'Page', 'Hook'][1:CAST(item_id % 6 AS INTEGER)] AS asked FROM benchmark)
SELECT item_id, array_to_string(list_filter(asked, lambda x: x IN ('Section', 'Chunk', 'CodeBlock', 'TableRow', 'Callout')), ',') AS searched, array_to_string(list_filter(asked, lambda x: x IN ('Tool', 'Hook')), ',') AS named FROM a""")
def C14_label_split(s: SparkSession, d: str) -> DataFrame:
    """The labels asked for by each item, split in those searched by text and those searched by name."""
    asked = F.slice(F.array(*map(F.lit, ("Section", "Tool", "Nothing", "Page", "Hook"))), 1, (F.col("item_id") % 6).cast("int"))
    searched, named = choose.split_labels(asked, search.SEARCHABLE_LABELS, search.ENTITY_LABELS)
    return table(s, d, "benchmark").select("item_id", F.array_join(searched, ",").alias("searched"), F.array_join(named, ",").alias("named"))


NATIONS = "SELECT {} AS nation FROM {}"


@query(f"{NATIONS.format('c_nationkey', 'customer')} UNION {NATIONS.format('s_nationkey', 'supplier')} UNION {NATIONS.format('CAST(n_nationkey AS INTEGER)', 'nation')}")
def H01_union_distinct(s: SparkSession, d: str) -> DataFrame:
    return choose.union_distinct([p.select(F.col("nation").cast("int")) for p in _nations(s, d)])


@query(f"SELECT nation, count(*) AS n FROM ({NATIONS.format('c_nationkey', 'customer')} UNION ALL {NATIONS.format('s_nationkey', 'supplier')} UNION ALL {NATIONS.format('CAST(n_nationkey AS INTEGER)', 'nation')}) GROUP BY nation")
def H02_union_all(s: SparkSession, d: str) -> DataFrame:
    return choose.union_all(_nations(s, d)).groupBy("nation").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT c_mktsegment AS grp, 0 AS part, c_nationkey AS nation FROM customer UNION ALL SELECT DISTINCT 'supplier', 1, s_nationkey FROM supplier")
def H03_concat_of_sets(s: SparkSession, d: str) -> DataFrame:
    """Each market segment's nations, and behind them the suppliers' as a set of their own."""
    customers = table(s, d, "customer").select(F.col("c_mktsegment").alias("grp"), F.col("c_nationkey").alias("nation"))
    suppliers = table(s, d, "supplier").select(F.lit("supplier").alias("grp"), F.col("s_nationkey").alias("nation"))
    return choose.concat_of_sets([customers, suppliers], ["grp"], "nation")


def _nations(s: SparkSession, d: str) -> list[DataFrame]:
    return [table(s, d, t).select(F.col(c).cast("int").alias("nation")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]


@query("SELECT o_orderkey AS node_id, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500")
def G09_pilot(s: SparkSession, d: str) -> DataFrame:
    """The first 500 orders, for a trial run."""
    return choose.pilot(table(s, d, "orders").select(F.col("o_orderkey").alias("node_id"), "o_totalprice"), 500)
