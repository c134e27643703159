"""Hybrid retrieval: full text, vectors, entity names, their fusion and the budgeted reranking.

Queries are rows, so one plan serves a whole batch of questions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx
from tessera.functions.contexts import ENTITY_LABELS
from tessera.sources.shared import gathered, saved, shared_folder

K1, B = 1.2, 0.75  # Robertson and Zaragoza 2009
SEARCHABLE_LABELS = ("Section", "Chunk", "CodeBlock", "TableRow", "Callout")
NO_TOKEN = r"[^\p{L}\p{N}_]+"


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_TOKEN), "")


def term_counts(words: Column) -> Column:
    """The distinct words of an array with how often it holds each, as an array of (term, tf): sorted, they stand in runs."""
    # each step is bound once as an array of one element: a lambda's outer expressions are evaluated for every element
    bound = lambda c, f: F.element_at(F.transform(F.array(c), f), 1)
    starts = lambda s: F.when(F.size(s) > 0, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))).otherwise(F.array().cast("array<int>"))
    run = lambda s, a: lambda i, n: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(a, n + 1), F.size(s)) - i).cast("int").alias("tf"))
    return bound(F.sort_array(words), lambda s: bound(starts(s), lambda a: F.transform(a, run(s, a))))


def top_per(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, ranked from 1; plans as a partial and a final group limit."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def asked_terms(queries: DataFrame) -> DataFrame:
    """query_id, term of queries (query_id, text), each once."""
    return queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))


def bm25(nodes: DataFrame, queries: DataFrame, k: int = 50, wanted: Column | None = None) -> DataFrame:
    """query_id, node_id, score, rank: the k best of nodes (node_id, indexed_text) for each query (query_id, text).

    The texts are read once: a row for each node with its counts of the queries' terms is written and everything else is made of
    them.  wanted: a condition on nodes; others count in the statistics but are not scored.  ``textindex.TextIndex`` keeps postings from one search to the next.
    """
    asked = asked_terms(queries)
    postings = saved(counted(nodes.withColumn("wanted", F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))), asked, ["wanted"]), "postings")
    return scored(postings, asked, k)


def scored(postings: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``ranked`` with the statistics of the postings themselves."""
    stats = postings.agg(F.sum("texts").alias("n"), (F.sum(F.col("length") * F.col("texts")) / F.sum("texts")).alias("mean")).first()
    return ranked(postings, asked, stats["n"] or 0, stats["mean"], k)


def in_blocks(df: DataFrame, name: str, block: int) -> str:
    """The folder to which it writes df as files of about ``block`` rows, for tasks that read them one by one."""
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.repartition(max(-(-df.count() // block), 1)).write.parquet(folder)
    return folder


def block_files(folder: str) -> tuple[list[str], Callable[[str], pa.Table]]:
    """The files of a folder and what reads one."""
    from pyarrow import fs, parquet

    store, path = fs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
    return files, lambda f: parquet.read_table(f, filesystem=store).combine_chunks()


def counted(nodes: DataFrame, asked: DataFrame, columns: list[str], block: int = 1 << 17, rows: int = 1024) -> DataFrame:
    """node_id, columns, length, texts, held: for each node (node_id, indexed_text) with a text how many tokens it has and how often each term that is asked for.

    Texts are cut into tokens here and counted in Arrow, ``rows`` at a time.  Texts of the same node and length (texts: how many) count together.
    """
    folder = in_blocks(asked.select("term").distinct(), "terms", block)
    cut = nodes.where(F.coalesce("indexed_text", F.lit("")) != "").select("node_id", *columns, tokens(F.col("indexed_text")).alias("tokens"))
    kept = len(columns) + 1
    schema = T.StructType([*cut.schema.fields[:kept], *T._parse_datatype_string("length int, held array<struct<term:string,tf:bigint>>").fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, read = block_files(folder)
        for held in gathered(batches, len(files)):
            parts = [batch.slice(at, rows) for batch in held for at in range(0, batch.num_rows, rows)]
            coded = [part.column(kept).flatten().dictionary_encode() for part in parts]
            known = [np.zeros(len(c.dictionary), bool) for c in coded]
            for terms in map(read, files):
                for c, is_known in zip(coded, known, strict=True):
                    is_known |= pc.is_in(c.dictionary, value_set=terms.column(0).combine_chunks()).to_numpy(zero_copy_only=False)
            for part, c, is_known in zip(parts, coded, known, strict=True):
                node, _ = entries(part.column(kept))
                code = c.indices.to_numpy(zero_copy_only=False)
                cells, tf = np.unique((node * len(is_known) + code)[is_known[code]], return_counts=True)
                ends = np.searchsorted(cells, np.arange(part.num_rows + 1) * len(is_known)).astype(np.int32)
                posting = pa.StructArray.from_arrays([c.dictionary.take(pa.array(cells % max(len(is_known), 1))), pa.array(tf)], names=["term", "tf"])
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], pc.list_value_length(part.column(kept)), pa.ListArray.from_arrays(pa.array(ends), posting)], names=schema.names)

    every = cut.mapInArrow(task, schema).groupBy("node_id", *columns, "length").agg(F.count("*").alias("texts"), F.flatten(F.collect_list("held")).alias("held"))
    of = lambda t: F.aggregate(F.filter("held", lambda x: x["term"] == t), F.lit(0).cast("long"), lambda s, x: s + x["tf"])
    summed_up = F.transform(F.array_distinct("held.term"), lambda t: F.struct(t.alias("term"), of(t).alias("tf")))
    return every.withColumn("held", F.when(F.col("texts") == 1, F.col("held")).otherwise(summed_up))


def ranked(postings: DataFrame, asked: DataFrame, n: int, mean: float | None, k: int, block: int = 1024, rows: int = 4096) -> DataFrame:
    """query_id, node_id, score, rank by the postings (node_id, wanted, length, held: an array of term, tf) of the terms asked for; n nodes have a mean length.  Scores are rounded to six digits before they are ordered.

    The queries are written in blocks with the weights of their terms.  ``rows`` nodes at a time meet a block as a matrix of scores, to which each term
    adds what it is worth in the nodes, for the queries that ask for it; only the best leave the task.
    """
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = postings.select(F.explode("held.term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).select("term", idf.alias("idf"))
    wants = asked.join(weights, "term").groupBy("query_id").agg(F.collect_list(F.struct("term", "idf")).alias("wants"))
    folder = in_blocks(wants, "asked", block)
    mean = mean or 1.0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, read = block_files(folder)
        for held in gathered(batches, len(files)):
            for table in map(read, files):
                if table.num_rows:
                    queries, wants = table.column(0).combine_chunks(), table.column(1).combine_chunks()
                    for part in (batch.slice(at, rows) for batch in held for at in range(0, batch.num_rows, rows)):
                        scores = summed(wants, part.column(1), mean)
                        row, column, score = best_cells(scores, k)
                        met = score > 0
                        yield pa.RecordBatch.from_arrays([queries.take(pa.array(row[met])), part.column(0).take(pa.array(column[met])), pa.array(score[met])], names=["query_id", "node_id", "score"])

    dealt = postings.where("wanted").groupBy("node_id").agg(F.collect_list(F.struct("length", "held")).alias("texts"))  # one row, unless an id has texts of several lengths
    found = dealt.mapInArrow(task, T.StructType([asked.schema["query_id"], postings.schema["node_id"], T.StructField("score", T.DoubleType())]))
    return top_per(found.withColumn("score", F.round("score", 6)), ["query_id"], [F.desc("score"), F.col("node_id")], k)


def entries(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each entry of lists, and the entries."""
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), lists.flatten()


def summed(wants: pa.Array, texts: pa.Array, mean: float) -> np.ndarray:
    """The scores of nodes (columns; lists of length, held) for queries (rows; lists of term, idf, repeats included)."""
    (query, want), (node, text) = entries(wants), entries(texts)
    of, posting = entries(text.field("held"))
    known = pc.unique(want.field("term"))
    numbers = lambda x: x.to_numpy(zero_copy_only=False)
    of_want, of_posting = (numbers(pc.fill_null(pc.index_in(x.field("term"), known), -1)).astype(np.int64) for x in (want, posting))
    idf = np.zeros(len(known))
    idf[of_want] = numbers(want.field("idf"))
    met = of_posting >= 0
    term, of, tf = of_posting[met], of[met], numbers(posting.field("tf"))[met].astype(np.float64)
    worth = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * numbers(text.field("length"))[of] / mean))
    asks, times = np.unique(of_want * len(wants) + query, return_counts=True)
    cells, at = np.unique(term * len(texts) + node[of], return_inverse=True)
    worth = np.bincount(at, worth, len(cells))
    asks_from, cells_from = (np.searchsorted(x, np.arange(len(known) + 1) * n) for x, n in ((asks, len(wants)), (cells, len(texts))))
    scores = np.zeros((len(wants), len(texts)))
    for t in np.flatnonzero(np.diff(cells_from)):
        q, d = slice(asks_from[t], asks_from[t + 1]), slice(cells_from[t], cells_from[t + 1])
        scores[np.ix_(asks[q] % len(wants), cells[d] % len(texts))] += times[q][:, None] * worth[d]
    return scores


#: Filters that a query may set (fixed values).
FILTERS = ("language", "page_path_prefix")


def allowed_filters(given: Column, allowed: tuple[str, ...] = FILTERS) -> Column:
    """The entries of a map of filters whose names are allowed."""
    return F.map_filter(given, lambda k, v: k.isin(*allowed))


def vector_search(nodes: DataFrame, queries: DataFrame, k: int = 50, block: int = 1024) -> DataFrame:
    """query_id, node_id, score, rank: the k largest cosines of nodes (node_id, embedding) for a stated set of query vectors (query_id, vector).

    The queries are written in blocks; Arrow batches of nodes, several at once where there is more than one block, meet them block by block as matrix
    products, of which only the best leave the task.  Vectors without a length, with a null component or of another length than the query's have no cosine.
    """
    spark = nodes.sparkSession
    usable = lambda c: F.col(c).isNotNull() & F.forall(c, lambda x: x.isNotNull())
    folder = f"{shared_folder(spark)}/asked-{uuid.uuid4().hex}"
    asked = queries.where(usable("vector")).select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    asked.write.option("maxRecordsPerFile", block).parquet(folder)
    ids, keys = nodes.schema["node_id"].dataType, queries.schema["query_id"].dataType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, read = block_files(folder)
        for held in gathered(batches, len(files)):
            parts = [(batch, *rows) for batch in held for rows in by_length(batch.column(1))]
            for table in map(read, files):
                asked_for = list(by_length(table.column(1).combine_chunks())) if table.num_rows else []
                for batch, size, of, x in parts:
                    for other, those, q in asked_for:
                        if other == size:
                            row, column, score = best_cells(q @ x.T, k)
                            yield pa.RecordBatch.from_arrays([table.column(0).combine_chunks().take(pa.array(those[row])), batch.column(0).take(pa.array(of[column])), pa.array(score)], names=["query_id", "node_id", "score"])

    # nodes with a null component are left out in the task: as a condition here, an embedding that is still to be made would be made for it once more
    found = nodes.select("node_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(task, T.StructType([T.StructField("query_id", keys), T.StructField("node_id", ids), T.StructField("score", T.DoubleType())]))
    return top_per(found.withColumn("score", F.round("score", 6)), ["query_id"], [F.desc("score"), F.col("node_id")], k)


def by_length(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length that vectors have: the length, which they are, and those that aren't zero and hold no null as rows of length 1."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]).tolist():
        of = np.flatnonzero(lengths == size)
        x = vectors.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).reshape(len(of), size)
        norm = np.sqrt((x * x).sum(axis=1))
        yield size, of[norm > 0], x[norm > 0] / norm[norm > 0, None]


def best_cells(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of each row's k largest, and of all that equal the k-th when rounded."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero(scores >= least[:, None] - 2e-6)
    else:
        row, column = np.nonzero(np.ones(scores.shape, bool))
    return row, column, scores[row, column]


def entity_lookup(entities: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """query_id, node_id, score, rank: entities (node_id, name) by graded match with the queries' terms (query_id, terms).

    An entity can match only where a term and its name share their first four characters, or are equal; so they are joined on that.
    """
    head = lambda c: F.substring(F.lower(c), 1, 4)
    asked = queries.select("query_id", "terms", F.explode(F.array_distinct(F.transform("terms", lambda t: F.substring(F.lower(t), 1, 4)))).alias("head"))
    scored = entities.withColumn("head", head(F.col("name"))).join(asked, "head").select("query_id", "node_id", "name", tx.graded_match(F.col("name"), F.col("terms")).alias("score"))
    best = scored.where("score > 0").groupBy("query_id", "node_id").agg(F.max("score").alias("score"), F.min("name").alias("name"))
    return top_per(best, ["query_id"], [F.desc("score"), F.col("name"), F.col("node_id")], k)


def merge_legs(lexical: DataFrame, vector: DataFrame, key: list[str]) -> DataFrame:
    """Both legs by key, with bm25_score and vector_score, each null where its leg hasn't the node."""
    left = lexical.select(*key, F.col("score").alias("bm25_score"))
    right = vector.select(*key, F.col("score").alias("vector_score"))
    return left.join(right, key, "full_outer")


def first_wins(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """The union of parts with one row for each key: that of the first part that has it."""
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in union.columns if c not in key]
    best = union.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col("part")).alias("row"))
    return best.select(*key, *[F.col(f"row.{c}").alias(c) for c in rest if c != "part"])


def rrf(candidates: DataFrame, legs: list[str], by: list[str], key: list[str], k: int = 60, top_n: int = 40) -> DataFrame:
    """Reciprocal-rank fusion: the sum over legs of 1 / (k + rank); a null score isn't ranked.

    by: what a list of candidates belongs to (a query); further columns of the list, such as a sub-query, may be in ``legs`` lists of their own.
    """
    ranked = []
    for leg in legs:
        window = Window.partitionBy(*by).orderBy(F.desc(leg), *key)
        ranked.append(candidates.where(F.col(leg).isNotNull()).select(*by, *key, (F.lit(1.0) / (k + F.row_number().over(window))).alias("part")))
    fused = reduce(DataFrame.unionByName, ranked).groupBy(*by, *key).agg(F.round(F.sum("part"), 9).alias("rrf_score"))
    return top_per(fused, by, [F.desc("rrf_score"), *map(F.col, key)], top_n)


def is_entity(label: Column) -> Column:
    return label.isin(*ENTITY_LABELS)


def rerank_budget(scored: DataFrame, by: list[str], top_k: int = 8, entity_budget: int = 2) -> DataFrame:
    """The top_k of scored (node_id, node_label, rerank_score, bm25_score, expansion_origin), entities in at most entity_budget places.

    Entities found by name come before other entities; the rest of the places goes to documents; the order is by score.
    """
    order = [F.desc_nulls_last("rerank_score"), F.col("node_label"), F.col("node_id")]
    if entity_budget <= 0 or top_k <= 0:
        return top_per(scored, by, order, max(top_k, 0))
    lane = F.when(is_entity(F.col("node_label")), 1).otherwise(0)
    looked_up = F.when(F.col("bm25_score").isNotNull() & F.col("expansion_origin").isNull(), 0).otherwise(1)
    in_lane = Window.partitionBy(*by, "lane").orderBy(F.when(F.col("lane") == 1, looked_up).otherwise(0), *order)
    laned = scored.withColumn("lane", lane).withColumn("place", F.row_number().over(in_lane))
    some = laned.where(F.col("place") <= F.when(F.col("lane") == 1, min(entity_budget, top_k)).otherwise(top_k))
    entities = F.sum("lane").over(Window.partitionBy(*by))
    kept = some.withColumn("entities", entities).where((F.col("lane") == 1) | (F.col("place") <= top_k - F.col("entities")))
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).drop("lane", "place", "entities")


def overlap_score(query: Column, text: Column, chars: int = 1500) -> Column:
    """The stand-in scorer of the reranker: the share of the query's terms that the first ``chars`` characters hold."""
    asked = F.array_distinct(tokens(query))
    held = F.array_intersect(asked, tokens(F.substring(F.coalesce(text, F.lit("")), 1, chars)))
    return F.size(held) / F.greatest(F.size(asked), F.lit(1))


def hybrid_search(nodes: DataFrame, entities: DataFrame, sub_queries: DataFrame, k: int = 50) -> DataFrame:
    """query_id, node_id, node_label, bm25_score, vector_score for sub_queries (query_id, text, target_labels, keywords, vector).

    Document labels are searched by text and vector, entity labels by name; labels of other kinds find nothing.
    """
    asked = sub_queries.withColumn("full", tx.query_string(F.col("text"), F.col("keywords")))
    labels = sub_queries.select(F.explode("target_labels").alias("label")).where(F.col("label").isin(*SEARCHABLE_LABELS, *ENTITY_LABELS))
    wanted = {r["label"] for r in labels.distinct().collect()}  # of a closed list
    none = [] if wanted & {*SEARCHABLE_LABELS, *ENTITY_LABELS} else list(SEARCHABLE_LABELS[:1])
    searched = [x for x in SEARCHABLE_LABELS if x in wanted] + none
    parts = []
    if searched:
        # texts are cut into tokens, and embeddings made, once for all labels
        own = nodes.where(F.col("node_label").isin(*searched))
        terms = lambda df: asked_terms(df.select("query_id", F.col("full").alias("text")))
        postings = saved(counted(own, terms(asked), ["node_label"]), "postings").withColumn("wanted", F.lit(True))
        vectors = saved(own.select("node_id", "node_label", "embedding"), "vectors")
    for label in searched:
        labelled = F.col("node_label") == label
        mine = asked.where(F.array_contains("target_labels", label))
        lexical = scored(postings.where(labelled), terms(mine), k)
        vector = vector_search(vectors.where(labelled), mine.where(F.col("vector").isNotNull()).select("query_id", "vector"), k)
        parts.append(merge_legs(lexical, vector, ["query_id", "node_id"]).withColumn("node_label", F.lit(label)))
    for label in [x for x in ENTITY_LABELS if x in wanted]:
        mine = asked.where(F.array_contains("target_labels", label)).select("query_id", tx.query_terms(F.col("text"), F.col("keywords")).alias("terms"))
        found = entity_lookup(entities.where(F.col("label") == label), mine, k)
        parts.append(found.select("query_id", "node_id", F.col("score").alias("bm25_score"), F.lit(None).cast("double").alias("vector_score"), F.lit(label).alias("node_label")))
    return first_wins(parts, ["query_id", "node_id", "node_label"])


def evidence(candidates: DataFrame, by: list[str], chars: int = 800) -> DataFrame:
    """The numbered evidence block of each question, from its ranked candidates."""
    blank = lambda c: F.when(F.col(c) == "", None).otherwise(F.col(c))
    title = F.coalesce(blank("title"), blank("breadcrumb"), F.col("node_id"))
    url = F.when(blank("url").isNotNull(), F.concat(F.lit("\n    url: "), F.col("url"), F.when(blank("anchor").isNotNull(), F.concat(F.lit("#"), F.col("anchor"))).otherwise(""))).otherwise("")
    body = F.substring(F.coalesce(blank("indexed_text"), F.col("raw_text"), F.lit("")), 1, chars)
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col("node_label"), F.lit(" "), title, url, F.lit("\n    "), body)
    return candidates.select(*by, "rank", line.alias("line")).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("rank", "line"))).alias("lines")).select(*by, F.array_join(F.transform("lines", lambda x: x["line"]), "\n\n").alias("evidence"))


def citations(candidates: DataFrame, snippet: int = 280) -> DataFrame:
    """candidates as numbered citations: title and score with their fallbacks, and a snippet."""
    blank = lambda c: F.when(F.col(c) == "", None).otherwise(F.col(c))
    text = F.coalesce(blank("indexed_text"), blank("raw_text"), F.lit(""))
    score = F.coalesce("rerank_score", "rrf_score", "vector_score", "bm25_score", F.lit(0.0))
    return candidates.select("query_id", F.col("rank").alias("id"), "node_id", "node_label", "url", "anchor", F.coalesce(blank("title"), blank("breadcrumb"), F.col("node_id")).alias("title"), F.substring(text, 1, snippet).alias("snippet"), score.alias("score"))
