"""Operators 11 to 13: reversed search, whitening and token counts, against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import revsearch, tokencount, whitening
from tessera.llm.registry import queries

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x" for i in range(300_000))
HARD = [(None, "one two three"), (1, None), (2, ""), (3, "same words here now again"), (3, "same words here now again"), (4, LONG), (5, "ÉTÉ à 日本 😀 x"), (6, " \n\t "), (7, "same words here now again"), (8, "<s> ▁ a  b\x00c"), (9, "L'été 'll 123 4.5,, thé. Thé,")]


def with_clashes(frame):
    for name in ("score", "rank", "item_id", "item", "n_tokens", "n_bytes", "digest", "component", "n", "whitened"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="module")
def hard(spark):
    return with_clashes(spark.createDataFrame(HARD, "doc_id long, text string")).cache()


# ---- 11 reversed search -------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, top=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms, held = len(counted), sum(sum(c.values()) for _, c in counted), Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        own = terms(text)
        scored = []
        for d, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0))
        out += [(item, r, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_search_equals_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows(queries()["op11_reversed_search"](spark, SF)) == want
    # many blocks of items, and documents dealt otherwise
    assert rows(revsearch.search(docs.repartition(7), items, block_bytes=700)) == want
    _, blocks = revsearch.item_blocks(items, 700)
    assert len(blocks) > 5


def test_search_hard_rows(spark, hard):
    asked = [(1, "same words"), (1, "same words"), (None, "One x"), (3, ""), (4, None), (5, "été 日本 w5x w5x W5X"), (6, "nowhere"), (7, "again again")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit("y"))
    got = rows(revsearch.search(hard, items))
    assert got == brute_search(HARD, asked)
    assert sum(g[0] == 1 for g in got) == 6 and {g[2] for g in got if g[0] is None} == {None, 5}


def test_search_ties_and_large_groups(spark):
    docs = [(i, "equal text of all") for i in range(400, 0, -1)] + [(1000, "equal")]
    got = rows(revsearch.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame([("a", "text"), ("b", "equal")], "item_id string, text string")))
    assert [g[2] for g in got if g[0] == "a"] and sorted(g[2] for g in got if g[0] == "a") == list(range(1, 11))
    assert got == brute_search(docs, [("a", "text"), ("b", "equal")])


def test_search_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    items, no_items = spark.createDataFrame([(1, "a")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    for d, i in ((none, items), (docs, no_items), (none, no_items)):
        out = revsearch.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


# ---- 12 whitening -------------------------------------------------------------------------------

def brute_whitening(vectors, most=8):
    x = [[math.floor(1024 * float(np.float64(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = np.array(x, dtype=float) - np.array([v / n for v in s])
    e, p = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-e)[:most]
    return n, [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x], y, e[order], p[:, order], e.sum()


def check_whitening(got, ids, vectors, most=8):
    n, deviation, y, e, p, trace = brute_whitening(vectors, most)
    by = defaultdict(dict)
    for r in got:
        by[r["component"]][r["vec_id"]] = r
    assert sorted(by) == list(range(1, most + 1))
    for k in by:
        own = [by[k][i] for i in ids]
        assert len(by[k]) == len(ids) and {r["n"] for r in own} == {n}
        assert [r["deviation"] for r in own] == deviation
        assert all(abs(r["explained"] / (e[k - 1] / trace) - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in own)
        w, want = np.array([r["whitened"] for r in own]), y @ p[:, k - 1] / math.sqrt(e[k - 1])
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-7


def test_whitening_equals_dense_eigenvectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    all_rows = table.collect()
    check_whitening(queries()["op12_whitening"](spark, SF).collect(), [r["vec_id"] for r in all_rows], [r["embedding"] for r in all_rows])
    # more partitions than one level of triangles takes, some empty
    check_whitening(whitening.whiten(table.repartition(90)).collect(), [r["vec_id"] for r in all_rows], [r["embedding"] for r in all_rows])


def test_whitening_hard_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in rng.standard_normal(4) * (1, 2, 3, 4)]) for i in range(40)] + [(40, [0.0, 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0]), (5, [1.0, 1.0, 1.0, 1.0])]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0]), (93, [1.0, math.nan, 1.0, 1.0]), (94, [math.inf, 1.0, 1.0, 1.0]), (95, [1.0, 2.0]), (96, [1e300, 1.0, 1.0, 1.0])]
    frame = with_clashes(spark.createDataFrame(good + bad, "vec_id long, embedding array<double>"))
    got = whitening.whiten(frame).collect()
    assert len(got) == 4 * len(good) and {r["vec_id"] for r in got}.isdisjoint(range(90, 99))
    assert sorted(r["deviation"] for r in got if r["component"] == 2) == sorted(brute_whitening([v for _, v in good])[1])
    assert all(r["identity_error"] < 1e-9 for r in got)
    same = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0 and whitening.whiten(same.where("false")).count() == 0
    huge = whitening.whiten(spark.createDataFrame([(i, [float(i % 7) * 1e9, float(i % 5)]) for i in range(60)], "vec_id long, embedding array<double>")).collect()
    assert len(huge) == 120 and all(r["deviation"] is None or r["deviation"] < 2**63 for r in huge) and any(r["deviation"] is None for r in huge)


def test_whitening_of_equal_variances(spark):
    unit = [(i, [1.0 if j == i % 6 else 0.0 for j in range(6)]) for i in range(12)] + [(i + 12, [-1.0 if j == i % 6 else 0.0 for j in range(6)]) for i in range(12)]
    got = whitening.whiten(spark.createDataFrame(unit, "vec_id long, embedding array<float>"), components=5).collect()
    assert len(got) == 24 * 5 and all(r["identity_error"] < 1e-9 and abs(r["explained"] - 1 / 6) < 1e-9 for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_solver_on_odd_matrices(seed):
    rng = np.random.default_rng(seed)
    for r in (rng.standard_normal((30, 30)), rng.standard_normal((30, 30)) * np.logspace(0, -7, 30), np.repeat(rng.standard_normal((30, 10)), 3, axis=1), np.vstack([rng.standard_normal((3, 30)), np.zeros((27, 30))]), np.diag([3.0, 3, 3, 2, 2, 0, 0]), np.zeros((4, 4)), np.ones((1, 1))):
        r = np.linalg.qr(r, mode="r")
        a, b, w = whitening.bidiagonal(r)
        assert np.abs(w.T @ w - np.eye(len(r))).max() < 1e-13
        want = np.linalg.svd(r, compute_uv=False) ** 2
        assert np.allclose(whitening.dqds(a, b), want, rtol=1e-9, atol=1e-18 * want[0] if want[0] else 0)
        if want[0]:
            values, vectors = whitening.leading(r, 6)
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11 and np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-11 * want[0]


# ---- 13 token counts ----------------------------------------------------------------------------

ODD = [(20, "a<|endoftext|>b"), (21, "foo  <|endoftext|>  bar <|endoftext|>"), (22, "<|endoftext|><|endoftext|>"), (23, "tab\tand\n\n new  lines \n"), (24, "nb sp  x  y　 z"), (25, "  leading and trailing  "), (26, "it's we'll 'S 12 345,6 ...?! "), (27, "\x1c \x1d a \x85 b"), (28, "<|ENDOFTEXT|> <|startoftext|>x"), (29, "naïve ÀÉ é ﬁ"), (30, " "), (31, "naïve ÀÉ é ﬁ")]


def library_counts(name, texts):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, hard, tmp_path, name):
    every = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + HARD + ODD
    texts = [t or "" for _, t in every]
    want = sorted(((d, len(t.encode()), n, n > 512) for (d, _), t, n in zip(every, texts, library_counts(name, texts), strict=True)), key=repr)
    frame = with_clashes(spark.createDataFrame(every, "doc_id long, text string"))
    for _ in range(2):
        assert rows(tokencount.count(frame, public_tokenizers.path(name), f"file://{tmp_path}/cache")) == want


def test_unit_cache_may_fill(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHED_UNITS", 3)
    texts = [t or "" for _, t in ODD + HARD[:5]]
    own = tokencount.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.counts(texts) == library_counts("byte_bpe_50k.json", texts) == own.counts(texts)


def stored_rows(spark, cache):
    return spark.read.schema(tokencount.SCHEMA).option("recursiveFileLookup", True).parquet(cache)


def test_cache_takes_distinct_misses_once(spark, tmp_path):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache"
    copies = spark.createDataFrame([(i, "the same copy") for i in range(500)] + [(500, None), (501, ""), (502, "another")], "doc_id long, text string").repartition(8)
    tokencount.count(copies, path, cache).count()
    assert stored_rows(spark, cache).count() == 3
    folders = lambda: len(list((tmp_path / "cache" / tokencount.version(path)).glob("batch-*")))
    assert folders() == 1
    tokencount.count(copies, path, cache).count()
    assert folders() == 1  # nothing is missing, nothing is written
    tokencount.count(copies.unionByName(spark.createDataFrame([(9, "new"), (9, "new")], "doc_id long, text string")), path, cache).count()
    assert folders() == 2 and stored_rows(spark, cache).count() == 4
    # another tokenizer has counts of its own
    tokencount.count(copies, public_tokenizers.path("word_bpe_49k.json"), cache).count()
    assert len(list((tmp_path / "cache").iterdir())) == 2


def test_counts_come_from_the_cache(spark, tmp_path):
    """A stored count is used as it is, also where two calls stored it; what a stopped call left is not read."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    table = tmp_path / "cache" / tokencount.version(path)
    docs = spark.createDataFrame([(1, "kept in store"), (2, "kept in store"), (3, "fresh")], "doc_id long, text string")
    known = docs.where("doc_id = 1").select(F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    for name in ("batch-a", "batch-b"):
        known.write.parquet(f"file://{table}/{name}")
    (table / "batch-c" / "_temporary").mkdir(parents=True)
    (table / "batch-c" / "_temporary" / "part-0.parquet").write_bytes(b"torn")
    assert [tuple(r) for r in tokencount.count(docs, path, f"file://{tmp_path}/cache").orderBy("doc_id").collect()] == [(1, 13, 77, False), (2, 13, 77, False), (3, 5, library_counts("byte_bpe_50k.json", ["fresh"])[0], False)]


def test_counts_of_an_empty_table(spark, tmp_path):
    out = tokencount.count(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"), f"file://{tmp_path}/cache")
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0
