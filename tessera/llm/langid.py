"""Language identification by word-first backoff.

Words are runs of letters after lower-casing.  A word of the model scores the log
frequency that it has in each language.  A word that the model hasn't scores by
its character n-grams, the longest size of which at least one is known: the mean
of their log frequencies.  A text's language is the one with the largest sum.

The model is fitted on a bounded sample of labelled rows (``sample_rows``, chosen
by a hash of doc_id, so that every size of input behaves alike) and holds every word
and n-gram of it.

Nulls: a null text, or one without letters, is ``und`` with score 0; so is every text
where no row is labelled.  A null doc_id is never held out nor learned from.  Ties go
to the language that sorts first.  Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import tidy
from tessera.llm.words import slices

UNKNOWN = "und"
SIZES = (5, 4, 3, 2, 1)
SAMPLE_ROWS = 6_000
#: Letters of a long word whose n-grams are taken at once.
PIECE = 64


@dataclass
class LanguageModel:
    languages: list[str]
    words: pa.Array
    word_scores: np.ndarray
    grams: pa.Array
    gram_scores: np.ndarray


def letter_words(texts: pa.Array) -> pa.Array:
    """The words of each text, as lists that may hold empty strings."""
    texts = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    return pc.split_pattern(pc.replace_substring_regex(texts, r"[^\p{L}]+", " "), " ")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _scores(counts: pa.Table, languages: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The keys of counts (key, lang, n) in order, and their log frequency in each language."""
    found = pc.unique(counts.column("key")).cast(pa.large_string())
    keys = found.take(pc.sort_indices(found))
    n = np.zeros((len(keys), len(languages)))
    row, column = (pc.index_in(counts.column(c).cast(pa.large_string()).combine_chunks(), value_set=v).to_numpy(zero_copy_only=False) for c, v in (("key", keys), ("lang", pa.array(languages, pa.large_string()))))
    n[row, column] = counts.column("n").to_numpy()
    return keys, np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * max(len(keys), 1)))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model from doc_id, text, lang; rows without text or lang are not used."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    total = rows.count()
    share = max(1, round(1_000_000 * min(1.0, sample_rows / max(total, 1))))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).drop("doc_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                lists = letter_words(batch.column(0).slice(lo, hi - lo))
                langs = batch.column(1).slice(lo, hi - lo).cast(pa.string()).take(pc.list_parent_indices(lists))
                counted = pa.table({"lang": langs, "key": lists.flatten()}).group_by(["lang", "key"]).aggregate([([], "count_all")])
                for b in counted.filter(pc.not_equal(counted["key"], "")).rename_columns(["lang", "key", "n"]).to_batches():
                    yield b.cast(pa.schema([("lang", pa.string()), ("key", pa.string()), ("n", pa.int64())]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of a longer word, pieces that overlap so that each n-gram begins in the first PIECE letters of one
        for batch in batches:
            long = pc.greater(pc.utf8_length(batch.column(1)), PIECE)
            yield batch.filter(pc.invert(long))
            for row in batch.filter(long).to_pylist():
                for lo in range(0, len(row["key"]), PIECE << 10):
                    part = [row["key"][p : p + PIECE + max(SIZES) - 1] for p in range(lo, min(lo + (PIECE << 10), len(row["key"])), PIECE)]
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([row["lang"]] * len(part), pa.string()), "key": pa.array(part, pa.string()), "n": pa.array([row["n"]] * len(part), pa.int64())})

    # the n-grams of the sample's words and the words themselves, both bounded by the sample
    by_word = sample.mapInArrow(tidy(words), "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    place = F.explode(F.sequence(F.lit(1), F.least(F.length("key"), F.lit(PIECE))))
    starts = by_word.mapInArrow(tidy(pieces), "lang string, key string, n long").select("lang", "key", "n", place.alias("at"))
    sizes = starts.select("lang", "n", "key", "at", F.explode(F.array(*map(F.lit, SIZES))).alias("size")).where("at + size - 1 <= length(key)")
    by_gram = sizes.groupBy("lang", F.expr("substring(key, at, size)").alias("key")).agg(F.sum("n").alias("n"))

    found, grams = by_word.toArrow(), by_gram.toArrow()  # bounded by the sample
    languages = sorted(pc.unique(found.column("lang")).to_pylist())
    return LanguageModel(languages, *_scores(found, languages), *_scores(grams, languages))


def backoff(model: LanguageModel, words: pa.Array) -> np.ndarray:
    """Scores of words that the model hasn't: the longest n-grams of which some are known."""
    out = np.zeros((len(words), len(model.languages)))
    rest, lengths = np.arange(len(words)), pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for size in SIZES:
        if not len(rest):
            break
        total, known = np.zeros((len(words), len(model.languages))), np.zeros(len(words), np.int64)

        def add(who: np.ndarray, grams: pa.Array) -> None:
            at = pc.index_in(grams, value_set=model.grams)
            ok = at.is_valid().to_numpy(zero_copy_only=False)
            own = model.gram_scores[at.drop_null().to_numpy(zero_copy_only=False)]
            for k in range(own.shape[1]):
                total[:, k] += np.bincount(who[ok], weights=own[:, k], minlength=len(words))
            known[:] += np.bincount(who[ok], minlength=len(words))

        for p in range(0, 64):
            who = rest[(lengths[rest] >= p + size) & (lengths[rest] <= 64)]
            if not len(who):
                break
            add(who, pc.utf8_slice_codeunits(words.take(pa.array(who)), p, p + size))
        for i in rest[lengths[rest] > 64].tolist():
            w = words[i].as_py()
            add(np.full(len(w) - size + 1, i), pa.array([w[p : p + size] for p in range(len(w) - size + 1)], pa.large_string()))
        found = rest[known[rest] > 0]
        out[found] = total[found] / known[found][:, None]
        rest = rest[known[rest] == 0]
    return out


def score_texts(model: LanguageModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language and its posterior (equal priors) for each text."""
    lists = letter_words(texts)
    coded = pc.dictionary_encode(lists.flatten())
    at = pc.index_in(coded.dictionary, value_set=model.words)
    new = at.is_null().to_numpy(zero_copy_only=False) & pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    scores = np.zeros((len(coded.dictionary), max(len(model.languages), 1)))
    if model.languages:
        known = at.is_valid().to_numpy(zero_copy_only=False)
        scores[known] = model.word_scores[at.drop_null().to_numpy(zero_copy_only=False)]
        scores[new] = backoff(model, coded.dictionary.filter(pa.array(new)))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    full = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    where = lists.offsets.to_numpy()
    where = where - where[0]
    sums = np.stack([(c := np.concatenate([[0.0], np.cumsum(scores[codes, k])]))[where[1:]] - c[where[:-1]] for k in range(scores.shape[1])], axis=1)
    counts = np.concatenate([[0], np.cumsum(full[codes])]) if len(codes) else np.zeros(1, int)
    empty = (counts[where[1:]] == counts[where[:-1]]) | (not model.languages)
    best = sums.argmax(axis=1)
    share = 1 / np.exp(np.minimum(sums - sums.max(axis=1, keepdims=True), 0)).sum(axis=1)
    return [UNKNOWN if e else model.languages[b] for e, b in zip(empty, best, strict=True)], np.where(empty, 0.0, share)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The columns of docs, then lang_pred and score; columns of docs with these names give way."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    at = kept.columns.index("text")
    sent = kept.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at), 2 << 20):
                part = batch.slice(lo, hi - lo)
                langs, share = score_texts(sent.value, part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(share, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(tidy(task), f"{kept.schema.toDDL()}, lang_pred string, score double")


def predict(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learns from the labelled documents that aren't held out, then identifies all."""
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(marked.where("NOT held_out AND doc_id IS NOT NULL"), sample_rows)
    return identify(marked.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")
