"""Toxicity by a classifier chain.

Each category of the chain has a logistic model over word presence (words of the
text, each once) and over the probabilities of the categories before it.  While
learning, those probabilities are out of fold: every row's come from models that
haven't seen the row, so that a later model sees them as it will on new texts.
Folds are dealt by a hash of doc_id.

The chain is fitted on a bounded sample of labelled rows (``sample_rows``, chosen
by a hash of doc_id) and knows every word that two of its texts share (a word of one
text alone tells nothing of others).  Every text is scored.

Nulls: a null text has no words and so the base rates; a null label is left out of its
category's model.  Repeated doc_ids in labels: each row
counts; equal texts of the sample count once.  Without labelled
rows of both kinds a category's probability is its base rate, 0 if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import saved, tidy
from tessera.llm.words import slices, split

SAMPLE_ROWS, FOLDS, RIDGE, EVIDENCE = 16_000, 5, 0.05, 4.0
#: Steps of a fit at most, those it remembers, and the share of the first loss below which a step ends it.
ROUNDS, MEMORY, CLOSE = 60, 6, 1e-3


@dataclass
class Link:
    """One category's model: log odds = bias + words . presence + chain . logit(earlier probabilities)."""

    name: str
    bias: float
    words: np.ndarray
    chain: np.ndarray
    threshold: float = 0.5


@dataclass
class Chain:
    hashes: np.ndarray
    links: list[Link] = field(default_factory=list)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Bags:
    """The words that some texts have, each once: text i has words[begins[i]:begins[i + 1]], numbers below ``size``."""

    words: np.ndarray
    begins: np.ndarray
    size: int

    def some(self, texts: np.ndarray) -> Bags:
        lengths = np.diff(self.begins)[texts]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.begins[texts] - ends[:-1], lengths) + np.arange(ends[-1])
        return Bags(self.words[at], ends, self.size)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The sum of its words' weights for each text."""
        total = np.concatenate([[0.0], np.cumsum(weights[self.words])])
        return total[self.begins[1:]] - total[self.begins[:-1]]

    def spread(self, values: np.ndarray) -> np.ndarray:
        """The sum of its texts' values for each word."""
        return np.bincount(self.words, weights=np.repeat(values, np.diff(self.begins)), minlength=self.size)


def fit_logistic(bags: Bags, dense: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, ridge: float = RIDGE, evidence: float = EVIDENCE) -> tuple[float, np.ndarray, np.ndarray]:
    """Ridge logistic regression on word presence and dense columns, by limited-memory quasi-Newton steps; the bias isn't penalised.

    A word's penalty grows as the evidence that it has anything to do with y falls: with z the standard deviations by which the texts
    of y differ from all in having it, (EVIDENCE / z) ** 4 times the ridge come on top.
    """
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.0
        return float(logit(np.array(base))), np.zeros(bags.size), np.zeros(dense.shape[1])
    k = 1 + dense.shape[1]
    wide = np.column_stack([np.ones(len(y)), dense])
    often = np.bincount(bags.words, minlength=bags.size)
    z = (bags.spread(y) - often * y.mean()) / np.sqrt(often * y.mean() + 1)
    penalty = np.concatenate([np.full(k, ridge), ridge * (1 + (evidence / np.maximum(np.abs(z), 1e-2)) ** 4)])
    penalty[0] = 1e-6

    dot = lambda a, b: float((a * b).sum())  # noqa: E731 (one thread: products of long vectors otherwise wait for busy cores)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = (wide * w[:k]).sum(axis=1) + bags.sums(w[k:])
        error = sigmoid(z) - y
        return float(np.logaddexp(0, z).sum()) - dot(y, z) + 0.5 * dot(penalty * w, w), np.concatenate([(wide * error[:, None]).sum(axis=0), bags.spread(error)]) + penalty * w

    w, steps = np.zeros(k + bags.size), []
    w[0] = logit(np.array(y.mean()))
    first, slope = loss(w)
    now = first
    # the curvature at the start, by columns: what steps are measured by
    scale = 1 / (penalty + y.mean() * (1 - y.mean()) * np.concatenate([(wide**2).sum(axis=0), often]))
    for _ in range(rounds):
        move, back = -slope, []
        for s, d, r in reversed(steps):
            a = r * dot(s, move)
            back.append(a)
            move = move - a * d
        move = move * scale
        for (s, d, r), a in zip(steps, reversed(back), strict=True):
            move = move + (a - r * dot(d, move)) * s
        if dot(slope, move) >= 0:
            move, steps = -slope * scale, []
        size, fall = 1.0, dot(slope, move)
        while (new := loss(w + size * move))[0] > now + 1e-4 * size * fall and size > 1e-6:
            size /= 2
        if now - new[0] < CLOSE * first:
            break
        s, d = size * move, new[1] - slope
        if (along := dot(s, d)) > 0:
            steps = [*steps[1 - MEMORY :], (s, d, 1 / along)]
        w, (now, slope) = w + s, new
    return float(w[0]), w[k:], w[1:k]


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on a text counts as of the category: the best F1 over out-of-fold probabilities.

    Only cuts at which at least half of the taken texts are of the category count; without one, 0.5.
    """
    if not len(y) or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + hits[-1])
    f1[:-1][p[:-1] == p[1:]] = 0  # a cut can't part equal probabilities
    f1[hits < 0.5 * np.arange(1, len(p) + 1)] = 0
    k = int(f1.argmax())
    if not f1[k]:
        return 0.5
    return float((p[k] + p[min(k + 1, len(p) - 1)]) / 2)


def presence(words_hashes: np.ndarray, offsets: np.ndarray, hashes: np.ndarray) -> Bags:
    """Which model words each text has, each once."""
    n = len(offsets) - 1
    if not len(hashes):
        return Bags(np.zeros(0, np.int64), np.zeros(n + 1, np.int64), 0)
    at = np.minimum(np.searchsorted(hashes, words_hashes), len(hashes) - 1)
    ok = np.flatnonzero(hashes[at] == words_hashes)
    pair = np.unique((np.searchsorted(offsets, ok, side="right") - 1) * len(hashes) + at[ok])
    return Bags(pair % len(hashes), np.searchsorted(pair, np.arange(n + 1) * len(hashes)), len(hashes))


def fit(docs: DataFrame, labels: DataFrame, categories: list[tuple[str, str]], sample_rows: int = SAMPLE_ROWS, folds: int = FOLDS) -> Chain:
    """A chain over ``categories``: (name, SQL condition on labels) in their order."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.expr(f"cast(({sql}) as double)").alias(f"y{k}") for k, (_, sql) in enumerate(categories)]).where("doc_id IS NOT NULL")
    total = known.count()
    share = max(1, round(1_000_000 * min(1.0, sample_rows / max(total, 1))))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).join(sample, "doc_id")
    ys = [f"y{k}" for k in range(len(categories))]
    # equal texts count once, with the labels of the smallest doc_id that has one
    rows = rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), *[F.min_by(y, F.when(F.col(y).isNotNull(), F.col("doc_id"))).alias(y) for y in ys])

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = split(batch.column(1).slice(lo, hi - lo))
                h, o = words.hashes(), words.offsets
                sets = [np.unique(h[o[t] : o[t + 1]]).view(np.int64) for t in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64())), *[c.slice(lo, hi - lo) for c in batch.columns[2:]]], names=["doc_id", "words", *batch.schema.names[2:]])

    bags = rows.select("doc_id", "text", *ys).mapInArrow(tidy(distinct_words), "doc_id long, words array<long>, " + ", ".join(f"{y} double" for y in ys))
    held = saved(bags, "bags").toArrow()  # the bounded sample
    held = held.take(pc.sort_indices(held, sort_keys=[("doc_id", "ascending")]))
    lists = held.column("words").combine_chunks()
    hashes, words, often = np.unique(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), return_inverse=True, return_counts=True)
    shared, n = often[words] > 1, held.num_rows
    begins = np.concatenate([[0], np.cumsum(shared)])[lists.offsets.to_numpy() - lists.offsets.to_numpy()[:1].sum()]
    hashes, words = hashes[often > 1], (np.cumsum(often > 1) - 1).astype(np.int32)[words[shared]]
    sample = Bags(words, begins, len(hashes))
    fold = (held.column("doc_id").to_numpy() * 2654435761 >> 7) % folds
    earlier, chain = np.zeros((n, 0)), Chain(hashes)
    for k, (name, _) in enumerate(categories):
        y = held.column(ys[k]).to_numpy().astype(float)  # a null label is a nan
        have, out_of_fold = ~np.isnan(y), np.zeros(n)
        for f in range(folds):
            learn, rest = np.flatnonzero(have & (fold != f)), np.flatnonzero(fold == f)
            bias, own, links = fit_logistic(sample.some(learn), earlier[learn], y[learn])
            out_of_fold[rest] = bias + sample.some(rest).sums(own) + earlier[rest] @ links
        own = np.flatnonzero(have)
        chain.links.append(Link(name, *fit_logistic(sample.some(own), earlier[own], y[own])))
        chain.links[-1].threshold = best_threshold(sigmoid(out_of_fold[have]), y[have])
        earlier = np.column_stack([earlier, logit(sigmoid(out_of_fold))])
    return chain


def score_texts(chain: Chain, texts: pa.Array) -> np.ndarray:
    """The probability of each category (columns) for each text."""
    words = split(texts)
    bags = presence(words.hashes(), words.offsets, chain.hashes)
    earlier = np.zeros((len(texts), 0))
    for link in chain.links:
        z = link.bias + bags.sums(link.words) + earlier @ link.chain
        earlier = np.column_stack([earlier, logit(sigmoid(z))])
    return sigmoid(earlier)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """The columns of docs, then p_<category> for each; columns of docs with these names give way."""
    names = [f"p_{x.name}" for x in chain.links]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    at = kept.columns.index("text")
    sent = kept.sparkSession.sparkContext.broadcast(chain)  # bounded by the sample: 24 bytes for each of its words

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                p = score_texts(sent.value, part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(p[:, k]) for k in range(len(names))]], names=[*part.schema.names, *names])

    return kept.mapInArrow(tidy(task), ", ".join([kept.schema.toDDL(), *[f"{x} double" for x in names]]))


#: The categories that the labels table has: texts of low quality first, whose probability the toxic one is given.
CATEGORIES = [("low_quality", "quality = 0"), ("toxic", "toxic = 1")]


def classify(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """docs with p_low_quality, p_toxic and toxic_pred: p_toxic at the threshold (by default, that of the fit) or more."""
    chain = fit(docs, labels, CATEGORIES)
    scored, threshold = score(docs, chain), chain.links[-1].threshold if threshold is None else threshold
    return scored.select(*[F.col(f"`{c}`") for c in scored.columns if c != "toxic_pred"], (F.col("p_toxic") >= threshold).alias("toxic_pred"))
